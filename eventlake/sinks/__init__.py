"""Sinks: day-partitioned and key-sorted tables, Kafka, JDBC; dedup and constraints."""
