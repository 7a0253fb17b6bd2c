"""Readers (landing files, Kafka, JDBC, ordered tables) and adapters for the given tables."""
