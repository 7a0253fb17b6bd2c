"""eventlake: capture, shape, store and analyse structured event streams on Spark.

Everything is expressed with DataFrame operators and built-in SQL functions so
Catalyst can push filters into scans, prune columns and keep the row path in
whole-stage code generation.  Sub-packages:

* ``functions``  - the event envelope, payload access and encoders (column expressions)
* ``operators``  - capture specification, verification and analytics (DataFrame -> DataFrame)
* ``sources``    - readers (landing files, Kafka, JDBC, ordered tables) and test-data adapters
* ``sinks``      - table, Kafka and JDBC writers, deduplication and constraint checks
* ``streaming``  - Structured Streaming runners (checkpointed, idempotent, dead letters)
* ``plans``      - the registered queries and their DuckDB oracles
"""

__version__ = "0.1.0"
