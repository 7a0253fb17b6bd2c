"""Sinks (K1-K12).

Every writer appends a DataFrame; none of them collects, loops or buffers on the
driver.  Row-level checks (K6 dedup, K7 constraints) are DataFrame operators
that run before the write, so batch jobs and ``foreachBatch`` share them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from eventlake.functions.encode import event_json
from eventlake.functions.envelope import ENVELOPE_COLUMNS

# Sink defaults.
DEFAULT_TABLE = "xe_data"
DEFAULT_BATCH_SIZE = 100_000
DEFAULT_PARALLELISM = 4
KAFKA_DEFAULTS = {"batch_size": 1_000_000, "parallelism": 10, "linger_ms": 0.5, "timeout_ms": 1000}
# Accepted compression codecs per sink family.
FILE_CODECS = ("none", "gzip", "snappy", "lz4", "zstd")
SORTED_TABLE_CODECS = ("none", "gzip")
KAFKA_CODECS = ("none", "gzip", "snappy", "lz4", "zstd")
# Relational constraints of the envelope.
NAME_MAX_CHARS = 255
SINK_KINDS = ("sorted", "daily", "kafka", "jdbc")
# Day partition label, year, month and day unpadded.
PARTITION_LABEL = "%s_y%dm%dd%d"


# --- K11 ---------------------------------------------------------------------------------------

def choose(sections: Mapping[str, object | None]) -> str:
    """Exactly one configured sink section, else fail fast."""
    present = [k for k, v in sections.items() if v is not None]
    unknown = [k for k in present if k not in SINK_KINDS]
    if unknown:
        raise ValueError(f"unknown sink kind(s): {unknown}")
    if len(present) != 1:
        raise ValueError(f"exactly one sink must be configured, found {len(present)}: {present}")
    return present[0]


# --- K9 / K10 / K12 ----------------------------------------------------------------------------

def _codec(name: str | None, allowed: tuple[str, ...]) -> str:
    c = (name or "none").strip().lower()
    if c not in allowed:
        raise ValueError(f"unknown compression {name!r}; expected one of {allowed}")
    return c


def writer_options(compression: str | None = None, batch_size: int | None = None,
                   parallelism: int | None = None, kind: str = "daily") -> dict[str, str]:
    """K9 + K10: file/JDBC writer options.  ``batch_size`` bounds rows per file (tables)
    or per round trip (JDBC); ``parallelism`` bounds concurrent loads (JDBC connections)."""
    allowed = SORTED_TABLE_CODECS if kind == "sorted" else FILE_CODECS
    # K9's codec of the wire says nothing about storage: files are zstd unless one is named
    opts = {"compression": _codec(compression, allowed) if compression else "zstd"}
    if kind == "jdbc":
        opts.pop("compression")
        opts["batchsize"] = str(batch_size or DEFAULT_BATCH_SIZE)
        opts["numPartitions"] = str(parallelism or DEFAULT_PARALLELISM)
    elif batch_size:
        opts["maxRecordsPerFile"] = str(batch_size)
    return opts


def kafka_options(bootstrap: str, topic: str, compression: str | None = None,
                  linger_ms: float = KAFKA_DEFAULTS["linger_ms"],
                  batch_size: int = KAFKA_DEFAULTS["batch_size"],
                  timeout_ms: int = KAFKA_DEFAULTS["timeout_ms"]) -> dict[str, str]:
    """Producer settings in the Kafka connector's option names."""
    if not bootstrap or not topic:
        raise ValueError("Kafka needs a bootstrap address and a topic")
    return {
        "kafka.bootstrap.servers": bootstrap,
        "topic": topic,
        "kafka.compression.type": _codec(compression, KAFKA_CODECS),
        # the Java producer takes whole milliseconds, and a delivery timeout of at least linger
        # plus request timeout
        "kafka.linger.ms": str(math.ceil(linger_ms)),
        "kafka.batch.size": str(batch_size),
        "kafka.request.timeout.ms": str(max(1, int(timeout_ms) - math.ceil(linger_ms))),
        "kafka.delivery.timeout.ms": str(max(int(timeout_ms), math.ceil(linger_ms) + 1)),
    }


# --- K5 / K6 / K7 ------------------------------------------------------------------------------

def day_partition(ts: str | Column = "Timestamp", table: str = DEFAULT_TABLE) -> Column:
    """K5: the UTC day an event belongs to, its unpadded label ``{table}_y{Y}m{M}d{D}``
    and the half-open range [day, day + 1) (calendar arithmetic, month ends included)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    day = F.to_date(c)
    label = F.when(day.isNotNull(), F.format_string(PARTITION_LABEL, F.lit(table), F.year(day), F.month(day), F.dayofmonth(day)))
    return F.struct(day.alias("event_date"), label.alias("partition_name"),
                    day.alias("range_start"), F.date_add(day, 1).alias("range_end"))


def dedup_key(df: DataFrame, keys: tuple[str, ...] = ("Timestamp", "UUID"),
              watermark: str | None = None,
              prefer: str = "XEventStartOffsetInBytes") -> DataFrame:
    """K6: one row per key.

    Batch: per key the row with the smallest ``prefer`` value (the earliest delivery,
    as a primary key keeps the first insert), chosen by ``min_by``.  That is
    deterministic (ties: a hash of the rest of the row), so a retried task keeps the same
    row, and it is a partial aggregate:
    a key holding a third of all rows reaches the shuffle as one row per map task.
    Streaming: the first arrival within the watermark, so state stays bounded."""
    if df.isStreaming:
        if watermark is not None:
            df = df.withWatermark("Timestamp", watermark)
        return df.dropDuplicatesWithinWatermark(list(keys))
    others = [c for c in df.columns if c not in keys]
    if prefer not in df.columns or not others:
        return df.dropDuplicates(list(keys))
    # min_by skips NULL orderings: order by (missing?, value) so a row without the
    # preferred column still wins its group when it is the only one
    # ties are broken by the rest of the row, so the winner does not depend on input order
    rest = [F.to_json(c) if isinstance(df.schema[c].dataType, VariantType) else F.col(c) for c in others]
    order = F.struct(F.col(prefer).isNull(), F.col(prefer), F.xxhash64(*rest))
    picked = (df.groupBy(*keys)
              .agg(F.min_by(F.struct(*others), order).alias("_row")))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


CORRUPT_COLUMN = "_corrupt_record"


def reject_reason(columns: tuple[str, ...] = ()) -> Column:
    """K7: first broken constraint of a row, NULL for a good row.  A payload that is
    NULL after parsing was malformed text (parsing maps SQL/JSON null to ``{}``)."""
    r = F.when(F.lit(False), F.lit(None).cast("string"))
    if CORRUPT_COLUMN in columns:
        r = r.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit("corrupt record"))
    return (r.when(F.col("UUID").isNull(), F.lit("UUID is null"))
            .when(F.col("Name").isNull(), F.lit("Name is null"))
            .when(F.char_length("Name") > NAME_MAX_CHARS, F.lit(f"Name longer than {NAME_MAX_CHARS}"))
            .when(F.col("Timestamp").isNull(), F.lit("Timestamp is null or malformed"))
            .when(F.col("Actions").isNull(), F.lit("Actions malformed"))
            .when(F.col("Fields").isNull(), F.lit("Fields malformed")))


def label_valid(df: DataFrame) -> DataFrame:
    """K7: every row with its ``reject_reason`` (one pass, no split yet)."""
    return df.withColumn("reject_reason", reject_reason(tuple(df.columns)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K7: (good rows, dead-letter rows with ``reject_reason``).  Good + dead = input."""
    labelled = label_valid(df)
    good = labelled.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    dead = labelled.filter(F.col("reject_reason").isNotNull())
    return good, dead


# --- K1 / K2 / K4 ------------------------------------------------------------------------------

def write_sorted(df: DataFrame, path: str, compression: str | None = None,
                 batch_size: int | None = None, num_files: int | None = None) -> None:
    """K1: append a UUID-ordered part.  Each task sorts its own rows (no shuffle, no skew:
    a run of identical UUIDs stays where it is); ``num_files`` switches to a range
    exchange so the files are also ordered among each other."""
    # the offset splits a run of one UUID, however long, over several ranges
    out = df.repartitionByRange(num_files, "UUID", "XEventStartOffsetInBytes") if num_files else df
    (out.sortWithinPartitions("UUID").write.mode("append")
        .options(**writer_options(compression, batch_size, kind="sorted")).parquet(path))


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("Timestamp"))


def write_daily(df: DataFrame, path: str, compression: str | None = None,
                batch_size: int | None = None, parallelism: int | None = None) -> None:
    """K2: append to UTC-day partitions (created on demand, so no event is ever outside
    an existing partition).  A ``rebalance`` exchange on the day keeps the number of files in
    proportion to the data; a day with a third of all rows is split over several tasks."""
    # rebalanced by day: adaptive execution merges small days into few files and splits hot ones;
    # ``parallelism`` bounds the tasks that it starts from
    some = [] if parallelism is None else [parallelism]
    (with_event_date(df).hint("rebalance", *some, F.col("event_date")).write.mode("append").partitionBy("event_date")
        .options(**writer_options(compression, batch_size)).parquet(path))


def ensure_table(spark: SparkSession, table: str, path: str, layout: str = "daily") -> None:
    """K4: idempotent DDL for the sink table (no-op when it exists)."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?", table):
        raise ValueError(f"not a table name: {table!r}")
    path = path.replace("\\", "\\\\").replace("'", "\\'")
    cols = ("UUID STRING, Name STRING, Timestamp TIMESTAMP, XEventStartOffsetInBytes BIGINT, "
            "XEventEndOffsetInBytes BIGINT, XEventSizeInBytes BIGINT, Actions VARIANT, Fields VARIANT")
    if layout == "daily":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, event_date DATE) USING parquet "
                  f"PARTITIONED BY (event_date) LOCATION '{path}'")
    else:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet LOCATION '{path}'")


# --- K3 ----------------------------------------------------------------------------------------

def kafka_payload(df: DataFrame, timestamp_pattern: str | None = None) -> DataFrame:
    """K3: one message per event: null key, UTF-8 JSON of the envelope as value."""
    doc = event_json(timestamp_pattern) if timestamp_pattern else event_json()
    return df.select(F.lit(None).cast("binary").alias("key"),
                     F.encode(doc, "UTF-8").alias("value"))


def write_kafka(df: DataFrame, options: Mapping[str, str], streaming: bool = False,
                checkpoint: str | None = None):
    """K3: produce with Spark's Kafka connector (must be on the classpath).  Of :func:`sink_from_config`'s options,
    ``timestampFormat`` is the payload's and ``parallelism`` the number of producers."""
    options = dict(options)
    payload = kafka_payload(df, options.pop("timestampFormat", None))
    producers = options.pop("parallelism", None)
    if producers is not None:
        payload = payload.repartition(int(producers))
    if streaming:
        w = payload.writeStream.format("kafka").options(**options)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    payload.write.format("kafka").options(**options).save()
    return None


# --- K8 ----------------------------------------------------------------------------------------

def jdbc_frame(df: DataFrame) -> DataFrame:
    """The relational row: variants cannot travel through JDBC, so payloads become text."""
    return df.select(*[F.to_json(c).alias(c) if c in ("Actions", "Fields") else F.col(c)
                       for c in ENVELOPE_COLUMNS])


def write_jdbc(df: DataFrame, url: str, table: str = DEFAULT_TABLE,
               batch_size: int | None = None, parallelism: int | None = None,
               properties: Mapping[str, str] | None = None) -> None:
    """K8: bulk append into a relational table, ``parallelism`` connections at most."""
    opts = writer_options(batch_size=batch_size, parallelism=parallelism, kind="jdbc")
    # repartitioned here: Spark would coalesce instead, and with it run the whole job in so few tasks
    (jdbc_frame(df).repartition(int(opts["numPartitions"])).write.format("jdbc").mode("append")
        .option("url", url).option("dbtable", table)
        .options(**opts).options(**dict(properties or {})).save())


# Documented sink sections -> our sink kinds.
SECTION_KINDS = {"ClickHouse": "sorted", "Postgres": "daily", "Kafka": "kafka"}


def sink_from_config(sections: Mapping[str, Mapping | None]) -> tuple[str, dict[str, str]]:
    """Sink sections in the documented configuration shape -> (kind, writer options).

    Exactly one of ``ClickHouse`` (UUID-sorted table), ``Postgres`` (day-partitioned
    table) or ``Kafka`` must be present (K11).  Batch size, parallelism and compression
    map to writer options (K9, K10, K12)."""
    present = {k: v for k, v in sections.items() if v is not None}
    unknown = [k for k in present if k not in SECTION_KINDS]
    if unknown:
        raise ValueError(f"unknown sink section(s): {unknown}")
    kind = choose({SECTION_KINDS[k]: v for k, v in present.items()})
    section = next(v for k, v in present.items() if SECTION_KINDS[k] == kind)
    if kind == "kafka":
        opts = kafka_options(section.get("BrokerAddress", ""), section.get("Topic", ""),
                             section.get("CompressionType"),
                             linger_ms=section.get("LingerMs", KAFKA_DEFAULTS["linger_ms"]),
                             batch_size=section.get("BatchSize", KAFKA_DEFAULTS["batch_size"]),
                             timeout_ms=section.get("ProduceTimeout", KAFKA_DEFAULTS["timeout_ms"]))
        # options of write_kafka itself: the connector does not see them
        if section.get("DateTimeFormatString"):
            opts["timestampFormat"] = str(section["DateTimeFormatString"])
        return kind, opts | _parallelism(section)
    opts = writer_options(section.get("Compression"), section.get("BatchSize"),
                          kind=kind)
    opts["table"] = str(section.get("Table", DEFAULT_TABLE))
    return kind, opts | _parallelism(section)


def _parallelism(section: Mapping) -> dict[str, str]:
    """Concurrent loads, where the section sets them: ``num_files`` of :func:`write_sorted`, ``parallelism`` of
    :func:`write_daily`, :func:`write_jdbc` and :func:`write_kafka`."""
    n = section.get("MaxDegreeOfParallelism")
    if n is None:
        return {}
    if int(n) < 1:
        raise ValueError(f"MaxDegreeOfParallelism must be positive, not {n}")
    return {"parallelism": str(int(n))}
