"""Readers (S1-S4).  Each returns an envelope-shaped DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.encode import parse_payload, to_utc
from eventlake.functions.envelope import ENVELOPE, ENVELOPE_TEXT

CORRUPT_COLUMN = "_corrupt_record"


def from_text(df: DataFrame, pattern: str | None = None) -> DataFrame:
    """Text-form envelope -> envelope: ISO timestamps to instants, JSON payloads to variants.
    Malformed values become NULL and are caught by the constraint split (K7).  Columns
    beyond the eight (e.g. ``_corrupt_record``) pass through."""
    extra = [c for c in df.columns if c not in ENVELOPE_TEXT.fieldNames()]
    return df.select(
        "UUID", "Name", to_utc("Timestamp", pattern).alias("Timestamp"),
        "XEventStartOffsetInBytes", "XEventEndOffsetInBytes", "XEventSizeInBytes",
        parse_payload("Actions").alias("Actions"), parse_payload("Fields").alias("Fields"), *extra)


def read_event_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                      options: Mapping[str, str] | None = None) -> DataFrame:
    """Unbounded scan of landed event files.  Parquet files carry the envelope
    itself; JSON lines carry its text form and are decoded."""
    reader = spark.readStream.options(**dict(options or {}))
    if fmt == "parquet":
        return reader.schema(ENVELOPE).parquet(path)
    if fmt == "json":
        # keep the raw text of unparseable lines for the dead letter
        schema = T.StructType([*ENVELOPE_TEXT.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
        return from_text(reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
                         .json(path))
    raise ValueError(f"unsupported landing format {fmt!r}")


def read_event_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON lines in their text form as one batch, unparseable lines kept in ``_corrupt_record``."""
    schema = T.StructType([*ENVELOPE_TEXT.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    return from_text(spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(path))


def decode_value(messages: DataFrame) -> DataFrame:
    """Kafka ``value`` bytes (UTF-8 JSON of the envelope) -> envelope, with the text of
    messages that do not parse in ``_corrupt_record`` (for the dead letter)."""
    schema = T.StructType([*ENVELOPE_TEXT.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    text = F.col("value").cast("string")
    doc = F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT_COLUMN})
    # a message that is no JSON object at all keeps its text, too
    own = F.when(F.coalesce(text, F.lit("")).rlike(r"^\s*\{"), F.col(f"e.{CORRUPT_COLUMN}")).otherwise(F.coalesce(text, F.lit("")))
    return from_text(messages.select("value", doc.alias("e"))
                     .select(*[f"e.{f.name}" for f in ENVELOPE_TEXT.fields], own.alias(CORRUPT_COLUMN)))


def read_kafka(spark: SparkSession, bootstrap: str, topic: str, streaming: bool = True,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Read a topic from the earliest offset (needs the Kafka connector on the classpath)."""
    src = spark.readStream if streaming else spark.read
    raw = (src.format("kafka").option("kafka.bootstrap.servers", bootstrap)
           .option("subscribe", topic).option("startingOffsets", "earliest")
           .options(**dict(options or {})).load())
    return decode_value(raw)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | str | None = None, upper: int | str | None = None, num_partitions: int = 4,
              properties: Mapping[str, str] | None = None) -> DataFrame:
    """S3: relational scan; payload text parsed back to variants.  With a numeric, date or
    timestamp ``partition_column`` and its bounds the scan is split into ``num_partitions`` range queries."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs lower and upper bounds")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(num_partitions)))
    raw = r.options(**dict(properties or {})).load()
    return raw.select(
        "UUID", "Name", F.col("Timestamp").cast("timestamp").alias("Timestamp"),
        "XEventStartOffsetInBytes", "XEventEndOffsetInBytes", "XEventSizeInBytes",
        parse_payload("Actions").alias("Actions"), parse_payload("Fields").alias("Fields"))


def _sql_literal(v) -> str:
    """A bound as SQL text; dates and timestamps as JDBC escapes, which every driver knows."""
    import datetime as dt
    if isinstance(v, dt.datetime):
        return f"{{ts '{v:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(v, dt.date):
        return f"{{d '{v:%Y-%m-%d}'}}"
    return repr(v)


# Quantiles taken for each partition wanted: a partition is off by one part in so many.
QUANTILES_EACH = 4


def balanced_predicates(values: DataFrame, column: str, num_partitions: int, tie: str | None = None) -> list[str]:
    """WHERE clauses that cut a table into about ``num_partitions`` parts of like size, each row in one.

    ``values`` has the table's ``column`` (a number, date or timestamp without zone), whole or a
    sample.  Bounds are its quantiles, from one mergeable aggregate.  A value (or the NULLs) that
    alone outweighs a part is dealt out by the remainder of ``tie``, a whole-number column; without
    one it stays in one part."""
    if num_partitions < 1:
        raise ValueError("at least one partition")
    grid = QUANTILES_EACH * num_partitions
    at = [k / grid for k in range(1, grid)]
    found = values.agg(F.percentile_approx(column, at, 100 * grid).alias("q") if len(at) else F.lit(None).alias("q"),
                       F.count(F.lit(1)).alias("n"), F.count(column).alias("m")).first()
    name = f'"{column}"'
    bounds = list(found["q"]) if found["m"] and at else []
    nulls = round(grid * (found["n"] - found["m"]) / found["n"]) if found["n"] else 0

    def parts(clause: str, weight: int) -> list[str]:
        """``clause`` in as many parts as its weight, in quantiles, calls for."""
        k = -(-weight // QUANTILES_EACH) if tie else 1
        return [clause] if k < 2 else [f'({clause}) AND ABS(MOD(COALESCE("{tie}", 0), {k})) = {i}' for i in range(k)]

    alone = parts(f"{name} IS NULL", nulls) if nulls > QUANTILES_EACH else []
    ranges, low, begins, gathered = [], None, ">=", 0
    for value in dict.fromkeys(bounds):
        n = bounds.count(value)
        gathered += n
        if n > QUANTILES_EACH:
            ranges.append((low, begins, value))
            alone += parts(f"{name} = {_sql_literal(value)}", n)
            low, begins, gathered = value, ">", 0
        elif gathered >= QUANTILES_EACH:
            ranges.append((low, begins, value))
            low, begins, gathered = value, ">=", 0
    clauses = []
    for low, begins, high in [*ranges, (low, begins, None)]:
        ends = [f"{name} {begins} {_sql_literal(low)}"] * (low is not None) + [f"{name} < {_sql_literal(high)}"] * (high is not None)
        clauses.append(" AND ".join(ends) or f"{name} IS NOT NULL")
    if nulls <= QUANTILES_EACH:
        clauses[0] = f"({clauses[0]}) OR {name} IS NULL"
    return clauses + alone


def read_jdbc_balanced(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                       tie: str | None = None, fraction: float | None = None, fetch_size: int = 10_000,
                       properties: Mapping[str, str] | None = None) -> DataFrame:
    """S3 by equi-depth ranges: like :func:`read_jdbc`, but the ranges hold like numbers of rows however
    skewed ``column`` is.  Its values are read alone first, in equally wide ranges (``fraction``: a
    sample of them)."""
    props = {**dict(properties or {}), "fetchsize": str(fetch_size)}

    def asked(sql: str):
        # timestamps as the wall clock that the database compares with
        return (spark.read.format("jdbc").option("url", url).option("preferTimestampNTZ", "true").options(**props)
                .option("dbtable", f"({sql}) asked"))

    ends = asked(f'SELECT MIN("{column}") AS lo, MAX("{column}") AS hi FROM {table}').load().first()
    narrow = asked(f'SELECT "{column}" FROM {table}')
    if ends[0] is not None and ends[0] != ends[1]:
        narrow = (narrow.option("partitionColumn", column).option("lowerBound", str(ends[0]))
                  .option("upperBound", str(ends[1])).option("numPartitions", str(num_partitions)))
    values = narrow.load()
    if fraction is not None:
        values = values.sample(fraction=fraction, seed=1)
    raw = spark.read.jdbc(url, table, predicates=balanced_predicates(values, column, num_partitions, tie), properties=props)
    return raw.select(
        "UUID", "Name", F.col("Timestamp").cast("timestamp").alias("Timestamp"),
        "XEventStartOffsetInBytes", "XEventEndOffsetInBytes", "XEventSizeInBytes",
        parse_payload("Actions").alias("Actions"), parse_payload("Fields").alias("Fields"))


def read_ordered(spark: SparkSession, path: str, key: str = "UUID") -> DataFrame:
    """A stored table in key order (range-partitioned global sort).

    Ties are broken by each row's file and row index, so the range partitioner can
    split a key that holds a third of all rows over many tasks, and the order is the
    same on every run (a retried task sees the same boundaries)."""
    df = spark.read.parquet(path)
    cols = df.columns
    tagged = df.select("*", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.row_index").alias("_row"))
    return tagged.orderBy(key, "_file", "_row").select(*cols)
