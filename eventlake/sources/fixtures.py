"""Adapters from the given ``events`` table to the event envelope, plus the derived
inputs the tests and registered queries use (duplicates, dirty rows, text form).

Every function is a pure projection/filter/union of the input: map-only, no
shuffle, so it scales with the table and keeps the scan's pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.encode import UUID_GROUPS, payload_json

# How the synthetic context columns and payload are derived from `events`.
APP_MOD, HOST_MOD, DB_MOD, HASH_MOD = 7, 11, 3, 20
FIXED_ROW_BYTES = 64
OFFSET_STRIDE = 1024
DURATION_SCALE = 100000


def widen(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer splits than the cluster has task slots.

    A large table scans into many splits and is returned untouched (no exchange);
    a small single-row-group file would otherwise run every per-row expression in
    one task.  The round-robin exchange is sort-based, hence retry-deterministic.
    """
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. Spark Connect): leave as is
        return df
    return df.repartition(slots) if splits < slots else df


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """One of the given read-only tables, as its files are now."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return widen(df) if spread else df


# The adapter as SQL expressions: one analysed projection (building it column by column
# costs a driver round trip per function call, ~4x the planning time).
_ENVELOPE_EXPRS = (
    f"regexp_replace(md5(cast(event_id AS string)), '{UUID_GROUPS}', '$1-$2-$3-$4-$5') AS UUID",
    "event_type AS Name",
    # the wall clock of the table is UTC, whatever the session's zone
    "timestamp_micros(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)) AS Timestamp",
    f"event_id * {OFFSET_STRIDE} AS XEventStartOffsetInBytes",
    f"event_id * {OFFSET_STRIDE} + ({FIXED_ROW_BYTES}L + octet_length(event_type) + octet_length(props))"
    " AS XEventEndOffsetInBytes",
    f"{FIXED_ROW_BYTES}L + octet_length(event_type) + octet_length(props) AS XEventSizeInBytes",
    "to_variant_object(named_struct("
    f"'client_app_name', concat('app', cast(user_id % {APP_MOD} AS string)), "
    f"'client_hostname', concat('host', cast(user_id % {HOST_MOD} AS string)), "
    f"'database_name', concat('db', cast(user_id % {DB_MOD} AS string)), "
    f"'query_hash', user_id % {HASH_MOD}, "
    "'username', concat('u', cast(user_id AS string)))) AS Actions",
    "to_variant_object(named_struct("
    f"'duration', cast(round(value * {DURATION_SCALE}) AS bigint), "
    "'k', variant_get(parse_json(props), '$.k', 'bigint'), "
    "'note', cast(NULL AS string), "
    "'statement', concat('stmt ', event_type, ' ', variant_get(parse_json(props), '$.k', 'string')))) AS Fields",
)


def envelope_from_events(events: DataFrame) -> DataFrame:
    """The eight-column envelope for each row of ``events`` (FIXTURES.md §6)."""
    return events.selectExpr(*_ENVELOPE_EXPRS)


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelope of the given ``events`` table."""
    return envelope_from_events(read_table(spark, sf_dir, "events"))


def source_id() -> Column:
    """The ``event_id`` an envelope row came from (its start offset / stride)."""
    return F.expr(f"XEventStartOffsetInBytes div {OFFSET_STRIDE}")


def env_dup(events: DataFrame) -> DataFrame:
    """Envelope with every tenth event delivered twice (replays, at-least-once)."""
    env = envelope_from_events(events)
    again = envelope_from_events(events.filter(F.col("event_id") % 10 == 0))
    return env.unionByName(again)


def env_dirty(events: DataFrame) -> DataFrame:
    """Envelope with constraint breakers: null UUID on every 97th event, a 256-character
    name on every 101st (the NOT NULL and VARCHAR(255) rules of the relational sink)."""
    env = envelope_from_events(events)
    eid = source_id()
    return env.select(
        F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("UUID")).alias("UUID"),
        F.when((eid % 97 != 0) & (eid % 101 == 0), F.repeat(F.lit("x"), 256))
         .otherwise(F.col("Name")).alias("Name"),
        *[c for c in env.columns if c not in ("UUID", "Name")])


# The offset used by the text form of the envelope.
TEXT_OFFSET = "+03:00"


def env_text(events: DataFrame) -> DataFrame:
    """Text form: ISO timestamp at +03:00, payloads as JSON text (what files and Kafka carry)."""
    env = envelope_from_events(events)
    local = F.from_utc_timestamp(F.col("Timestamp"), TEXT_OFFSET)
    ts_text = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(TEXT_OFFSET))
    return env.select(
        "UUID", "Name", ts_text.alias("Timestamp"),
        "XEventStartOffsetInBytes", "XEventEndOffsetInBytes", "XEventSizeInBytes",
        payload_json("Actions").alias("Actions"), payload_json("Fields").alias("Fields"))


def landing_lines(events: DataFrame) -> DataFrame:
    """Text lines (``value``) as a landing folder holds them: the text form as JSON objects, with one of the seven
    faults in some: no JSON at all, no id, no name, a name too long, a time that is none, payloads cut off."""
    txt = env_text(events)
    eid = source_id()

    def put(column: str, faults: dict[int, Column | None]) -> Column:
        out = F.col(column)
        for every, value in faults.items():
            out = F.when(eid % every == 0, F.lit(None).cast("string") if value is None else value).otherwise(out)
        return out.alias(column)

    faulty = {"UUID": {97: None}, "Name": {89: None, 83: F.repeat(F.lit("x"), 256)}, "Timestamp": {79: F.lit("yesterday")},
              "Actions": {73: F.lit("not json")}, "Fields": {71: F.lit('{"a":')}}
    line = F.to_json(F.struct(*[put(c, faulty[c]) if c in faulty else F.col(c) for c in txt.columns]))
    return txt.select(F.when(eid % 67 == 0, F.concat(F.lit("not json "), eid.cast("string"))).otherwise(line).alias("value"))


__all__ = ["landing_lines", "envelope", "envelope_from_events", "env_dup", "env_dirty",
           "env_text", "read_table"]
