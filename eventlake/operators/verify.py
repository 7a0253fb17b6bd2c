"""Verification operators (V1-V5): value equality, canonical hashes, count gates and
universal pattern checks over captured or re-read events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.encode import event_json, payload_json

_SCALARS = ("UUID", "Name", "Timestamp", "XEventStartOffsetInBytes",
            "XEventEndOffsetInBytes", "XEventSizeInBytes")
NULL_MARK = "\\N"


def distinct_events(env: DataFrame) -> DataFrame:
    """V1: one row per distinct event value: the six scalars plus both payloads compared
    by canonical JSON (key order ignored).

    Variants cannot be grouped, so the rows are made distinct on their scalars and the
    payloads' sorted-key text, a hash aggregate with a map-side partial (copies collapse
    before the shuffle; no variant in an aggregation buffer, which would force a sort-based
    aggregate).  The payloads are then rebuilt from that canonical text."""
    keyed = env.select(*_SCALARS, payload_json("Actions").alias("_a"), payload_json("Fields").alias("_f"))
    return keyed.distinct().select(*_SCALARS, F.parse_json("_a").alias("Actions"),
                                   F.parse_json("_f").alias("Fields"))


def event_hash() -> Column:
    """V2: equal events hash equal: md5 over the scalars and both canonical payloads."""
    parts = [F.coalesce(F.col(c).cast("string") if c != "Timestamp"
                        else F.unix_micros(F.col(c)).cast("string"), F.lit(NULL_MARK))
             for c in _SCALARS]
    parts += [F.coalesce(payload_json("Actions"), F.lit(NULL_MARK)),
              F.coalesce(payload_json("Fields"), F.lit(NULL_MARK))]
    return F.md5(F.concat_ws("|", *parts))


def event_digest() -> Column:
    """V2 without look-alikes: md5 of the whole event as one JSON document (keys in order, payloads canonical), in
    which NULL, text and separators inside text are told apart."""
    return F.md5(event_json().cast("binary"))


def count_gate(arrived: DataFrame, expected: DataFrame, key: str = "Name",
               exact: bool = True) -> DataFrame:
    """V3: per key, arrived rows against an expected-count table ``(key, expected)``.
    Both sides are aggregates (one row per key), so the join is tiny."""
    got = arrived.groupBy(key).agg(F.count(F.lit(1)).alias("arrived"))
    joined = got.join(expected, on=key, how="full_outer").select(
        key, F.coalesce("arrived", F.lit(0)).cast("bigint").alias("arrived"),
        F.coalesce("expected", F.lit(0)).cast("bigint").alias("expected"))
    ok = (F.col("arrived") == F.col("expected")) if exact else (F.col("arrived") >= F.col("expected"))
    return joined.withColumn("ok", ok)


def all_match(df: DataFrame, value: Column, pattern: str) -> DataFrame:
    """V4: one row: rows checked, rows matching and whether every row matches.
    A NULL value does not match.  Distributed ``bool_and`` with partial aggregation."""
    m = F.coalesce(value.rlike(pattern), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(m.cast("bigint")).alias("n_matching"),
                  F.coalesce(F.bool_and(m), F.lit(True)).alias("all_match"))


def sorted_by_key(df: DataFrame, key: str = "UUID") -> DataFrame:
    """V5: total order by key (range-partitioned sort)."""
    return df.orderBy(key)
