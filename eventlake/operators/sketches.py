"""A9 with mergeable percentiles: KLL sketches stored per day, merged over days, batches and streams.

A day's sketch is a column of a small table, so a month's or a stream's percentiles are a merge of
rows instead of a scan of events.  :func:`rank_errors` counts how far off each percentile is, exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.encode import row_bytes
from eventlake.operators.analytics import CAPACITY_PERCENTILES, action, duration

K = 2048
SUMS = ("n_events", "n_durations", "sum_duration", "total_bytes")


def rank_error(k: int = K) -> float:
    """The stated error of a percentile, as a share of the rows: twice the sketch's published 99 % figure."""
    # The published error of a KLL sketch of size k, one-sided
    return 2 * 2.296 / k ** 0.9021


def capacity_sketches(env: DataFrame, k: int = K) -> DataFrame:
    """Per UTC day and database: events, durations, their sum, encoded bytes and a sketch of the durations.
    A partial aggregate: a hot database reaches the shuffle as one sketch per task."""
    d = duration()
    rows = env.select(F.to_date("Timestamp").alias("day"), action("database_name").alias("database_name"),
                      d.alias("duration"), row_bytes("relational").alias("row_bytes"))
    return rows.groupBy("day", "database_name").agg(
        F.count(F.lit(1)).alias("n_events"), F.count("duration").alias("n_durations"), F.sum("duration").alias("sum_duration"),
        F.sum("row_bytes").alias("total_bytes"), F.kll_sketch_agg_bigint("duration", F.lit(k)).alias("sketch"))


def sketches_by_batch(k: int = K):
    """A batch writer for streams: each batch's sketches under ``root/batch_id=N`` (a replay replaces them);
    days that span batches are merged by :func:`rollup` when read."""
    def write(batch: DataFrame, root: str, batch_id: int | str) -> None:
        capacity_sketches(batch, k).write.mode("overwrite").parquet(f"{root}/batch_id=b{batch_id}")
    return write


def rollup(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums and sketches merged to coarser ``keys`` (any columns of ``sketches``)."""
    return sketches.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], F.kll_merge_agg_bigint("sketch").alias("sketch"))


def with_percentiles(merged: DataFrame, percentiles: Sequence[float] = CAPACITY_PERCENTILES) -> DataFrame:
    """``merged`` with ``p50`` and so on in place of the sketch: NULL for a group without durations."""
    names = [f"p{round(100 * p)}" for p in percentiles]
    value = [F.when(F.col("n_durations") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p)))).alias(n)
             for n, p in zip(names, percentiles, strict=True)]
    return merged.select(*[c for c in merged.columns if c != "sketch"], *value)


def rank_errors(env: DataFrame, found: DataFrame, keys: Sequence[str],
                percentiles: Sequence[float] = CAPACITY_PERCENTILES) -> DataFrame:
    """``found`` (:func:`with_percentiles` by ``keys``, of database_name and day) with ``p50_error`` and so on: the
    share of a group's rows between a percentile and its exact rank, counted over all events."""
    names = [f"p{round(100 * p)}" for p in percentiles]
    rows = env.select(F.to_date("Timestamp").alias("day"), action("database_name").alias("database_name"), duration().alias("d"))
    # one row per group on the right: broadcast by the planner; counts are partial aggregates
    held = found.select(*[F.col(c).alias(f"of_{c}") for c in keys], *names)
    same = [rows[c].eqNullSafe(held[f"of_{c}"]) for c in keys]
    counted = rows.join(held, same).groupBy(*[f"of_{c}" for c in keys]).agg(
        *[F.count_if(F.col("d") < F.col(n)).alias(f"{n}_below") for n in names],
        *[F.count_if(F.col("d") <= F.col(n)).alias(f"{n}_upto") for n in names])
    out = found.join(counted, [found[c].eqNullSafe(counted[f"of_{c}"]) for c in keys], "left")

    def error(n: str, p: float):
        want = F.ceil(F.lit(float(p)) * F.col("n_durations"))
        off = F.greatest(F.lit(0), F.col(f"{n}_below") + 1 - want, want - F.col(f"{n}_upto"))
        return F.when(F.col("n_durations") > 0, off / F.col("n_durations")).alias(f"{n}_error")

    return out.select(*found.columns, *[error(n, p) for n, p in zip(names, percentiles, strict=True)])
