"""Analytics over captured events (A1-A9): the use cases events are collected for.

Each function takes an envelope frame (batch or, where noted, streaming) and
returns a DataFrame.  Payload values are read once with ``try_variant_get`` and
every aggregate is a built-in with a map-side partial step, so a hot key (one
query hash or one user holding a third of all rows) is combined before the
shuffle and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.encode import row_bytes
from eventlake.functions.envelope import field
from eventlake.operators.quantiles import percentile_columns
from eventlake.session import cut_lineage

# Defaults of the documented use cases.
SLOW_THRESHOLD_US = 5_000_000          # the sample predicate [duration] >= 5000000
DEFAULT_WINDOW = "1 hour"
PERCENTILE_ACCURACY = 100_000          # relative rank error 1e-5; exact for groups < 1e5 rows


def duration() -> Column:
    return field("Fields", "duration", "bigint")


def action(key: str, data_type: str = "string") -> Column:
    return field("Actions", key, data_type)


def slow_queries(env: DataFrame, threshold: int = SLOW_THRESHOLD_US) -> DataFrame:
    """A1: events at or above the duration threshold with their context columns."""
    return (env.withColumn("duration", duration())
            .filter(F.col("duration") >= threshold)
            .select("UUID", "Name", "Timestamp", "duration",
                    action("query_hash", "bigint").alias("query_hash"),
                    action("client_app_name").alias("client_app_name"),
                    action("database_name").alias("database_name"),
                    action("username").alias("username")))


def windowed_stats(env: DataFrame, every: str = DEFAULT_WINDOW) -> DataFrame:
    """A2: per tumbling window and event kind: count, total and maximum duration.
    Works on streaming frames that carry a watermark on ``Timestamp``."""
    return (env.select("Timestamp", "Name", duration().alias("duration"))
            .groupBy(F.window("Timestamp", every).alias("window"), "Name")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.sum("duration").alias("sum_duration"),
                 F.max("duration").alias("max_duration")))


def alerts(env: DataFrame, min_slow: int = 3, threshold: int = SLOW_THRESHOLD_US,
           every: str = DEFAULT_WINDOW) -> DataFrame:
    """A3: windows in which one event kind had at least ``min_slow`` slow events."""
    return (env.select("Timestamp", "Name", duration().alias("duration"))
            .filter(F.col("duration") >= threshold)
            .groupBy(F.window("Timestamp", every).alias("window"), "Name")
            .agg(F.count(F.lit(1)).alias("n_slow"),
                 F.max("duration").alias("max_duration"))
            .filter(F.col("n_slow") >= min_slow))


def query_hash_stats(env: DataFrame) -> DataFrame:
    """A4: per query hash: executions and total/min/max/mean duration."""
    d = F.col("duration")
    return (env.select(action("query_hash", "bigint").alias("query_hash"), duration().alias("duration"))
            .groupBy("query_hash")
            .agg(F.count(F.lit(1)).alias("executions"),
                 F.sum(d).alias("sum_duration"),
                 F.min(d).alias("min_duration"),
                 F.max(d).alias("max_duration"),
                 (F.sum(d).cast("double") / F.count(d)).alias("avg_duration")))


def regressions(env: DataFrame, min_ratio: float = 1.5) -> DataFrame:
    """A5: per query hash and UTC day, mean duration against the previous day with data;
    rows whose ratio reaches ``min_ratio``.  The window runs over the daily aggregate
    (hashes x days rows), never over raw events."""
    daily = (env.select(action("query_hash", "bigint").alias("query_hash"),
                        F.to_date("Timestamp").alias("day"), duration().alias("duration"))
             .groupBy("query_hash", "day")
             .agg(F.sum("duration").alias("sum_duration"), F.count("duration").alias("n")))
    w = Window.partitionBy("query_hash").orderBy("day")
    mean = F.col("sum_duration").cast("double") / F.col("n")
    return (daily.withColumn("mean_duration", mean)
            .withColumn("prev_day", F.lag("day").over(w))
            .withColumn("prev_mean_duration", F.lag("mean_duration").over(w))
            .withColumn("ratio", F.col("mean_duration") / F.col("prev_mean_duration"))
            .filter(F.col("ratio") >= min_ratio)
            .select("query_hash", "day", "prev_day", "mean_duration", "prev_mean_duration", "ratio"))


def workload(env: DataFrame, exact: bool = True) -> DataFrame:
    """Per application and hour of day: events and distinct query hashes."""
    h = F.col("query_hash")
    distinct = F.count_distinct(h) if exact else F.approx_count_distinct(h)
    return (env.select(action("client_app_name").alias("client_app_name"),
                       F.hour("Timestamp").alias("hour_of_day"),
                       action("query_hash", "bigint").alias("query_hash"))
            .groupBy("client_app_name", "hour_of_day")
            .agg(F.count(F.lit(1)).alias("n_events"), distinct.alias("n_query_hashes")))


# The audited kinds and the context columns lifted into the audit log.
AUDIT_KINDS = ("signup", "purchase")
AUDIT_COLUMNS = ("username", "client_hostname", "database_name", "client_app_name")


def audit_log(env: DataFrame, kinds: Sequence[str] = AUDIT_KINDS) -> DataFrame:
    """The audited kinds with who/where lifted to columns and the UTC day
    (the partition column of the append-only day-partitioned sink)."""
    return (env.filter(F.col("Name").isin(list(kinds)))
            .select("UUID", "Name", "Timestamp", F.to_date("Timestamp").alias("event_date"),
                    *[action(c).alias(c) for c in AUDIT_COLUMNS], "Actions", "Fields"))


# Failure kinds for security monitoring.
FAILURE_KINDS = ("error",)


def failure_bursts(env: DataFrame, min_failures: int = 3, every: str = "1 day",
                   kinds: Sequence[str] = FAILURE_KINDS) -> DataFrame:
    """Per user and window, users with at least ``min_failures`` failure events.
    Works on streaming frames with a watermark on ``Timestamp``."""
    return (env.filter(F.col("Name").isin(list(kinds)))
            .select(action("username").alias("username"), "Timestamp")
            .groupBy("username", F.window("Timestamp", every).alias("window"))
            .agg(F.count(F.lit(1)).alias("n_failures"))
            .filter(F.col("n_failures") >= min_failures))


# The capacity percentiles.
CAPACITY_PERCENTILES = (0.5, 0.95, 0.99)


def capacity_daily(env: DataFrame, exact: bool = True,
                   accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    """Per UTC day and database: events, total duration, p50/p95/p99 duration and
    encoded bytes.  Percentiles are nearest-rank (the smallest value whose cumulative
    share reaches p).  ``exact=True`` uses the radix selection of
    :mod:`eventlake.operators.quantiles` (no group is gathered in one task);
    ``exact=False`` uses the mergeable sketch, exact below ``accuracy`` rows per group."""
    base = env.select(F.to_date("Timestamp").alias("day"),
                      action("database_name").alias("database_name"),
                      duration().alias("duration"),
                      row_bytes("relational").alias("row_bytes"))
    keys = ["day", "database_name"]
    names = ["p50_duration", "p95_duration", "p99_duration"]
    if not exact:
        d = F.col("duration")
        pct = F.percentile_approx(d, list(CAPACITY_PERCENTILES), accuracy)
        return (base.groupBy(*keys)
                .agg(F.count(F.lit(1)).alias("n_events"), F.sum(d).alias("sum_duration"),
                     pct.alias("_p"), F.sum("row_bytes").alias("total_bytes"))
                .select(*keys, "n_events", "sum_duration",
                        *[F.col("_p")[i].alias(n) for i, n in enumerate(names)], "total_bytes"))
    # one scan: counts by (group, duration) feed both the sums and the exact percentiles
    pre, seen = cut_lineage(base.groupBy(*keys, "duration")
                            .agg(F.count(F.lit(1)).alias("c"), F.sum("row_bytes").alias("b")),
                            "capacity", metrics={"lo": F.min("duration"), "hi": F.max("duration")})
    sums = pre.groupBy(*keys).agg(F.sum("c").alias("n_events"),
                                  F.sum(F.col("duration") * F.col("c")).alias("sum_duration"),
                                  F.sum("b").alias("total_bytes"))
    pct = percentile_columns(pre, keys, "duration", CAPACITY_PERCENTILES, names,
                             weight_col="c", materialize=False, bounds=(seen["lo"], seen["hi"]))
    # both sides are per-group aggregates (one row per day x database)
    out = sums.join(pct, on=[sums[k].eqNullSafe(pct[k]) for k in keys], how="left")
    return out.select(*[sums[k] for k in keys], "n_events", "sum_duration", *names, "total_bytes")
