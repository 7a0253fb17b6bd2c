"""Session helpers.

The library needs two session settings and nothing else:

* ``spark.sql.session.timeZone = UTC``: event timestamps are instants, the
  day/hour buckets and ISO renderings are defined in UTC.
* a *shared* scratch location for lineage cuts and sink round-trips.  On a
  cluster this is ``spark.checkpoint.dir`` (set by whoever runs the cluster);
  only when it is unset (tests, a laptop) do we create one under the local temp
  directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings for a large cluster (~100 TB of events, ~1000 executors).  Shuffle partitions
# start high and AQE coalesces them to the advisory size; skewed shuffle partitions are
# split; scans read 256 MB splits; Parquet timestamps are written as microseconds.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


# Target bytes per reduce partition for full-data shuffles (sort-based
# shuffle spills beyond memory, so ~1 GB per task is safe and keeps the task count down).
SHUFFLE_TARGET_BYTES = 1 << 30


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = SHUFFLE_TARGET_BYTES,
                           floor: int = 200) -> int:
    """Initial shuffle partitions for a shuffle of ``shuffle_bytes``.  AQE can merge small
    partitions but not split big ones (skew aside), so the initial count must cover the
    largest shuffle of a job: K6 dedup, V1 distinct and the S4 sort move whole rows."""
    return max(floor, -(-int(shuffle_bytes) // int(target_bytes)))


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply :data:`CLUSTER_CONF` (plus ``overrides``) to a running session.  All of these
    are SQL settings, changeable at runtime; nothing outside the session is touched."""
    for key, value in {**CLUSTER_CONF, **(overrides or {})}.items():
        spark.conf.set(key, value)


def build_session(master: str | None = None, app_name: str = "eventlake",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    """Session with the settings the library is tuned for (used by tests and bench)."""
    cores = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cores}]"
    parts = shuffle_partitions or int(cores)
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("EVENTLAKE_DRIVER_MEMORY", "16g"))
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (day and hour buckets are UTC by definition)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def sql_conf(spark: SparkSession, key: str, value: str | None):
    """Set a SQL setting for the duration of a block and restore it afterwards (used to
    fix a streaming query's state partitions when it starts; the started query keeps
    its own copy of the session settings, and its checkpoint records the count)."""
    if value is None:
        yield
        return
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a local one only when none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no classic context (Spark Connect): config only
        sc = None
    root = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get(_CHECKPOINT_CONF, None)
    if not root:
        # no shared folder configured (tests, a laptop): a local one, this process only
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="eventlake-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/eventlake-scratch/{label}-{uuid.uuid4().hex}"


def cut_lineage(df, label: str = "stage", metrics: dict | None = None):
    """Materialise a frame as Parquet in the shared checkpoint folder and read it back.

    Columnar, compressed and readable by any executor after a loss; cheaper than an RDD
    ``checkpoint()`` (which Java-serialises rows).  Used where a frame is re-read by
    several later passes.  ``metrics`` (name -> aggregate Column) are observed during the
    same write, with no extra job; their values are returned as a second result."""
    from pyspark.sql import Observation

    path = scratch_path(df.sparkSession, label)
    obs = None
    if metrics:
        obs = Observation(f"{label}-metrics")
        df = df.observe(obs, *[c.alias(n) for n, c in metrics.items()])
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    return (back, obs.get) if metrics else back
