"""Batch ingest: capture -> constraint check -> dedup, also against what is stored -> one write.

Good rows and dead letters go to the same root, partitioned by ``status`` and ``event_date``, so
readers prune on ``status``.  A narrow pass over the keys comes first: it finds the keys that
stand more than once in the delivery and those that the table's key index holds.  Without such keys,
as in most first deliveries, the rows are written without being shuffled for it; otherwise they meet
those keys in one join, and only rows of repeated new keys meet in an aggregate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import folders
from eventlake.operators.capture import CaptureSpec, capture
from eventlake.session import cut_lineage
from eventlake.sinks.keyindex import KEY, KeyIndex, key_columns
from eventlake.sinks.writers import dedup_key, reject_reason, writer_options

GOOD, DEAD = "good", "dead"
REPLAYED = "_replayed"              # the ledger of settled dead letters, likewise
INDEX = "_keys"                     # under the table's root; readers skip names with an underscore


def labelled(captured: DataFrame) -> DataFrame:
    """Rows with ``reject_reason``, ``row_key`` (NULL for a good row, whose key is its UUID, else a hash of
    the whole row, corrupt text included, so that a dead row only meets its exact copy) and ``lineage``
    (NULL; for a repaired row, the key of the dead one)."""
    text = F.to_json(F.struct(*[F.col(c) for c in captured.columns]))
    out = captured.withColumn("reject_reason", reject_reason(tuple(captured.columns)))
    out = out.withColumn("row_key", F.when(F.col("reject_reason").isNotNull(), F.concat(F.lit("dead:"), F.sha2(text, 256))))
    return out.withColumn("lineage", F.lit(None).cast("string"))


def with_key(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``row_key``) and their index key."""
    return rows.select("*", *key_columns(F.coalesce("row_key", "UUID")))


def stored_keys(spark: SparkSession, root: str) -> DataFrame:
    """The index keys of every row under ``root``."""
    if "row_key" not in spark.read.parquet(root).columns:
        raise ValueError(f"{root} was not written by ingest: its dead letters have no row_key")
    return with_key(spark.read.parquet(root).select("UUID", "row_key", "Timestamp")).select(*KEY)


def ingest(df: DataFrame, specs: Sequence[CaptureSpec] | None, root: str,
           compression: str | None = None, batch_size: int | None = None, unique: bool = True) -> None:
    """Append captured, deduplicated, checked events under ``root``:
    ``status=good/event_date=D`` for rows that pass, ``status=dead/...`` with a
    ``reject_reason`` for rows that break a constraint.  The constraints are judged before the
    predicates, so a broken row of a declared kind is a dead letter, never dropped.

    ``unique``: a key that is stored already is not stored again, so a delivery may be ingested any
    number of times, after a failure or by mistake (one run at a time).  Of rows with one key in
    a delivery, the earliest stays."""
    captured = capture(df, specs, keep_broken=True) if specs else df
    append(labelled(captured), root, compression, batch_size, unique)


def append(rows: DataFrame, root: str, compression: str | None = None, batch_size: int | None = None,
           unique: bool = True) -> None:
    """:func:`ingest` for rows that are :func:`labelled`; further columns are stored with them."""
    spark, root = rows.sparkSession, root.rstrip("/")
    index = KeyIndex(spark, f"{root}/{INDEX}")
    keyed = with_key(rows)
    batch = cut_lineage(keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")), "ingest-keys")
    if unique and folders.exists(spark, root):
        index.heal(stored_keys(spark, root), batch)
        batch = cut_lineage(index.marked(batch), "ingest-known")
    else:
        batch = batch.withColumn("known", F.lit(None).cast("boolean"))
    fresh = batch.where("known is null")
    found = batch.agg(F.count_if(F.expr("known is null")).alias("fresh"), F.count("known").alias("known"),
                      F.count_if(F.expr("n > 1 and known is null")).alias("repeated")).first()
    if not found["fresh"]:
        return
    out = keyed
    if found["known"] or found["repeated"]:
        # the rows are evaluated and shuffled once, for both
        met = batch.where("known or n > 1").select(*KEY, F.col("known").alias("__known"), F.col("n").alias("__n"))
        out = keyed.join(met, KEY, "left").where("__known is null")
    if found["repeated"]:
        # only rows whose keys stand more than once meet in an aggregate
        out = cut_lineage(out, "ingest-fresh")
        again = dedup_key(out.where("__n is not null").select(*keyed.columns), keys=tuple(KEY))
        out = out.where("__n is null").select(*keyed.columns).unionByName(again)
    out = (out.select(*rows.columns)
           .withColumn("status", F.when(F.col("reject_reason").isNull(), F.lit(GOOD)).otherwise(F.lit(DEAD)))
           .withColumn("event_date", F.to_date("Timestamp")))
    (out.hint("rebalance", F.col("status"), F.col("event_date"))
        .write.mode("append").partitionBy("status", "event_date")
        .options(**writer_options(compression, batch_size)).parquet(root))
    if unique:
        index.add(fresh.select(*KEY))


def read_status(spark: SparkSession, root: str, status: str = GOOD) -> DataFrame:
    """Rows of one status (partition-pruned), without the bookkeeping columns."""
    df = spark.read.parquet(root).filter(F.col("status") == status)
    drop = ["status", "row_key", "lineage"] + (["reject_reason"] if status == GOOD else [])
    return df.drop(*drop)


# --- T7: dead letters come back -----------------------------------------------------------------------

def pending_dead(spark: SparkSession, root: str) -> DataFrame:
    """Dead letters that no replay has settled, with their ``row_key`` and ``reject_reason``."""
    dead = spark.read.parquet(root).where(F.col("status") == DEAD).drop("status", "event_date", "lineage")
    ledger = f"{root.rstrip('/')}/{REPLAYED}"
    if not folders.exists(spark, ledger):
        return dead
    settled = spark.read.schema("row_key string, run string").parquet(ledger).select("row_key")
    return dead.join(settled, "row_key", "left_anti")


def replay_dead(spark: SparkSession, root: str, repair: Callable[[DataFrame], DataFrame], run: str | None = None) -> dict[str, int]:
    """Repair the pending dead letters under ``root`` and ingest those that are whole now.

    ``repair`` maps dead rows to rows of the same columns (it keeps ``row_key``; rows that it leaves out stay
    pending).  A repaired row that breaks no constraint enters the table like a delivery, with the dead row's
    key as its ``lineage``, unless its own key is stored already; either way the ledger settles it under
    ``run``.  Rows that are still broken stay pending.  The ledger is written after the rows: a replay that was
    lost in between is made again and stores nothing twice.  Returns the numbers of rows."""
    before = pending_dead(spark, root)
    fixed = repair(before)
    columns = [c for c in before.columns if c not in ("reject_reason", "row_key")]
    again = labelled(fixed.select(*columns, F.col("row_key").alias("dead_key"))).withColumn("lineage", F.col("dead_key"))
    again = again.drop("dead_key")
    # repaired once: the repair may be costly, and rows and ledger must agree on it
    whole = cut_lineage(again.where("reject_reason is null"), "replay")
    n = whole.select("lineage").distinct().count()
    if n:
        append(whole, root)
        (whole.select(F.col("lineage").alias("row_key"), F.lit(run or uuid.uuid4().hex).alias("run")).distinct()
         .write.mode("append").parquet(f"{root.rstrip('/')}/{REPLAYED}"))
    return {"settled": n, "pending": pending_dead(spark, root).count()}


def with_lineage(spark: SparkSession, root: str) -> DataFrame:
    """Good rows with the key of the dead letter they came from (NULL: delivered whole)."""
    return spark.read.parquet(root).where(F.col("status") == GOOD).drop("status", "row_key", "reject_reason")
