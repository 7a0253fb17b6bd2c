"""Streaming operators (T1-T7) on Structured Streaming.

Source -> capture -> constraint split -> dedup -> sink, restartable from its
checkpoint.  Micro-batches are cut by the source's rate limits (T1/T2), a drain
is ``availableNow`` (T4), restart is the checkpoint plus batch-keyed idempotent
writes (T5), late data is bounded by a watermark (T6), and rows that break a
constraint go to a dead-letter table instead of failing or vanishing (T7).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.operators.capture import CaptureSpec, capture
from eventlake.session import cut_lineage, sql_conf
from eventlake.sinks.writers import dedup_key, label_valid, with_event_date

# The source's maximum dispatch latency, used as the default watermark.
DEFAULT_WATERMARK = "30 seconds"


def rate_options(max_files: int | None = None, max_bytes: str | None = None,
                 max_offsets: int | None = None, min_offsets: int | None = None,
                 max_trigger_delay: str | None = None) -> dict[str, str]:
    """How much one micro-batch may take (backpressure by bounded batches).

    ``min_offsets`` (Kafka) holds a trigger until that many new records are there, i.e.
    batches by count; ``max_trigger_delay`` flushes a partial batch after that long, so a
    quiet stream never holds records back indefinitely."""
    opts = {}
    if max_files is not None:
        opts["maxFilesPerTrigger"] = str(max_files)
    if max_bytes is not None:
        opts["maxBytesPerTrigger"] = str(max_bytes)
    if max_offsets is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_offsets is not None:
        opts["minOffsetsPerTrigger"] = str(min_offsets)
    if max_trigger_delay is not None:
        opts["maxTriggerDelay"] = str(max_trigger_delay)
    return opts


def dedup_stream(df: DataFrame, watermark: str = DEFAULT_WATERMARK,
                 keys: tuple[str, ...] = ("Timestamp", "UUID")) -> DataFrame:
    """T6 (+K6): drop replays of a key seen within the watermark; state stays bounded."""
    return dedup_key(df.withWatermark("Timestamp", watermark), keys)


BatchWriter = Callable[[DataFrame, str, int | str], None]


def batch_key(batch: DataFrame, batch_id: int) -> str:
    """The batch's number together with its query's id: a second checkpoint, or a reset one, on
    the same target is another query and never overwrites the first one's output."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}" if query else str(batch_id)


def path_exists(spark, path: str) -> bool:
    """Whether a folder is there (any other failure to look is an error, not an absence)."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(own.getFileSystem(spark._jsc.hadoopConfiguration()).exists(own))


def daily_by_batch(batch: DataFrame, root: str, batch_id: int | str) -> None:
    """Good rows of batch N under ``root/event_date=D/batch_id=N``.  Dynamic partition
    overwrite replaces exactly the (day, batch) folders the batch writes, so a replay of
    the same offsets replaces its own output; day-first folders keep every read of a day
    (queries, keep-late dedup, compaction) pruned to that day."""
    # the key as text with a letter first, so that a reader never takes it for a number
    (with_event_date(batch).withColumn("batch_id", F.lit(f"b{batch_id}"))
        .hint("rebalance", F.col("event_date"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "batch_id").parquet(root))


def plain_by_batch(batch: DataFrame, root: str, batch_id: int | str) -> None:
    """Rows of batch N under ``root/batch_id=N`` (dead letters, aggregate update logs)."""
    batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def sorted_by_batch(table) -> BatchWriter:
    """Good rows of each batch as a run of a :class:`~eventlake.sinks.sorted_table.SortedTable`, whose
    merges follow; the batch number is committed with the run, so a replay stores nothing twice."""
    def write(batch: DataFrame, root: str, batch_id: int | str) -> None:
        query, _, number = str(batch_id).rpartition("-")
        table.append(batch, batch=(query, int(number)))
    return write


def jdbc_by_batch(sink) -> BatchWriter:
    """Good rows of each batch into a relational table, once, with its ledger in the same transaction
    (:class:`~eventlake.sinks.jdbc_ledger.JdbcLedgerSink`)."""
    def write(batch: DataFrame, root: str, batch_id: int | str) -> None:
        query, _, number = str(batch_id).rpartition("-")
        sink.store(batch, query, int(number))
    return write


def idempotent_batch(root: str, write: BatchWriter = daily_by_batch):
    """T5: a ``foreachBatch`` function whose writes are keyed by the batch id with
    overwrite, so a replay after a failure replaces, never duplicates."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, root, batch_id)
    return run


def dedup_against_target(batch: DataFrame, good_root: str, batch_id: int | str,
                         keys: tuple[str, ...] = ("Timestamp", "UUID")) -> DataFrame:
    """T6, late rows kept: drop the batch's rows whose key is already stored.

    Instead of a watermark (which drops late rows), each micro-batch is deduplicated
    within itself and then anti-joined with the stored keys of the UTC days it touches
    (the batch's first and last day are literals in the filter, so the scan is pruned to
    them when it is planned).  The
    batch's own earlier output is excluded, so a replay of batch N does not find itself."""
    fresh = dedup_key(batch, keys)
    spark = batch.sparkSession
    if not path_exists(spark, good_root):
        return fresh
    day = F.to_date("Timestamp")
    first, last = batch.agg(F.min(day), F.max(day)).first()
    if first is None:
        return fresh
    folders = [p for p in _day_folders(spark, good_root) if str(first) <= p <= str(last)]
    if not folders:
        return fresh
    stored = (spark.read.schema(batch.select(*keys).schema.add("event_date", "date").add("batch_id", "string"))
              .option("basePath", good_root).parquet(*[f"{good_root}/event_date={p}" for p in folders]))
    seen = stored.filter(F.col("batch_id") != f"b{batch_id}").select(*keys)
    return fresh.join(seen, list(keys), "left_anti")


def _day_folders(spark, root: str) -> list[str]:
    """The days stored under ``root`` (one listing of its top level)."""
    own = spark._jvm.org.apache.hadoop.fs.Path(root)
    names = [s.getPath().getName() for s in own.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(own)]
    return sorted(n.removeprefix("event_date=") for n in names if n.startswith("event_date="))


def with_dead_letter(good_root: str, dead_root: str, write_good: BatchWriter = daily_by_batch,
                     keep_late: bool = False):
    """Split each micro-batch by the row constraints; good rows to the sink, broken
    rows with their reason to the dead letter.  Both writes are keyed by batch id.
    The batch is labelled once and persisted so the two writes share one computation; it is dealt over
    tasks by size first, since a source's splits (whole row groups of compressed files) may be few.
    ``keep_late`` deduplicates good rows against the stored target (late rows kept)."""
    def run(batch: DataFrame, number: int) -> None:
        batch_id = batch_key(batch, number)
        labelled = label_valid(batch).hint("rebalance", F.col("Timestamp"), F.col("UUID")).persist()
        try:
            good = labelled.filter(F.col("reject_reason").isNull()).drop("reject_reason")
            if keep_late:
                good = dedup_against_target(good, good_root, batch_id)
            dead = labelled.filter(F.col("reject_reason").isNotNull())
            write_good(good, good_root, batch_id)
            to_text = dead.select(*[F.to_json(c).alias(c) if c in ("Actions", "Fields") else F.col(c)
                                    for c in dead.columns])
            plain_by_batch(to_text, dead_root, batch_id)
        finally:
            labelled.unpersist()
    return run


def run(source: DataFrame, specs: Sequence[CaptureSpec] | None, good_root: str, dead_root: str,
        checkpoint: str, watermark: str | None = None, available_now: bool = True,
        processing_time: str | None = None, write_good: BatchWriter = daily_by_batch,
        keep_late: bool | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """The continuous ingest job.  ``available_now`` drains what is there and stops
    (T4); otherwise it runs on ``processing_time`` triggers until stopped.

    Deduplication: by default (``keep_late``) every batch is deduplicated against the stored
    days it touches, so no row is lost for being late.  With ``watermark`` set instead,
    replays within it are dropped in the stream's state, and rows later than it are dropped:
    a caller chooses that.  ``keep_late=False`` without a watermark does not deduplicate.  ``state_partitions`` fixes the state store's partition count at the
    first start (it is then kept in the checkpoint); default: the session setting."""
    if keep_late and watermark is not None:
        raise ValueError("keep_late deduplicates against the target; pass watermark=None")
    if keep_late is None:
        keep_late = watermark is None and write_good is daily_by_batch
    df = capture(source, specs, keep_broken=True) if specs else source
    if watermark is not None:
        # rows without a UUID (broken or corrupt input) are dead letters: each distinct one is
        # kept, only exact copies collapse (the key is a hash of the whole row)
        row_text = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
        key = F.coalesce(F.col("UUID"), F.concat(F.lit("\u0000"), F.sha2(row_text, 256)))
        df = dedup_stream(df.withColumn("_dedup_key", key), watermark,
                          keys=("Timestamp", "_dedup_key")).drop("_dedup_key")
    w = (df.writeStream.foreachBatch(with_dead_letter(good_root, dead_root, write_good, keep_late))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    with sql_conf(source.sparkSession, "spark.sql.shuffle.partitions", state_partitions):
        return w.start()


def drain(query: StreamingQuery, running: bool = False) -> None:
    """T4: wait, however long, until everything available is processed; raise if the query
    failed.  ``running``: the query runs on a trigger; finish what is there, then stop it."""
    if running:
        query.processAllAvailable()
        query.stop()
    else:
        query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"streaming query failed: {query.exception()}")


def compact_day(spark, good_root: str, table_root: str, day: str) -> None:
    """Fold one UTC day from its per-batch folders into a day-partitioned table.

    A long-running stream leaves one ``event_date=D/batch_id=N`` folder per micro-batch and
    day; once a day is closed (past the watermark) its rows are rewritten here,
    deduplicated, as ``table_root/event_date=day``.  Dynamic partition overwrite replaces
    only that day, so a rerun after a failure is idempotent; the read prunes to the day's
    folder, and that one folder is what a retention job removes afterwards."""
    pick = F.col("event_date") == F.lit(day).cast("date")
    rows = spark.read.parquet(good_root).filter(pick).drop("batch_id", "event_date")
    # the table's own rows of the day stay: rows that arrived after an earlier compaction join them
    if path_exists(spark, f"{table_root.rstrip('/')}/event_date={day}"):
        rows = rows.unionByName(spark.read.parquet(table_root).filter(pick).drop("event_date"))
    # written apart first: the day's partition is read here and replaced below
    out = with_event_date(cut_lineage(dedup_key(rows), "compact"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date").parquet(table_root))


def retire_day(spark, good_root: str, table_root: str, day: str) -> bool:
    """Remove a compacted day's per-batch folder (``good_root/event_date=day``), but only
    after checking that the table holds every (Timestamp, UUID) staged for that day.  Returns False, deleting nothing, when the check fails or nothing is there."""
    pick = F.col("event_date") == F.lit(day).cast("date")
    for root in (good_root, table_root):
        if not path_exists(spark, f"{root.rstrip('/')}/event_date={day}"):
            return False
    keys = ["Timestamp", "UUID"]
    before = _batches(spark, good_root, day)
    staged = spark.read.parquet(good_root).filter(pick).select(*keys)
    stored = spark.read.parquet(table_root).filter(pick).select(*keys)
    if staged.join(stored, keys, "left_anti").limit(1).collect() or _batches(spark, good_root, day) != before:
        return False                        # something is not in the table, or arrived meanwhile
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(f"{good_root.rstrip('/')}/event_date={day}")
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(jvm_path, True))


def _batches(spark, root: str, day: str) -> list[str]:
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/event_date={day}")
    return sorted(s.getPath().getName() for s in own.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(own))


def versions_by_batch(batch: DataFrame, root: str, number: int) -> None:
    """The groups that a batch changed under ``root/query=Q/batch_id=N``: a replay replaces them, and another
    query, or a new checkpoint, on the same log never touches them."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    (batch.withColumn("written_ms", F.lit(int(time.time() * 1000)))
        .write.mode("overwrite").parquet(f"{root}/query=q{query}/batch_id={number}"))


def run_aggregate(agg: DataFrame, root: str, checkpoint: str, available_now: bool = True,
                  processing_time: str | None = None,
                  state_partitions: int | None = None) -> StreamingQuery:
    """Streaming aggregate in update mode: each micro-batch writes the groups it changed
    to ``root/query=Q/batch_id=N`` (replay-safe).  With a watermark on the input, state for
    closed windows is dropped, so state stays bounded on an endless stream."""
    w = (agg.writeStream.outputMode("update")
         .foreachBatch(lambda batch, number: versions_by_batch(batch, root, number))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    with sql_conf(agg.sparkSession, "spark.sql.shuffle.partitions", state_partitions):
        return w.start()


def latest_versions(spark, root: str, keys: Sequence[str], across: Mapping[str, str] | None = None) -> DataFrame:
    """Current value of every group in an update log written by :func:`run_aggregate`: of each query the
    version of its highest batch number (an aggregate, not a scan per key).

    Several queries on one log: by default the query that started last has a group (it began anew on the same
    input).  ``across`` (value column -> ``sum``, ``max`` or ``min``) merges queries that read different inputs."""
    log = spark.read.parquet(root)
    values = [c for c in log.columns if c not in (*keys, "query", "batch_id", "written_ms")]
    own = log.groupBy(*keys, "query").agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("v"))
    if across is not None:
        if set(across) != set(values) or not set(across.values()) <= {"sum", "max", "min"}:
            raise ValueError(f"each of {values} needs sum, max or min")
        return own.groupBy(*keys).agg(*[getattr(F, across[c])(f"v.{c}").alias(c) for c in values])
    started = log.groupBy("query").agg(F.min("written_ms").alias("started"))      # a row per query
    newest = own.join(started, "query").groupBy(*keys).agg(F.max_by("v", F.struct("started", "query")).alias("v"))
    return newest.select(*keys, "v.*")
