"""Keyed state on streams: deduplication that reads no target, and alerts that fire once.

Both keep their state in RocksDB through Spark's ``transformWithState``, so state is bounded by disk,
checkpointed with the query, and dropped by time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import ExitStack

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from eventlake.functions.envelope import ENVELOPE_COLUMNS, ENVELOPE_TEXT
from eventlake.operators.analytics import SLOW_THRESHOLD_US, duration
from eventlake.operators.capture import CORRUPT_COLUMN, CaptureSpec, capture
from eventlake.session import sql_conf
from eventlake.sinks.writers import label_valid
from eventlake.sources.readers import parse_payload
from eventlake.streaming.runner import BatchWriter, batch_key, daily_by_batch, idempotent_batch, plain_by_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR_MS = 3_600_000
NO_HOUR = -1
DIGEST = 16
SWEEP_MS = 60_000           # how often a group looks whether its hour is past
LATE = "later than the replay horizon"


def _start(df: DataFrame, writer, state_partitions: int | None, empty_batches: bool) -> StreamingQuery:
    """Start ``writer`` with keyed state; the query keeps its own copy of the settings."""
    spark = df.sparkSession
    with ExitStack() as settings:
        for key, value in (("spark.sql.streaming.stateStore.providerClass", ROCKSDB),
                           ("spark.sql.streaming.noDataMicroBatches.enabled", str(empty_batches).lower()),
                           ("spark.sql.shuffle.partitions", state_partitions)):
            settings.enter_context(sql_conf(spark, key, value))
        return writer.start()


# --- T6: deduplication in state --------------------------------------------------------------------

class SeenKeys(StatefulProcessor):
    """The keys seen in one hour of event time and one bucket of keys: 16-byte digests in a list, a piece per
    batch.  A group reads and extends its list once a batch, whatever the number of its rows; rows come and
    go as pandas frames, their numbers as text (pandas has no nulls among whole numbers).

    Yields each key's first row, with ``late`` false; rows of an hour that the watermark has passed
    cannot be judged any more and are yielded with ``late`` true."""

    def __init__(self, sweep_ms: int = SWEEP_MS):
        # a timer set for the present goes off at once, and setting it again would be lost with it
        self.sweep_ms = max(1, sweep_ms)

    def init(self, handle) -> None:
        self.handle = handle
        self.pieces = handle.getListState("pieces", "digests binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        hour = key[0]
        if hour != NO_HOUR and hour + HOUR_MS <= timerValues.getCurrentWatermarkInMs():
            for pdf in rows:
                yield pdf.assign(late=True)
            return
        seen, pieces = set(), 0
        for (piece,) in self.pieces.get():
            pieces += 1
            seen.update(piece[i:i + DIGEST] for i in range(0, len(piece), DIGEST))
        fresh = []
        for pdf in rows:
            first = []
            for at, (ts, row_key) in enumerate(zip(pdf["ts"].tolist(), pdf["row_key"].tolist(), strict=True)):
                own = hashlib.blake2b(f"{ts}:{row_key}".encode(), digest_size=DIGEST).digest()
                if own not in seen:
                    seen.add(own)
                    fresh.append(own)
                    first.append(at)
            if first:
                yield pdf.iloc[first].assign(late=False)
        if fresh:
            self.pieces.appendValue((b"".join(fresh),))
            if not pieces:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.sweep_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if key[0] != NO_HOUR and key[0] + HOUR_MS <= timerValues.getCurrentWatermarkInMs():
            self.pieces.clear()
        else:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.sweep_ms)
        return iter(())

    def close(self) -> None:
        pass


def first_arrivals(df: DataFrame, horizon: str, buckets: int, sweep_ms: int = SWEEP_MS) -> DataFrame:
    """A streaming envelope frame's rows with payloads as text: the first arrival of each (Timestamp, UUID),
    whatever the order of arrival, and rows more than ``horizon`` behind (by whole hours) with ``late``
    true.  The state holds 16 bytes a key, for hours within ``horizon`` of the newest event.

    Rows of one hour are dealt over ``buckets`` groups; choose it so that an hour's keys over it
    are some hundred thousand.  Rows without a timestamp are told apart, too, and never forgotten."""
    extra = [c for c in (CORRUPT_COLUMN,) if c in df.columns]
    row_text = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    own = F.coalesce("UUID", F.concat(F.lit("\u0000"), F.sha2(row_text, 256)))
    ms = F.unix_millis(F.date_trunc("hour", "Timestamp"))
    keyed = df.withWatermark("Timestamp", horizon).select(
        F.coalesce(ms, F.lit(NO_HOUR).cast("long")).alias("hour"),
        F.pmod(F.xxhash64(own), F.lit(buckets)).cast("int").alias("bucket"), own.alias("row_key"),
        F.unix_micros("Timestamp").cast("string").alias("ts"),
        *[(F.to_json(c) if c in ("Actions", "Fields") else F.col(c).cast("string")).alias(c)
          for c in ENVELOPE_COLUMNS if c != "Timestamp"], *extra)
    names = ["row_key", "ts", *[c for c in ENVELOPE_COLUMNS if c != "Timestamp"], *extra]
    schema = ", ".join(["hour long", "bucket int", *[f"`{c}` string" for c in names], "late boolean"])
    return keyed.groupBy("hour", "bucket").transformWithStateInPandas(SeenKeys(sweep_ms), schema, "append", "processingTime")


def _envelope(batch: DataFrame) -> DataFrame:
    """The text rows of :func:`first_arrivals` as an envelope frame with ``late``."""
    extra = [c for c in (CORRUPT_COLUMN,) if c in batch.columns]
    made = {"Timestamp": F.timestamp_micros(F.col("ts").cast("long")), "Actions": F.when(F.col("Actions").isNotNull(), parse_payload("Actions")),
            "Fields": F.when(F.col("Fields").isNotNull(), parse_payload("Fields"))}
    kinds = {f.name: f.dataType for f in ENVELOPE_TEXT.fields}
    return batch.select(*[made.get(c, F.col(c).cast(kinds[c])).alias(c) for c in ENVELOPE_COLUMNS], *extra, "late")


def run_state_dedup(source: DataFrame, specs: Sequence[CaptureSpec] | None, good_root: str, dead_root: str, checkpoint: str,
                    horizon: str = "1 day", buckets: int = 256, available_now: bool = True,
                    processing_time: str | None = None, write_good: BatchWriter = daily_by_batch,
                    state_partitions: int | None = None, sweep_ms: int = SWEEP_MS) -> StreamingQuery:
    """T3 with T6 in keyed state: like :func:`~eventlake.streaming.runner.run`, but a replay is known from state,
    so no batch reads the target, however its files are ordered.  Rows more than ``horizon`` behind the
    newest event go to the dead letter with their reason: they may be replays, and nobody can tell."""
    df = capture(source, specs, keep_broken=True) if specs else source
    arrivals = first_arrivals(df, horizon, buckets, sweep_ms)

    def write(batch: DataFrame, number: int) -> None:
        key = batch_key(batch, number)
        # persisted once: keyed state must not be asked twice for one batch
        labelled = label_valid(_envelope(batch)).withColumn(
            "reject_reason", F.coalesce("reject_reason", F.when(F.col("late"), F.lit(LATE)))).drop("late").persist()
        try:
            write_good(labelled.where("reject_reason is null").drop("reject_reason", CORRUPT_COLUMN), good_root, key)
            dead = labelled.where("reject_reason is not null")
            plain_by_batch(dead.select(*[F.to_json(c).alias(c) if c in ("Actions", "Fields") else F.col(c)
                                         for c in dead.columns]), dead_root, key)
        finally:
            labelled.unpersist()

    w = arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    # timers go with data batches: empty ones would follow each other for ever
    return _start(source, w, state_partitions, empty_batches=False)


# --- A3: alerts on crossing and recovery -------------------------------------------------------------

class AlertState(StatefulProcessor):
    """One kind's alert: raised by the first window at or above the threshold, cleared by the first one
    after it that is below, windows without any event included (a timer looks after them)."""

    def __init__(self, min_slow: int, window_ms: int):
        self.min_slow, self.window_ms = min_slow, window_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.high = handle.getValueState("high", "window_ms long")       # the newest high window of a raised alert

    def _change(self, key, window: int, state: str, n: int) -> Row:
        return Row(Name=key[0], window_ms=window, state=state, n_slow=n)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        high = self.high.get()[0] if self.high.exists() else None
        before = high
        for window, n in sorted((r.window_ms, r.n_slow) for r in rows):
            if high is not None and window > high + self.window_ms:
                yield self._change(key, high + self.window_ms, "cleared", 0)       # by a window without events
                high = None
            if n >= self.min_slow:
                if high is None:
                    yield self._change(key, window, "raised", n)
                high = window
            elif high is not None:
                yield self._change(key, window, "cleared", n)
                high = None
        if high != before:
            self._keep(before, high)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.high.exists():
            high = self.high.get()[0]
            if high + 2 * self.window_ms <= timerValues.getCurrentWatermarkInMs():
                self.high.clear()
                yield self._change(key, high + self.window_ms, "cleared", 0)

    def _keep(self, before: int | None, high: int | None) -> None:
        if before is not None:
            self.handle.deleteTimer(before + 2 * self.window_ms)
        if high is None:
            self.high.clear()
        else:
            self.high.update((high,))
            self.handle.registerTimer(high + 2 * self.window_ms)          # the end of the window after it

    def close(self) -> None:
        pass


def alert_transitions(env: DataFrame, min_slow: int = 3, threshold: int = SLOW_THRESHOLD_US, every_ms: int = HOUR_MS,
                      delay: str = "30 seconds") -> DataFrame:
    """A3 on a stream: a row (Name, window_ms, state ``raised`` or ``cleared``, n_slow) when a kind's slow events in a
    window reach ``min_slow``, and when they no longer do; nothing in between.  A window is judged once,
    when the watermark (``delay`` behind the newest event) has passed its end.

    Events are counted by window first, in the JVM and with partial aggregates; the keyed state sees one
    row a kind and window."""
    counted = (env.select("Timestamp", "Name", duration().alias("duration")).withWatermark("Timestamp", delay)
               .groupBy(F.window("Timestamp", f"{every_ms} milliseconds").alias("window"), "Name")
               .agg(F.count_if(F.col("duration") >= threshold).alias("n_slow")))
    rows = counted.select("Name", F.unix_millis("window.start").alias("window_ms"), "n_slow", F.window_time("window").alias("at"))
    return rows.groupBy("Name").transformWithState(AlertState(min_slow, every_ms), "Name string, window_ms long, state string, n_slow long",
                                                   "append", "eventTime")


def run_alerts(changes: DataFrame, root: str, checkpoint: str, available_now: bool = True, processing_time: str | None = None,
               state_partitions: int | None = None) -> StreamingQuery:
    """Append the changes of :func:`alert_transitions` under ``root``, a folder per query and batch (replay-safe)."""
    def write(batch: DataFrame, number: int) -> None:
        idempotent_batch(root, plain_by_batch)(batch, batch_key(batch, number))

    w = changes.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return _start(changes, w, state_partitions, empty_batches=True)
