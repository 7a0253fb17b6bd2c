"""T1/T2 with feedback: the size of the next trigger follows how long the last ones took.

A source's limit is fixed while a query runs, so a run is a series of queries on one checkpoint: a
listener hears each batch's size and duration, and when the limit that would make batches last
``target_seconds`` is far from the present one, the query is stopped and goes on with the new limit.
A batch that was planned before that keeps its size (its offsets are in the checkpoint) and is
replayed as it was, so nothing is lost or read twice.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from eventlake.streaming.runner import drain


@dataclass
class RateController:
    """The limit (files, bytes or offsets a trigger) for batches of ``target_seconds``, from ``least`` to ``most``.

    A batch's duration per unit of the limit is smoothed (``weight`` for the newest).  A batch that was not full
    says how long rows take, not that the limit is small.  The limit moves only when it would by more than
    ``factor``: a restart costs time."""

    limit: int
    target_seconds: float
    least: int = 1
    most: int = 1 << 20
    weight: float = 0.5
    factor: float = 1.5
    per_row: float | None = field(default=None, init=False)
    rows_each: float | None = field(default=None, init=False)

    def __post_init__(self):
        if not 1 <= self.least <= self.limit <= self.most or self.target_seconds <= 0:
            raise ValueError("1 <= least <= limit <= most and a positive target are needed")

    def heard(self, rows: int, seconds: float) -> bool:
        """Take in a batch; whether the limit has changed."""
        if rows <= 0:
            return False
        own = max(seconds, 1e-3) / rows
        self.per_row = own if self.per_row is None else self.weight * own + (1 - self.weight) * self.per_row
        # units hold like numbers of rows; a batch that was not full holds fewer
        self.rows_each = max(rows / self.limit, self.rows_each or 0.0)
        want = round(self.target_seconds / (self.per_row * self.rows_each))
        want = min(self.most, max(self.least, want))
        if want > self.limit * self.factor or want * self.factor < self.limit:
            # at most fourfold at once: the first batches also pay for starting up
            self.limit, old = min(want, self.limit * 4), self.limit
            self.rows_each = None
            return self.limit != old
        return False


class _Heard(StreamingQueryListener):
    """Passes the batches of one run on to the controller."""

    def __init__(self, controller: RateController):
        self.controller, self.run_id, self.changed, self.batches = controller, None, threading.Event(), []

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if str(p.runId) != self.run_id or not p.numInputRows:
            return
        self.batches.append((p.batchId, p.numInputRows, self.controller.limit))
        if not self.changed.is_set() and self.controller.heard(p.numInputRows, p.batchDuration / 1000):
            self.changed.set()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def drain_adaptive(spark: SparkSession, start: Callable[[int], StreamingQuery], controller: RateController,
                   poll_seconds: float = 0.05) -> list[tuple[int, int, int]]:
    """Process everything available with triggers sized by ``controller``; (batch, rows, limit) of each.

    ``start(limit)`` starts the query with ``availableNow`` on its checkpoint, its source limited to ``limit``."""
    heard = _Heard(controller)
    spark.streams.addListener(heard)
    try:
        while True:
            heard.changed.clear()
            query = start(controller.limit)
            heard.run_id = str(query.runId)
            while query.isActive and not heard.changed.is_set():
                query.awaitTermination(poll_seconds)
            if not heard.changed.is_set():
                drain(query)
                return heard.batches
            query.stop()
    finally:
        spark.streams.removeListener(heard)
