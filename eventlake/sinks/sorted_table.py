"""K1 with background merges: an append table in key order that stays cheap to search.

Every append is one *run*: files in key order that do not overlap but for equal keys.  Runs belong
to tiers; when a tier holds ``fanout`` runs, they are merged into one run of the next tier, so N
appends leave at most ``(fanout - 1) * (log_fanout(N) + 1)`` runs, and a row is rewritten once
a tier.  A run's files carry their key ranges in the manifest, so a key range opens the files
that overlap it: a few of each run, however many appends there were.

A manifest is a small table of files (tier, run, path, smallest and largest key, rows), written
as a new version by each commit; readers take the newest complete one.  What a lost append or
merge wrote is in no manifest.  A streaming query's newest batch number is in it, too, so a batch
and the fact that it was stored are one commit and a replay finds itself.  One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import folders
from eventlake.sinks.writers import writer_options

KEY = "UUID"
TIE = "XEventStartOffsetInBytes"
FANOUT = 4
FILE_ROWS = 4_000_000
BATCH = -1              # the tier of manifest rows that hold a query's newest batch number in n
MANIFEST = "tier int, run string, path string, low string, high string, n bigint"


class SortedTable:
    """An append table under ``root`` in the order of ``key`` (``tie`` splits a run of one key over files)."""

    def __init__(self, spark: SparkSession, root: str, key: str = KEY, tie: str = TIE, fanout: int = FANOUT,
                 file_rows: int = FILE_ROWS, compression: str | None = None):
        if fanout < 2:
            raise ValueError("a tier needs at least two runs to merge")
        self.spark, self.root = spark, root.rstrip("/")
        self.key, self.tie, self.fanout, self.file_rows = key, tie, fanout, file_rows
        self.options = writer_options(compression, kind="sorted")

    # --- manifest ------------------------------------------------------------------------------

    def version(self) -> int:
        """The newest complete manifest (0: none).  A manifest is a Spark write, complete with _SUCCESS."""
        names = [int(v[1:]) for v in folders.children(self.spark, f"{self.root}/manifest") if v[1:].isdigit()]
        return max((v for v in names if folders.exists(self.spark, f"{self.root}/manifest/v{v}/_SUCCESS")), default=0)

    def _all(self) -> DataFrame:
        v = self.version()
        if not v:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/v{v}")

    def manifest(self) -> DataFrame:
        """The live files."""
        return self._all().where(F.col("tier") != BATCH)

    def last_batch(self, query: str) -> int:
        """The newest stored batch of a streaming query (-1: none)."""
        row = self._all().where((F.col("tier") == BATCH) & (F.col("run") == query)).agg(F.max("n")).first()
        return -1 if row[0] is None else row[0]

    def runs(self) -> list[tuple[int, str, int]]:
        """(tier, run, rows) of the live runs, oldest tier last."""
        rows = self.manifest().groupBy("tier", "run").agg(F.sum("n").alias("n")).orderBy("tier", "run").collect()
        return [(r["tier"], r["run"], r["n"]) for r in rows]

    def _commit(self, added: DataFrame, gone: list[str]) -> None:
        live = self._all().where(~F.col("run").isin(gone)) if gone else self._all()
        # a lost commit may have left a part of the next version
        (live.unionByName(added).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v{self.version() + 1}"))

    # --- writing -------------------------------------------------------------------------------

    def _write(self, df: DataFrame, rows: int, tier: int) -> DataFrame:
        """One run of ``df``'s rows; the manifest rows of its files."""
        run = f"{tier}-{self.version() + 1:08d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/runs/{run}"
        files = max(1, -(-rows // self.file_rows))
        out = df.repartitionByRange(files, F.col(self.key).asc_nulls_first(), F.col(self.tie)) if files > 1 else df.repartition(1)
        out.sortWithinPartitions(self.key, self.tie).write.options(**self.options).parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        at = F.col("_metadata.file_path")
        return (back.select(F.col(self.key).alias("k"), at.alias("path")).groupBy("path")
                .agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("n"))
                .select(F.lit(tier).alias("tier"), F.lit(run).alias("run"), "path", "low", "high", "n"))

    def append(self, df: DataFrame, rows: int | None = None, batch: tuple[str, int] | None = None) -> None:
        """Append ``df`` as a run of the lowest tier, then merge what is due.  ``rows``: their number,
        if known (it sets the number of files).  No rows, no run.  ``batch`` (streaming query, number):
        a batch that is stored already, or an older one, is not stored again."""
        if batch is not None and batch[1] <= self.last_batch(batch[0]):
            return
        n = df.count() if rows is None else rows
        if n:
            added = self._write(df, n, 0)
            if batch is not None:
                added = added.unionByName(self.spark.createDataFrame([(BATCH, batch[0], "", None, None, batch[1])], MANIFEST))
            self._commit(added, [batch[0]] if batch is not None else [])
            self.merge_due(df.schema)

    def merge_due(self, schema=None) -> int:
        """Merge every tier that is full, lowest first; returns the number of merges."""
        done, tier = 0, 0
        live = self.runs()
        while tier <= max((t for t, _, _ in live), default=-1):
            full = [(run, n) for t, run, n in live if t == tier]
            if len(full) >= self.fanout:
                self._merge(full, tier + 1, schema)
                done, live = done + 1, self.runs()
            tier += 1
        return done

    def _merge(self, runs: list[tuple[str, int]], tier: int, schema) -> None:
        paths = [f"{self.root}/runs/{run}" for run, _ in runs]
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        self._commit(self._write(reader.parquet(*paths), sum(n for _, n in runs), tier), [run for run, _ in runs])

    def vacuum(self) -> list[str]:
        """Remove the folders of runs that are in no manifest (merged away, or left by a lost write), and
        older manifests.  No reader may be on an older version."""
        live = {run for _, run, _ in self.runs()}
        gone = [r for r in folders.children(self.spark, f"{self.root}/runs") if r not in live]
        for run in gone:
            folders.remove(self.spark, f"{self.root}/runs/{run}")
        for v in folders.children(self.spark, f"{self.root}/manifest"):
            if v != f"v{self.version()}":
                folders.remove(self.spark, f"{self.root}/manifest/{v}")
        return gone

    # --- reading -------------------------------------------------------------------------------

    def files(self, low: str | None = None, high: str | None = None) -> DataFrame:
        """The manifest rows of the files that may hold keys from ``low`` to ``high`` (inclusive)."""
        out = self.manifest()
        if low is not None:
            out = out.where(F.col("high") >= low)
        if high is not None:
            out = out.where(F.col("low") <= high)
        return out

    def read(self, low: str | None = None, high: str | None = None) -> DataFrame | None:
        """Rows with keys from ``low`` to ``high`` (inclusive; a null key is in no range); None for a table
        without rows.  A whole read opens run folders; a range opens the files that overlap it."""
        if low is None and high is None:
            paths = [f"{self.root}/runs/{run}" for _, run, _ in self.runs()]
            return self.spark.read.parquet(*paths) if paths else None
        paths = sorted(r["path"] for r in self.files(low, high).select("path").collect())
        if not paths:
            whole = self.read()
            return None if whole is None else whole.limit(0)
        out = self.spark.read.parquet(*paths)
        out = out if low is None else out.where(F.col(self.key) >= low)
        return out if high is None else out.where(F.col(self.key) <= high)
