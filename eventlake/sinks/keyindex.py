"""K6 over what is stored: an index of the keys of each UTC day, probed before an append.

``keys/day=D/words=W`` holds the keys themselves, sorted by word; ``filter/day=D/words=W`` holds a
Bloom filter over them as rows ``(word, bits)``: a key sets :data:`BITS` bits of one 64-bit word of
``W`` (a power of two, about :data:`WORD_KEYS` keys a word), so a run's filter is one aggregate and
a probe one equi-join.  Only the files of the days that a delivery's keys fall on are read.  A
delivery of few keys (by :data:`FEW`) asks the filter first, and only keys that it cannot rule out
are compared with the key files; any other meets the keys themselves, in one aggregate.  Each run
appends its own filter; runs need not know each other.

The index is written after the rows.  A run that was lost in between, or a table that had no
index, shows as a day whose numbers of rows and keys differ, and that day is indexed anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import folders
from eventlake.session import cut_lineage

KEY = ["day", "ts", "key"]
NO_DAY = "none"                     # rows without a timestamp
WORD_KEYS = 6
BITS = 4
FEW = 8                             # stored keys for each delivered one from which the filter is asked first
MOST_DAYS_LISTED = 4096             # days named in a scan's filter; beyond, the join alone prunes


def key_columns(key: Column, timestamp: str = "Timestamp") -> list[Column]:
    """:data:`KEY` of a row: its UTC day, microseconds and text key, none of them NULL."""
    return [F.coalesce(F.date_format(F.to_date(timestamp), "yyyy-MM-dd"), F.lit(NO_DAY)).alias("day"),
            F.coalesce(F.unix_micros(timestamp), F.lit(-(2 ** 63))).alias("ts"), key.alias("key")]


def _placed(keys: DataFrame) -> DataFrame:
    """Keys (with ``words``) and the word and bits they set."""
    bits = " | ".join(f"shiftleft(1L, cast(shiftright(h, {6 * i}) & 63 AS int))" for i in range(BITS))
    return (keys.withColumn("h", F.xxhash64("key", "ts", F.lit(7)))
            .withColumn("word", F.pmod(F.xxhash64("ts", "key"), F.col("words")))
            .withColumn("bits", F.expr(bits)).drop("h"))


class KeyIndex:
    """The key index of one table, under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _days(self) -> set[str]:
        return {n.removeprefix("day=") for n in folders.children(self.spark, f"{self.root}/keys") if n.startswith("day=")}

    def _read(self, part: str, columns: str, days: list[str] | None) -> DataFrame:
        df = self.spark.read.schema(f"{columns}, day string, words bigint").parquet(f"{self.root}/{part}")
        return df if days is None else df.where(F.col("day").isin(days))

    def keys(self, days: list[str] | None = None) -> DataFrame:
        """The indexed keys (``KEY``, word, words), of ``days`` or all."""
        return self._read("keys", "ts bigint, key string, word bigint", days)

    def add(self, fresh: DataFrame) -> None:
        """Index ``fresh`` (``KEY``; keys that are not in the index yet)."""
        n = fresh.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
        words = F.expr(f"shiftleft(1L, cast(greatest(0D, ceil(log2(n / {WORD_KEYS}.0D))) AS int))")
        # one row a day; the planner, not knowing it, would shuffle all keys by their day
        placed = _placed(fresh.join(F.broadcast(n.select("day", words.alias("words"))), "day"))
        out = placed.hint("rebalance", F.col("day"), F.col("words"))
        (placed.groupBy("day", "words", "word").agg(F.bit_or("bits").alias("bits"))
         .hint("rebalance", F.col("day"), F.col("words")).sortWithinPartitions("day", "words", "word")
         .write.mode("append").partitionBy("day", "words").parquet(f"{self.root}/filter"))
        # the keys come last: a day's filter is never behind its keys
        (out.select("ts", "key", "word", "day", "words").sortWithinPartitions("day", "words", "word")
         .write.mode("append").partitionBy("day", "words").parquet(f"{self.root}/keys"))

    def maybe_known(self, keys: DataFrame, days: list[str] | None) -> DataFrame:
        """Keys that the filters of their days cannot rule out, placed in each run size's words."""
        bloom = self._read("filter", "word bigint, bits bigint", days)
        sizes = bloom.select("day", "words").distinct()             # a few powers of two a day
        probe = _placed(keys.select(*KEY).join(F.broadcast(sizes), "day")).withColumnRenamed("bits", "mask")
        same = [probe[c] == bloom[c] for c in ("day", "words", "word")]
        return probe.join(bloom, [*same, probe["mask"].bitwiseAND(bloom["bits"]) == probe["mask"]], "left_semi").drop("mask")

    def known(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` (``KEY``) that are indexed, exactly."""
        return self.marked(keys.select(*KEY, F.lit(1).cast("long").alias("n"))).where("known").select(*KEY).distinct()

    def marked(self, batch: DataFrame) -> DataFrame:
        """``batch`` (``KEY``, ``n`` long: how often it came; of a repeated key the sum may be returned) with
        ``known``: true for keys that are indexed, exactly, else NULL.  ``batch`` is read more than once."""
        stored = self._days()
        asked = [r["day"] for r in batch.select("day").distinct().limit(MOST_DAYS_LISTED + 1).collect()]
        days = sorted(stored.intersection(asked)) if len(asked) <= MOST_DAYS_LISTED else None
        none = F.lit(None).cast("boolean").alias("known")
        if not stored or days == []:
            return batch.select(*KEY, "n", none)
        held = self.keys(days)
        if batch.count() * FEW < held.count():
            maybe = cut_lineage(self.maybe_known(batch, days), "index-maybe")
            seen = held.join(maybe, [*KEY, "words", "word"], "left_semi").select(*KEY).distinct()
            return batch.select(*KEY, "n").join(seen.withColumn("known", F.lit(True)), KEY, "left")
        both = batch.select(*KEY, "n", none).unionByName(
            held.select(*KEY, F.lit(0).cast("long").alias("n"), F.lit(True).alias("known")))
        return both.groupBy(*KEY).agg(F.sum("n").alias("n"), F.bool_or("known").alias("known")).where("n > 0")

    def heal(self, rows: DataFrame, days: DataFrame) -> list[str]:
        """Index anew the days (column ``day``) whose ``rows`` (``KEY`` of the stored table) and indexed
        keys differ in number; returns them.  Counting reads partition folders and file footers.  A day that
        holds a key twice (appended without the check) differs each time, and is indexed each time."""
        touched = days.select("day").distinct()
        have = rows.join(touched, "day", "left_semi").groupBy("day").agg(F.count(F.lit(1)).alias("n"))
        if self._days():
            indexed = (self.keys().join(touched, "day", "left_semi").groupBy("day").agg(F.count(F.lit(1)).alias("m")))
            have = have.join(indexed, "day", "full")
        else:
            have = have.withColumn("m", F.lit(0).cast("long"))
        wrong = [r["day"] for r in have.where("coalesce(n, 0) <> coalesce(m, 0)").select("day").collect()]
        for day in wrong:
            for part in ("keys", "filter"):
                folders.remove(self.spark, f"{self.root}/{part}/day={day}")
        if wrong:
            self.add(cut_lineage(rows.where(F.col("day").isin(wrong)).select(*KEY).distinct(), "index-heal"))
        return sorted(wrong)
