"""Line deduplication by distinct-site spread.

How many sites a line stands on is estimated by HyperLogLog sketches per line hash, merged by
aggregation; lines near the threshold get exact distinct counts.  The threshold is what chance
explains for a line of these words: two sites for lines of many words, more for short ones.
Lines over it are cross-site boilerplate and are removed everywhere but in their first place.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import apart, materialise

LONG_WORDS = 10        # a line needs so many words over its sites together, and two sites
LIFT = 16              # a word may be so many times as frequent where a line is as it is overall
LG_K = 12              # sketch size: a standard error of 1.6 percent
BAND = 0.1             # estimates within 10 percent (and 1) of the threshold are counted exactly


def _key(line: Column) -> list[Column]:
    """128 bits of a trimmed line, as two hashes."""
    return [F.xxhash64(line), F.xxhash64(F.lit(7), line)]


def trimmed(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\x0b\x0c\r", "    "))


def line_rows(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``id``, ``doc`` (hash of the text), ``pos``, ``site``, ``h1``, ``h2``, ``n`` (words), ``words``
    (of lines of fewer than ``LONG_WORDS`` words, else null): a row per line that is not blank."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"),
                        F.xxhash64(text).alias("doc"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
            .withColumn("line", trimmed(F.col("line"))).where("line <> ''"))
    h1, h2 = _key(F.col("line"))
    # a line without letters and digits is one word
    found = F.array_remove(F.split(F.lower("line"), r"[^\p{L}\p{N}]+"), "")
    rows = rows.withColumn("found", F.when(F.size(found) > 0, found).otherwise(F.array("line")))
    n = F.size("found")
    return rows.select("id", "doc", "pos", "site", h1.alias("h1"), h2.alias("h2"), n.alias("n"),
                       F.when(n < LONG_WORDS, F.array_join("found", "\n")).alias("words"))


def _site() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("site")), F.lit("null"))


def by_chance(rows: DataFrame, some: DataFrame) -> DataFrame:
    """``h1``, ``h2``, ``chance``: on how many places each of the short lines in ``some`` would stand if
    lines of its length were put together from single words: the places of such lines times the
    shares of its words, each up to ``LIFT`` times its share overall (languages, line starts).

    Shares are counted over distinct short lines, so that boilerplate does not vouch for itself.
    They, and the chance as well, grow with the table as ordinary lines do."""
    short = rows.where("words is not null")
    distinct = materialise(short.select("h1", "h2", "n", "words").distinct(), "short-lines")
    total = distinct.agg(F.sum("n")).first()[0] or 1
    word = F.explode(F.split("words", "\n")).alias("word")
    share = distinct.select(word).groupBy("word").agg(F.count(F.lit(1)).alias("of"))
    places = short.groupBy("n").agg(F.count(F.lit(1)).alias("places"))
    # logarithms as whole numbers: their sum does not depend on the order
    log = F.least(F.lit(0), F.round(F.log2(F.col("of") * LIFT / F.lit(total)) * 1000)).cast("long")
    each = distinct.join(some, ["h1", "h2"], "left_semi").select("h1", "h2", "n", word)
    sums = each.join(share, "word").groupBy("h1", "h2", "n").agg(F.sum(log).alias("log"))
    return sums.join(F.broadcast(places), "n").select(
        "h1", "h2", (F.col("places") * F.pow(F.lit(2.0), F.col("log") / 1000)).alias("chance"))


def boilerplate(rows: DataFrame, most_sites: int | None = None) -> DataFrame:
    """``h1``, ``h2`` and the first place (``id``, ``doc``, ``pos``; nulls first) of every boilerplate
    line: one that stands on more than ``most_sites`` sites, or by default on more than chance
    explains.  A null site is a site of its own.

    By default a line of n words needs two sites and ``LONG_WORDS / n`` (all sites, if there are
    fewer), and one of fewer than ``LONG_WORDS`` words more documents than :func:`by_chance`
    expects.  Documents are counted by sketch."""
    site, doc = _site(), F.xxhash64("id", "doc")
    low, high = 2, int(LONG_WORDS * (1 + BAND)) + 2
    if most_sites is not None:
        low, high = int(most_sites * (1 - BAND)) - 1, int((most_sites + 1) * (1 + BAND)) + 2
    estimate = lambda c: F.hll_sketch_estimate(F.hll_sketch_agg(c, F.lit(LG_K)))
    more = [estimate(doc).alias("docs"), F.min("n").alias("n")] if most_sites is None else []
    spread = rows.groupBy("h1", "h2").agg(estimate(site).alias("sites"),
                                          F.min(F.struct("id", "doc", "pos")).alias("first"), *more)
    spread = materialise(spread.where(F.col("sites") >= low), "line-spread")
    near = spread.where(F.col("sites").between(low, high)).select("h1", "h2")
    exact = (rows.join(near, ["h1", "h2"], "left_semi").groupBy("h1", "h2")
             .agg(F.count_distinct(site).alias("exact")))
    spread = spread.join(exact, ["h1", "h2"], "left").withColumn("sites", F.coalesce("exact", "sites"))
    if most_sites is not None:
        bad = spread.where(F.col("sites") > most_sites)
    else:
        there = rows.agg(F.count_distinct(site)).first()[0]
        need = F.greatest(F.lit(2), F.least(F.lit(there), F.ceil(F.lit(LONG_WORDS) / F.col("n"))))
        spread = materialise(spread.where(F.col("sites") >= need), "line-suspects")
        chance = by_chance(rows, spread.where(F.col("n") < LONG_WORDS).select("h1", "h2"))
        bad = (spread.join(chance, ["h1", "h2"], "left")
               .where(F.col("docs") > F.coalesce("chance", F.lit(0.0)) + 1))
    return bad.select("h1", "h2", F.col("sites").cast("long").alias("sites"), "first")


@apart
def without_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        site_col: str = "source", most_sites: int | None = None) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text_col`` and ``__n_lines`` (lines that are
    not blank), ``__n_removed`` (long).

    A line (compared trimmed) is boilerplate if it stands on more distinct values of ``site_col``
    than :func:`boilerplate` says that chance explains, or on more than ``most_sites``.  Its first place (smallest id, then text hash, then position) is
    left alone, so no content is lost from the corpus; every other occurrence goes, in the same
    document as well.  The other lines stay as they are, and so does a document without any.

    Null text stays null and has no lines; null sites are one site; repeated rows (same id and
    text) are treated alike; blank lines are never boilerplate; an empty table stays empty; extra
    columns pass through.  A hot line or site is summed within each task before any exchange.
    The texts are exchanged once, by document."""
    rows = materialise(line_rows(docs, id_col, text_col, site_col), "lines")
    bad = materialise(boilerplate(rows, most_sites), "boilerplate")
    place = F.struct("id", "doc", "pos")
    gone = (rows.join(bad, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
            .groupBy(F.col("id").alias("__id"), F.col("doc").alias("__doc")).agg(F.collect_set("pos").alias("__gone")))
    text = F.col(text_col).cast("string")
    own = docs.withColumn("__key", F.xxhash64(F.coalesce(text, F.lit(""))))
    same = own[id_col].eqNullSafe(gone["__id"]) & (own["__key"] == gone["__doc"])
    lines = F.split(text, "\n")
    left = F.filter(lines, lambda x, k: ~F.array_contains("__gone", k))
    out = own.join(gone, same, "left")
    count = F.size(F.filter(lines, lambda x: trimmed(x) != ""))
    return (out.withColumn("__n_lines", F.coalesce(F.when(text.isNotNull(), count), F.lit(0)).cast("long"))
            .withColumn("__n_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
            .withColumn(text_col, F.when(F.col("__gone").isNull(), text).otherwise(F.array_join(left, "\n")))
            .drop("__id", "__doc", "__gone", "__key"))


@apart
def line_dedup(docs: DataFrame, text_col: str = "text", count_col: str = "n_chars", **how) -> DataFrame:
    """``docs`` without its boilerplate lines, columns as they were (``count_col``, if there, is the
    new text's length).  Documents that consisted of boilerplate alone are left out: all that
    they said stays at its first place."""
    out = without_boilerplate(docs, text_col=text_col, **how)
    out = out.where((F.col("__n_removed") == 0) | (F.col("__n_removed") < F.col("__n_lines")))
    if count_col in docs.columns:
        kind = docs.schema[count_col].dataType
        out = out.withColumn(count_col, F.when(F.col("__n_removed") > 0, F.length(text_col).cast(kind))
                             .otherwise(F.col(count_col)))
    return out.select(*docs.columns)
