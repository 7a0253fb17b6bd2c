"""Quality rules with thresholds that adapt to each language and source.

Each document's statistics are computed in its row; per language and source a mergeable
quantile sketch of each statistic is kept as counts of logarithmic buckets; fences made from
its quartiles, and from its tails where these coincide, are joined back and decide.  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import WORD_BREAK, apart, materialise

# Fixed values of the base rules.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

# The statistics that the sketches hold, as whole numbers, with the side(s) on which a value is
# bad and the spread that a fence assumes where the group, its language and the whole table have
# none (so that the first value that differs is not rejected).
FEATURES = {
    "symbols": ("high", 100),        # symbols per 1000 words
    "dup_lines": ("high", 20),       # repeated lines per 1000 words
    "repeated": ("high", 90),        # words in repeated windows per 1000 words
    "word_length": ("both", 60),     # hundredths of a character per word
}
REACH = 3.0            # fences lie this many spreads outside the quartiles,
TAIL_REACH = 1.0       # or this many tails outside the tail where the quartiles coincide
TAILS = (90, 95, 99)   # the percentiles that may be the tail's end, and 100 less these
LEAST_DOCS = 50        # smaller groups use their language's sketch, then everyone's
BUCKETS = 32           # buckets per power of two: quartiles are exact to about 3 percent


# --- statistics of a row -----------------------------------------------------------------------

def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__n_words``, ``__word_chars``, ``__n_symbols``, ``__n_dup_lines`` and
    ``__n_repeat_words`` (long) of each whole text; null text counts as having no words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.withColumn("__words", F.array_remove(F.split(text, WORD_BREAK), ""))
    df = df.withColumn("__n_words", F.size("__words").cast("long"))
    df = df.withColumn("__lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # a column that a lambda reads must be used twice or more: the optimizer then leaves it in a
    # projection of its own instead of working it out again for each element
    df = df.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    grams = F.transform(F.sequence(F.lit(1), F.size("__hashes") - (WINDOW - 1)),
                        lambda i: F.xxhash64(F.slice("__hashes", i, WINDOW)))
    df = df.withColumn("__grams", F.when(F.size("__hashes") > WINDOW, grams))
    ranked = F.sort_array(F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = df.withColumn("__ranked", F.when(F.size(F.array_distinct("__grams")) < F.size("__grams"), ranked))
    met = F.filter("__ranked", lambda x, k: (x["g"] == F.get("__ranked", k - 1)["g"])
                   | (x["g"] == F.get("__ranked", k + 1)["g"]))
    df = df.withColumn("__at", F.sort_array(F.transform(met, lambda x: x["i"])))
    step = F.zip_with("__at", F.slice("__at", 2, 2 ** 31 - 2),
                      lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))).cast("long"))
    repeated = F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)
    # one generated row: a filter on its columns is not pushed below and worked out again there
    return df.select(*docs.columns, F.inline(F.array(F.struct(
        F.col("__n_words"), F.length(F.array_join("__words", "")).cast("long").alias("__word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("__n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("__n_dup_lines"),
        F.coalesce(repeated, F.lit(0).cast("long")).alias("__n_repeat_words")))))


def _base_failed() -> Column:
    return ((F.col("__n_words") < LEAST_WORDS)
            | (100 * F.col("__n_repeat_words") > MOST_REPEATED_PERCENT * F.col("__n_words")))


def _features() -> dict[str, Column]:
    words = F.greatest(F.col("__n_words"), F.lit(1))
    return {name: F.floor(F.col(of) * times / words).cast("long") for name, of, times in (
        ("symbols", "__n_symbols", 1000), ("dup_lines", "__n_dup_lines", 1000),
        ("repeated", "__n_repeat_words", 1000), ("word_length", "__word_chars", 100))}


def _bucket(v: Column) -> Column:
    """Lower edge of the bucket of a whole number: itself below 2 * BUCKETS, then BUCKETS buckets
    for each power of two.  Whole numbers only, so every engine agrees on it."""
    shift = F.greatest(F.length(F.bin(v)) - (BUCKETS.bit_length()), F.lit(0))
    unit = F.expr("1L") * F.pow(F.lit(2), shift).cast("long")
    return F.when(v < 2 * BUCKETS, v).otherwise(F.floor(v / unit).cast("long") * unit)


def _last(bucket: Column) -> Column:
    """Last whole number of the bucket with this lower edge."""
    shift = F.greatest(F.length(F.bin(bucket)) - (BUCKETS.bit_length()), F.lit(0))
    return F.when(bucket < 2 * BUCKETS, bucket).otherwise(bucket + F.pow(F.lit(2), shift).cast("long") - 1)


# --- thresholds --------------------------------------------------------------------------------

def sketches(stats: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """``lang``, ``source``, ``feature``, ``bucket``, ``n``: the quantile sketches as counts.  They
    merge by addition, so partial sums form before the exchange however hot a source is."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), _bucket(v).alias("bucket"))
                               for k, v in _features().items()]))
    return (stats.where(~_base_failed())
            .select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), each.alias("f"))
            .groupBy("lang", "source", "f.feature", "f.bucket").agg(F.count(F.lit(1)).alias("n")))


def thresholds(sketch: DataFrame, reach: float = REACH, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang``, ``source`` and ``lo_<feature>``, ``hi_<feature>``: one row per group met.

    A fence lies ``reach`` quartile spreads outside the group's quartile.  Where the quartiles
    coincide (most documents have no symbols at all), the group's tail takes their place: the
    outermost of ``TAILS`` that is still within ``reach`` assumed spreads of the quartile (what
    lies further is another population, such as junk, and must not widen its own fence), and
    ``TAIL_REACH`` times its distance beyond.  A group without such a tail has its language's
    distance from quartile to fence, or the whole table's; the assumed spread of ``FEATURES``
    acts only where none of them has any spread.

    Groups with fewer than ``least_docs`` documents use the sketch merged over their language,
    and languages with fewer the one merged over everything."""
    groups = sketch.select("lang", "source").distinct()
    own = _reaches(sketch, ["lang", "source"], reach)
    lang = _reaches(sketch.groupBy("lang", "feature", "bucket").agg(F.sum("n").alias("n")), ["lang"], reach)
    every = _reaches(sketch.groupBy("feature", "bucket").agg(F.sum("n").alias("n")), [], reach)
    named = F.explode(F.array(*[F.lit(k) for k in FEATURES])).alias("feature")
    at = groups.select("lang", "source", named)
    at = _null_safe(at, own, ["lang", "source", "feature"], "o")
    at = _null_safe(at, lang, ["lang", "feature"], "l")
    at = _null_safe(at, every, ["feature"], "e")
    mine, theirs = F.col("o.docs") >= least_docs, F.col("l.docs") >= least_docs
    use = F.when(mine, F.col("o")).when(theirs, F.col("l")).otherwise(F.col("e"))
    far = {side: F.coalesce(F.when(mine, F.col(f"o.{side}")), F.when(theirs, F.col(f"l.{side}")), F.col(f"e.{side}"))
           for side in ("below", "above")}
    at = at.select("lang", "source", "feature", use.alias("q"), *[v.alias(k) for k, v in far.items()])
    out = []
    for name, (bad, least) in FEATURES.items():
        mine, none = F.col("feature") == name, F.lit(int(reach * least)).cast("long")
        hi = F.col("q.q75") + F.coalesce("above", none)
        lo = F.col("q.q25") - F.coalesce("below", none) if bad == "both" else F.lit(-1).cast("long")
        out += [F.max(F.when(mine, lo)).alias(f"lo_{name}"), F.max(F.when(mine, hi)).alias(f"hi_{name}")]
    return at.groupBy("lang", "source").agg(*out)


def _reaches(sketch: DataFrame, keys: list[str], reach: float) -> DataFrame:
    """``keys``, ``feature``, ``v`` (struct docs, q25, q75, below, above): the quartiles, and how far
    outside them the fences lie; null where neither quartiles nor tail show any spread.

    Quartiles and tails are those of the buckets that hold them: lower edges below, last whole
    numbers above.  A window sees the buckets of one sketch, a few hundred rows."""
    w = Window.partitionBy(*keys, "feature")
    run = (sketch.withColumn("docs", F.sum("n").over(w))
           .withColumn("upto", F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))))
    q = [F.min(F.when(F.col("upto") * 100 >= F.col("docs") * k, F.col("bucket"))).alias(f"p{k}")
         for k in (25, 75, *TAILS, *[100 - k for k in TAILS])]
    at = run.groupBy(*keys, "feature").agg(F.max("docs").alias("docs"), *q)
    at = at.withColumn("low", F.col("p25")).withColumn("high", _last(F.col("p75")))
    assumed = F.create_map(*[F.lit(x) for k, (_, least) in FEATURES.items() for x in (k, int(reach * least))])
    most = assumed[F.col("feature")]
    apart = F.col("p75") > F.col("p25")
    between = F.floor(F.lit(reach) * (F.col("high") - F.col("low"))).cast("long")
    above, below = F.lit(0).cast("long"), F.lit(0).cast("long")
    for k in TAILS:
        up, down = _last(F.col(f"p{k}")) - F.col("high"), F.col("low") - F.col(f"p{100 - k}")
        above = F.greatest(above, F.when(up <= most, up))
        below = F.greatest(below, F.when(down <= most, down))
    tail = lambda x: F.when(x > 0, x + F.floor(F.lit(TAIL_REACH) * x).cast("long"))
    return at.select(*keys, "feature", F.struct(
        "docs", F.col("low").alias("q25"), F.col("high").alias("q75"),
        F.when(apart, between).otherwise(tail(below)).alias("below"),
        F.when(apart, between).otherwise(tail(above)).alias("above")).alias("v"))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], name: str) -> DataFrame:
    other = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.col("v").alias(name))
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(other[f"__r_{k}"])
    return left.join(other, same, "left").drop(*[f"__r_{k}" for k in keys])


@apart
def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
           reach: float = REACH, least_docs: int = LEAST_DOCS, store: bool = False) -> DataFrame:
    """``docs`` with its statistics (see :func:`with_statistics`), ``__base_failed`` and ``__kept``.

    ``__kept`` is false where a base rule fails (fewer than 20 words, or over 30 percent of the
    words in repeated windows) and otherwise says that every statistic lies within the fences
    of the document's language and source.  Null languages and sources are groups like any
    other; null or empty text has no words and fails; repeated rows count each; extra columns
    pass through; an empty table stays empty.

    The fences are written to the shared folder first, so that the planner knows their size:
    it broadcasts them while they are small and joins by a split exchange beyond.  ``store``
    writes the statistics as well (for narrow inputs), else they are computed twice."""
    stats = with_statistics(docs, text_col)
    if store:
        stats = materialise(stats, "quality-statistics")
    narrow = stats if store else with_statistics(
        docs.select(F.col(text_col), F.col(lang_col), F.col(source_col)), text_col)
    sketch = materialise(sketches(narrow, lang_col, source_col), "quality-sketches")     # read several times
    fences = materialise(thresholds(sketch, reach, least_docs), "quality-fences")
    fences = fences.select(*[F.col(c).alias(f"__{c}") for c in fences.columns])
    inside = F.lit(True)
    for name, value in _features().items():
        inside = inside & value.between(F.col(f"__lo_{name}"), F.col(f"__hi_{name}"))
    same = stats[lang_col].eqNullSafe(fences["__lang"]) & stats[source_col].eqNullSafe(fences["__source"])
    out = (stats.join(fences, same, "left").withColumn("__base_failed", _base_failed())
           .withColumn("__kept", ~F.col("__base_failed") & F.coalesce(inside, F.lit(True))))
    return out.drop(*fences.columns)


@apart
def quality_filter(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that :func:`judged` keeps, columns as they were."""
    return judged(docs, **how).where("__kept").select(*docs.columns)
