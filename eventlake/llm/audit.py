"""Filter interaction audit over failing-id relations.

Each filter leaves one table of the rows that fail it.  Left-anti joins of the corpus with those
tables give what every set of filters lets through; left-semi joins of a set's survivors with
the next filter's table give what that filter removes after the set.  An order of filters is
a chain of such sets, so every order's steps, their redundancy, the labels they lose and each
filter's share over all orders follow from the 2 ** n sets and n * 2 ** (n - 1) steps.

Rows are known by doc_id and a mark of the text, so that equal ids with different texts are rows
of their own; repeated rows are counted as often as they stand.  The relations are narrow
(ids, never texts); no join key is shared by many rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import WORD_BREAK, materialise
from eventlake.session import scratch_path

MOST_FILTERS = 6        # orders are listed: 720 of six filters


@dataclass
class Audit:
    """``survivors`` (label, part, prefix, n): rows that pass every filter of ``prefix``, a bit set;
    ``removals`` (label, part, prefix, filter, n): rows that pass ``prefix`` and fail ``filter``.
    ``label`` is '' for all rows, or the name of a label table.  Zero counts have no row.
    ``parts`` has every part.  ``failing`` (filter, doc_id, mark) are the id tables."""

    filters: Sequence[str]
    failing: DataFrame
    parts: DataFrame
    survivors: DataFrame
    removals: DataFrame


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["mark"] == b["mark"])


def _semi(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, _same_row(a, b), "left_semi")


def _anti(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, _same_row(a, b), "left_anti")


# --- the id tables -----------------------------------------------------------------------------

def store_failing(rows: DataFrame, failing: dict[str, DataFrame], label: str = "failing") -> DataFrame:
    """One stored id table per filter (a folder each), read back as (filter, doc_id, mark)."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    each = [df.select(F.lit(name).alias("filter"), "doc_id", "mark") for name, df in failing.items()]
    reduce(DataFrame.unionByName, each).write.partitionBy("filter").parquet(path)
    schema = rows.select("doc_id", "mark").schema
    return spark.read.schema(schema.add("filter", "string")).parquet(path)


def repeated_texts(rows: DataFrame) -> DataFrame:
    """Rows whose text some smaller doc_id has, too (rows without an id are neither).  The first
    id of each text is a partial aggregate, and the rest is an anti join on id and text: a text
    that a third of all rows share is no hot key."""
    named = rows.where("doc_id is not null")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    return named.join(first, ["digest", "doc_id"], "left_anti")


# --- the sets of filters -------------------------------------------------------------------------

def audit(rows: DataFrame, failing: dict[str, DataFrame], labels: dict[str, DataFrame]) -> Audit:
    """Survivors and removals of every set of the filters in ``failing`` (name -> failing rows,
    with doc_id and mark), by part, of all rows and of those in each label table (name -> doc_id).

    ``rows`` has doc_id, mark, part.  A label table's repeated and null ids count once and never."""
    names = list(failing)
    if not 1 <= len(names) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {len(names)}")
    stored = store_failing(rows, failing)
    tables = [stored.where(F.col("filter") == n).select("doc_id", "mark") for n in names]
    views = rows.select(F.lit("").alias("label"), "part", "doc_id", "mark")
    for name, ids in labels.items():
        views = views.unionByName(rows.join(ids.select("doc_id"), "doc_id", "left_semi")
                                  .select(F.lit(name).alias("label"), "part", "doc_id", "mark"))
    views = materialise(views, "audit-views")
    anywhere = stored.select("doc_id", "mark").distinct()
    # rows that fail nothing survive every set: they are counted once
    clean = _anti(views, anywhere).groupBy("label", "part").agg(F.count(F.lit(1)).alias("n"))
    state = _semi(views, anywhere).withColumn("prefix", F.lit(0))
    for i, table in enumerate(tables):
        state = materialise(state, f"audit-state-{i}")
        state = state.unionByName(_anti(state, table).withColumn("prefix", F.col("prefix") + (1 << i)))
    state = materialise(state, "audit-state")
    every = F.explode(F.sequence(F.lit(0), F.lit((1 << len(names)) - 1)))
    survivors = (state.groupBy("label", "part", "prefix").agg(F.count(F.lit(1)).alias("n"))
                 .unionByName(clean.select("label", "part", every.alias("prefix"), "n"))
                 .groupBy("label", "part", "prefix").agg(F.sum("n").alias("n")))
    removed = [_semi(state.where(F.col("prefix").bitwiseAND(F.lit(1 << i)) == 0), table)
               .groupBy("label", "part", "prefix").agg(F.count(F.lit(1)).alias("n"))
               .select("label", "part", "prefix", F.lit(name).alias("filter"), "n")
               for i, (name, table) in enumerate(zip(names, tables, strict=True))]
    return Audit(names, stored, views.select("part").distinct(),
                 materialise(survivors, "audit-survivors"),
                 materialise(reduce(DataFrame.unionByName, removed), "audit-removals"))


def order_steps(filters: Sequence[str]) -> list[dict]:
    """Each step of each order: its filter, the set before it and the set after it."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    out = []
    for order in permutations(filters):
        before = 0
        for k, f in enumerate(order):
            out.append({"filter_order": "".join(order), "step": k + 1, "filter": f, "before": before,
                        "after": before | bit[f], "rest": sum(bit.values()) - bit[f]})
            before |= bit[f]
    return out


def order_report(found: Audit, losses: dict[str, str]) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant (fails the step's filter but went
    before), unique_fails (fails that filter alone), each of ``losses`` (column -> label) removed
    here, and shapley (what the filter removes, summed over all orders)."""
    n = len(found.filters)
    weigh = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]),
                         F.bit_count("prefix") + 1)
    entry = [
        found.survivors.select("part", F.concat_ws(":", F.lit("kept"), "label", "prefix").alias("k"), "n"),
        found.removals.select("part", F.concat_ws(":", F.lit("gone"), "label", "filter", "prefix").alias("k"), "n"),
        found.removals.where("label = ''").groupBy("part", "filter").agg(F.sum(F.col("n") * weigh).alias("n"))
        .select("part", F.concat(F.lit("all:"), "filter").alias("k"), "n"),
    ]
    # at most (labels + 1) * (n + 2) * 2 ** n counts a part
    counts = (reduce(DataFrame.unionByName, entry).groupBy("part")
              .agg(F.map_from_entries(F.collect_list(F.struct("k", F.col("n").cast("long")))).alias("counts")))
    kind = "array<struct<filter_order:string,step:int,filter:string,before:int,after:int,rest:int>>"
    steps = F.from_json(F.lit(json.dumps(order_steps(found.filters))), kind)
    rows = counts.select("part", "counts", F.inline(steps))

    def count(*key) -> Column:
        return F.coalesce(F.try_element_at("counts", F.concat_ws(":", *key)), F.lit(0).cast("long"))

    gone, everyone = F.lit("gone"), F.lit("")
    removed = count(gone, everyone, "filter", "before")
    return rows.select("part", "filter_order", "step", count(F.lit("kept"), everyone, "after").alias("kept"),
                       removed.alias("removed"),
                       (count(gone, everyone, "filter", F.lit("0")) - removed).alias("redundant"),
                       count(gone, everyone, "filter", "rest").alias("unique_fails"),
                       *[count(gone, F.lit(label), "filter", "before").alias(c) for c, label in losses.items()],
                       count(F.lit("all"), "filter").alias("shapley"))


# --- the filters of the registered query ----------------------------------------------------------

def text_facts(docs: DataFrame) -> DataFrame:
    """One pass over whole texts (null: empty): the row's key, part, a digest of the text and
    whether it fails each rule on words, capitals and symbols."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"),
                      F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    # blanks at the ends would make empty words
    words = F.filter(F.split("t", WORD_BREAK), lambda w: w != "")
    seen = own.select("doc_id", "part", "t", words.alias("w"))
    capitals = F.length("t") - F.length(F.regexp_replace("t", "[A-Z]+", ""))
    return seen.select(
        "doc_id", "part", F.xxhash64("t").alias("mark"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"),
        (F.size("w") < 100).alias("short"),
        (F.size(F.array_distinct("w")).cast("long") * 100 < F.size("w").cast("long") * 80).alias("poor"),
        (capitals.cast("long") * 100 > F.length("t").cast("long") * 10).alias("loud"),
        F.col("t").rlike("[#$%&*|]").alias("symbols"))


def audit_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Audit:
    """The audit of five rules: A few words, B few different words, C capitals, D symbols, E a text
    that a smaller doc_id has.  Null text is empty, null lang the part ''; no documents, no rows.
    Other columns, whatever their names, are not read."""
    rows = materialise(text_facts(docs), "audit-facts")
    failing = {k: rows.where(c) for k, c in (("A", "short"), ("B", "poor"), ("C", "loud"), ("D", "symbols"))}
    failing["E"] = repeated_texts(rows)
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
    return audit(rows, failing, {"good": ids.where("quality = 1"), "toxic": ids.where("toxic = 1")})
