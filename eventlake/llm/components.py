"""Connected components as joins: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import materialise


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (columns ``a``, ``b``, long);
    ``component`` is the smallest node reachable, the node itself included.

    Large-star links every larger neighbour of a node to its smallest neighbour, small-star
    does the same for the smaller ones; the rounds end when the edge list stays as it is
    (logarithmically many on the graphs met here).  Each round is written to the shared
    folder.  The minimum is a partial aggregate and is written before it is joined back, so
    that both sides of the join are plain exchanges and a hub's partition can be split.
    Self-loops, repeated edges and nulls are ignored; no edges give an empty result."""
    pairs = (edges.where("a is not null and b is not null and a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now = materialise(pairs, label)
    seen = _seal(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), label)
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = materialise(large, label)
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m")), label)
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        now = materialise(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                          .distinct(), label)
        was, seen = seen, _seal(now)
        if seen == was:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _seal(pairs: DataFrame) -> tuple:
    """Count and order-free fingerprint of an edge list (one row on the driver)."""
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
