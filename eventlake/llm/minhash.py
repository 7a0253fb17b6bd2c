"""Near duplicates of texts: MinHash signatures joined on their coordinates.

Documents with equal shingle sets are one class.  Each class is posted under the first
``PREFIX`` coordinates of its signature; two classes are compared only if they share a
posting, and in the first one that they share.  The comparison counts how many of all
coordinates agree, skipping pairs whose sizes rule a link out and pairs already connected;
pairs above the match threshold are confirmed on the full shingle sets.  A link is what the
full sets say; the signature can only miss one (see :func:`match_threshold`).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import block_pairs, bound_for_broadcast, by_group, materialise
from eventlake.llm.components import connected_components

COORDINATES = 128
PREFIX = 10
BLOCK = 1024
MOST_BROADCAST = 1_000_000
SEED = 20240229


def match_threshold(num: int, den: int, coordinates: int = COORDINATES, sigmas: float = 4.5) -> int:
    """Least number of agreeing coordinates of a pair worth confirming: 4.5 standard deviations
    below the mean of a pair whose similarity is just ``num / den`` (a miss in about 300,000
    such pairs).  With PREFIX coordinates posted, it shares none of them with probability
    (1 - num/den) ** PREFIX: 6e-9 at 0.85 and 1e-7 at 0.8."""
    p = num / den
    return max(1, math.floor(coordinates * p - sigmas * math.sqrt(coordinates * p * (1 - p))))


# --- shingles and signatures, inside tasks -----------------------------------------------------

def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``words`` words (A-Z lower-cased,
    split at blanks and ASCII controls from tab to carriage return).  With fewer words, the
    whole sequence is one shingle; without words there is none."""
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    k = min(words, len(own))
    n = len(own) - k + 1
    out = np.full(n, 0x9E3779B97F4A7C15 ^ k, np.uint64)
    for j in range(k):
        out ^= own[j:j + n]
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
        out ^= out >> np.uint64(29)
        out += np.uint64(0x165667B19E3779F9)
    return np.unique(out)


def _permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 2 ** 32, coordinates, np.uint32) | np.uint32(1),
            rng.integers(0, 2 ** 32, coordinates, np.uint32))


def signature(own: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """MinHash coordinates (32-bit) of a non-empty set, a slice at a time."""
    low = np.full(len(mul), 0xFFFFFFFF, np.uint32)
    x = (own ^ (own >> np.uint64(32))).astype(np.uint32)
    for a in range(0, len(x), 2048):
        part = x[a:a + 2048, None] * mul
        part += add
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(low, part.min(0), out=low)
    return low


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, coordinates: int,
               prefix: int) -> DataFrame:
    """``id``, ``mark`` (hash of the text), ``n`` (shingles), ``key`` (128-bit fingerprint of the set, null if empty), ``pre`` (the
    first ``prefix`` coordinates, 32 bits each) and ``sig`` (the low byte of every coordinate)."""
    def run(batches):
        import pyarrow as pa

        mul, add = _permutations(coordinates)
        for batch in batches:
            n, key, pre, sig = [], [], [], []
            for text in batch.column(1):
                own = shingles(text.as_py(), words)
                low = signature(own, mul, add) if len(own) else None
                n.append(len(own))
                key.append(fingerprint(own))
                pre.append(None if low is None else low[:prefix].tobytes())
                sig.append(None if low is None else low.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), *(pa.array(x, pa.binary()) for x in (key, pre, sig))],
                names=["id", "mark", "n", "key", "pre", "sig"])

    text = F.col(text_col).cast("string")
    return (docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), text_mark(text).alias("mark"))
            .mapInArrow(run, "id long, mark long, n long, key binary, pre binary, sig binary"))


def text_mark(text: Column) -> Column:
    """What tells the texts of one id apart."""
    return F.xxhash64(text)


def fingerprint(own: np.ndarray) -> bytes | None:
    import hashlib

    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """``key`` (the set's fingerprint), ``own`` (binary: the sorted shingle hashes) of ``text``."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            own = [shingles(t.as_py(), words) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([fingerprint(x) for x in own], pa.binary()),
                 pa.array([x.tobytes() for x in own], pa.binary())], names=["key", "own"])

    return texts.select("text").mapInArrow(run, "key binary, own binary")


# --- linking -----------------------------------------------------------------------------------

class Forest:
    """Union-find over a block's members, by component label."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while self.up.get(x, x) != x:
            self.up[x] = x = self.up.get(self.up[x], self.up[x])
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)


def similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return den * both >= num * (len(x) + len(y) - both)


def _candidates(pdf, num: int, den: int, least: int):
    """(agreeing coordinates, i, j) of the pairs of one block pair that are in different
    components, near enough in size and agree in enough coordinates."""
    m = len(pdf)
    comp, n, side = pdf["comp"].to_numpy(), pdf["n"].to_numpy(), pdf["side"].to_numpy()
    bi, bj = pdf["bi"].iat[0], pdf["bj"].iat[0]
    if m < 2 or (comp == comp[0]).all():
        return
    sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(m, -1)
    left = np.flatnonzero(side == bi)
    right = left if bi == bj else np.flatnonzero(side == bj)
    for i in left:
        other = right[right > i] if bi == bj else right
        low, high = np.minimum(n[i], n[other]), np.maximum(n[i], n[other])
        other = other[(comp[other] != comp[i]) & (den * low >= num * high)]
        hits = (sig[other] == sig[i]).sum(1)
        ok = hits >= least
        for h, j in zip(hits[ok].tolist(), other[ok].tolist(), strict=True):
            yield h, int(i), j


def suspects(num: int, den: int, least: int):
    """Group function: the members that have a candidate (at most one row for each)."""
    def run(pdf):
        met = {k for _, i, j in _candidates(pdf, num, den, least) for k in (i, j)}
        return pdf.iloc[sorted(met)][["rep", "key"]] if met else None
    return run


def linker(num: int, den: int, least: int, prefix: int):
    """Group function: confirmed links that connect different components, as a forest (at most
    one edge per member, however dense the block).

    Pairs are tried by falling number of agreeing coordinates, so copies attach to what they
    were copied from before they are compared with each other."""
    def run(pdf):
        import pandas as pd

        pdf = pdf.reset_index(drop=True)
        found = sorted(_candidates(pdf, num, den, least), key=lambda x: (-x[0], x[1], x[2]))
        coord, comp, ids = int(pdf["coord"].iat[0]), pdf["comp"].to_numpy(), pdf["rep"].to_numpy()
        pre = np.frombuffer(b"".join(pdf["pre"]), "<u4").reshape(len(pdf), -1)
        forest, edges, sets = Forest(), [], pdf["own"]
        for _, i, j in found:
            x, y = int(comp[i]), int(comp[j])
            if forest.root(x) == forest.root(y) or (pre[i, :coord] == pre[j, :coord]).any():
                continue                                     # connected, or met in an earlier posting
            if similar(np.frombuffer(sets.iat[i], np.uint64), np.frombuffer(sets.iat[j], np.uint64), num, den):
                forest.join(x, y)
                edges.append((ids[i], ids[j]))
        return pd.DataFrame(edges, columns=["a", "b"]) if edges else None
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    num: int = 80, den: int = 100, coordinates: int = COORDINATES, prefix: int = PREFIX,
                    block: int = BLOCK, marks: bool = False) -> DataFrame:
    """``id_col``, ``n_shingles`` (long), ``component_id`` (long), ``kept`` (boolean), one row per
    row of ``docs``; with ``marks`` also ``mark`` (:func:`text_mark` of the row's text).

    Two documents are linked if ``den * |A & B| >= num * |A | B|`` for their sets of distinct
    ``words``-word shingles; ``component_id`` is the smallest id reachable by links, itself
    included, and ``kept`` says that it is the document's own.

    Defined results: null or empty text and text without words has no shingle, links with
    nothing and is its own component; rows with a null id have a null component, kept, and
    link with nothing; repeated rows are copies of each other; equal ids with different texts
    are documents of their own (if they link with each other, one of them is kept).  Other columns are not read.  An empty table gives an empty result.

    At scale: copies are collapsed first (a partial aggregate on the set's fingerprint).  A first
    round compares the members of each posting with its best-connected member only, which is
    linear and joins the large groups.  The second compares what is still apart, in block
    pairs of at most ``2 * block`` rows, whatever the posting's size.  Only confirmed links
    that connect something leave a block.  Shingle sets are not stored: they are made again for
    the classes whose signatures ask for it."""
    least = match_threshold(num, den, coordinates)
    signed = materialise(signatures(docs, id_col, text_col, words, coordinates, prefix), "signatures")
    real = signed.where("key is not null and id is not null")
    # a class is a node by its fingerprint: one id may stand on several texts
    reps = real.groupBy("key").agg(*[F.min(c).alias("doc" if c == "id" else c) for c in ("id", "n", "pre", "sig")])
    reps = materialise(reps.withColumn("rep", F.shiftrightunsigned(F.xxhash64("key"), 1)), "classes")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    light = reps.select("key", "n", "sig")

    # postings: (coordinate, value) -> class
    value = [F.substring("pre", 4 * k + 1, 4) for k in range(prefix)]
    posts = reps.select("rep", "key", F.posexplode(F.array(*value)).alias("coord", "val"))
    shared = posts.groupBy("coord", "val").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    posts = materialise(posts.join(shared, ["coord", "val"]), "postings")

    # round 1: each member with the best-connected member of its posting
    weight = posts.groupBy("key").agg(F.sum("size").alias("w"))
    leads = (posts.join(weight, "key").groupBy("coord", "val")
             .agg(F.max(F.struct("w", F.negative("rep").alias("r"), F.col("key").alias("k"))).alias("m"))
             .select("coord", "val", F.negative("m.r").alias("b"), F.col("m.k").alias("kb")))
    stars = materialise(posts.join(leads, ["coord", "val"]).where("key <> kb")
                        .select(F.col("rep").alias("a"), F.col("key").alias("ka"), "b", "kb").distinct(), "stars")
    stars = (stars.join(light.toDF("ka", "na", "sa"), "ka").join(light.toDF("kb", "nb", "sb"), "kb")
             .where(F.lit(den) * F.least("na", "nb") >= F.lit(num) * F.greatest("na", "nb")))
    stars = materialise(stars.select("a", "ka", "b", "kb", "sa", "sb")
                        .mapInPandas(_above(least), "a long, ka binary, b long, kb binary"), "candidates")
    sets = _sets(texts, reps, stars.select(F.col("ka").alias("key"))
                 .unionByName(stars.select(F.col("kb").alias("key"))), words)
    linked = (stars.join(sets.toDF("ka", "xa"), "ka").join(sets.toDF("kb", "xb"), "kb")
              .mapInPandas(_confirm(num, den), "a long, b long"))
    links = materialise(linked, "links")
    comps = materialise(connected_components(links), "components")

    # round 2: what is still apart within a posting, in blocks; first by signatures alone, then
    # with the sets of the members that have a candidate
    label = posts.join(comps.toDF("rep", "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    label = materialise(label, "labelled")
    keys = ["coord", "val", "bi", "bj"]

    def blocks(rows: DataFrame, more: list[DataFrame], cols: list[str]) -> DataFrame:
        apart = (rows.groupBy("coord", "val").agg(F.min("comp").alias("x"), F.max("comp").alias("y"),
                                                  F.count(F.lit(1)).alias("members"))
                 .where("x < y").select("coord", "val", "members"))
        out = block_pairs(rows.join(apart, ["coord", "val"]), ["coord", "val"], "members", F.col("key"), block)
        for m in more:
            out = out.join(m, "key")
        return (out.select(*keys, "side", "rep", "key", "comp", *cols)
                .repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, "rep"))

    some = blocks(label, [light], ["n", "sig"])
    some = materialise(some.mapInPandas(by_group(keys, suspects(num, den, least)), "rep long, key binary")
                       .distinct(), "suspects")
    sets = _sets(texts, reps, some.select("key"), words)
    rows = label.join(some.select("key"), "key", "left_semi")
    rows = blocks(rows, [reps.select("key", "n", "pre", "sig"), sets], ["n", "pre", "sig", "own"])
    more = rows.mapInPandas(by_group(keys, linker(num, den, least, prefix)), "a long, b long")
    links = links.unionByName(materialise(more, "links"))
    comps = materialise(connected_components(links), "components")

    # back to the documents
    labelled = comps.toDF("rep", "comp").join(reps.select("rep", "doc"), "rep")
    least = labelled.groupBy("comp").agg(F.min(F.struct("doc", "rep")).alias("least"))
    known = (reps.select("key", "rep", "doc").join(labelled.select("rep", "comp").join(least, "comp"), "rep", "left")
             .select("key", F.coalesce("least.doc", "doc").alias("comp"),
                     F.coalesce(F.col("least.rep") == F.col("rep"), F.lit(True)).alias("leads")))
    own = F.when(F.col("id").isNotNull(), F.coalesce("comp", "id"))
    kept = F.coalesce((F.col("id") == own) & F.coalesce("leads", F.lit(True)), F.lit(True))
    return (signed.select("id", "mark", "n", "key").join(known, "key", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"),
                    kept.alias("kept"), *(["mark"] if marks else [])))


def _sets(texts: DataFrame, reps: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``key``, ``own``: the shingle sets of the classes in ``wanted`` (``key``), made from the texts
    of their first documents (``doc`` in ``reps``)."""
    wanted = materialise(reps.select("key", "doc").join(wanted.distinct(), "key"), "wanted")
    few = wanted.count()
    own = texts.join(bound_for_broadcast(wanted.select(F.col("doc").alias("id")).distinct(), few, MOST_BROADCAST),
                     "id", "left_semi")
    made = shingle_sets(own, words).where("key is not null")
    made = materialise(made.join(bound_for_broadcast(wanted.select("key"), few, MOST_BROADCAST), "key", "left_semi"), "sets")
    # only repeated rows give a set twice
    return made if made.count() == few else materialise(made.dropDuplicates(["key"]), "sets")


def _above(least: int):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                x = np.frombuffer(b"".join(pdf["sa"]), np.uint8).reshape(len(pdf), -1)
                y = np.frombuffer(b"".join(pdf["sb"]), np.uint8).reshape(len(pdf), -1)
                yield pdf.loc[(x == y).sum(1) >= least, ["a", "ka", "b", "kb"]]
    return run


def _confirm(num: int, den: int):
    def run(batches):
        for pdf in batches:
            ok = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den)
                  for x, y in zip(pdf["xa"], pdf["xb"], strict=True)]
            yield pdf.loc[np.array(ok, dtype=bool), ["a", "b"]]
    return run
