"""Near duplicates of embeddings through an inverted multi-index.

Two codebooks, fitted independently on the halves of the unit vectors, form a product grid of
cells; every vector is posted in its cell.  A multi-sequence traversal visits the cells around
a vector by rising distance, as far as a slack that is calibrated for a target recall of links
at the threshold; the vectors met there are verified by cosine in double precision.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import block_pairs, by_group, materialise
from eventlake.llm.components import connected_components

SAMPLE = 8192
CODEWORDS = 64
PER_CODEWORD = 16
BLOCK = 1024
RECALL = 0.999
SEED = 20240229


# --- index -------------------------------------------------------------------------------------

def fit_codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means on one half of the sampled unit vectors, with ``PER_CODEWORD`` of them to a codeword
    on average at least: a book that repeats its sample would tell nothing of other vectors,
    and :func:`calibrate` would find them nearer than they are."""
    rng = np.random.default_rng(SEED)
    x = np.unique(x, axis=0)
    k = max(1, min(k, len(x) // PER_CODEWORD))
    centres = x[rng.choice(len(x), k, replace=False)] if len(x) else np.zeros((1, x.shape[1]))
    for _ in range(rounds):
        near = _squares(x, centres).argmin(1)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)
    return np.maximum(d, 0)


def multi_sequences(d1: np.ndarray, d2: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector (a row of the distances to both books) the cells (first codeword times the
    second book's size plus second codeword) by rising ``d1 + d2`` while that is at most ``most``:
    ``(row, cell)``, the nearest cell of every row first, then the second nearest, and so on.

    The two sorted lists of a vector are merged as one queue per first codeword; all vectors of
    the batch take a step at a time, each to the least head of its queues."""
    wide = d2.shape[1]
    o1, o2 = np.argsort(d1, axis=1, kind="stable"), np.argsort(d2, axis=1, kind="stable")
    s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
    s2 = np.hstack([s2, np.full((len(s2), 1), np.inf)])                # the end of each queue
    open_ = max(1, int((s1 + s2[:, :1] <= most[:, None]).sum(1).max(initial=0)))
    s1, o1 = s1[:, :open_], o1[:, :open_]
    heads, at = s1 + s2[:, :1], np.zeros(s1.shape, np.int64)
    live, rows, cells = np.arange(len(d1)), [], []
    while len(live):
        q = heads[live].argmin(1)
        near = heads[live, q] <= most[live]
        live, q = live[near], q[near]
        k = at[live, q]
        rows.append(live)
        cells.append(o1[live, q] * wide + o2[live, k])
        at[live, q] = k + 1
        heads[live, q] = s1[live, q] + s2[live, k + 1]
    return np.concatenate(rows or [live]), np.concatenate(cells or [live])


def multi_sequence(d1: np.ndarray, d2: np.ndarray, most: float) -> list[int]:
    """The traversal of :func:`multi_sequences` for one vector."""
    return multi_sequences(d1[None], d2[None], np.array([most]))[1].tolist()


def calibrate(sample: np.ndarray, books, cosine: float, recall: float) -> float:
    """The slack (how much farther than the nearest cell a visited cell may be) within which the
    cell of a neighbour at exactly the threshold lies with probability ``recall``.

    Each sampled vector gets a neighbour at the threshold angle in a random direction; links
    closer than the threshold need less slack, so the recall over real links is higher."""
    rng = np.random.default_rng(SEED + 1)
    step = rng.standard_normal(sample.shape)
    step -= (step * sample).sum(1, keepdims=True) * sample
    step /= np.maximum(np.linalg.norm(step, axis=1, keepdims=True), 1e-300)
    other = cosine * sample + np.sqrt(max(0.0, 1 - cosine ** 2)) * step
    slack = np.zeros(len(sample))
    half = books[0].shape[1]
    for book, part in ((books[0], slice(0, half)), (books[1], slice(half, None))):
        d = _squares(sample[:, part], book)
        home = _squares(other[:, part], book).argmin(1)
        slack += d[np.arange(len(d)), home] - d.min(1)
    # a link is found from either end, so the smaller of the two slacks counts
    back = np.zeros(len(sample))
    for book, part in ((books[0], slice(0, half)), (books[1], slice(half, None))):
        d = _squares(other[:, part], book)
        home = _squares(sample[:, part], book).argmin(1)
        back += d[np.arange(len(d)), home] - d.min(1)
    return float(np.quantile(np.minimum(slack, back), recall)) if len(sample) else 0.0


def _unit(vectors) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as double precision rows and the same scaled to length one (scaled by the
    largest component first, so that no square over- or underflows)."""
    x = np.array(vectors, dtype=np.float64)
    big = np.abs(x).max(1, keepdims=True)
    y = x / big
    return x, y / np.linalg.norm(y, axis=1, keepdims=True)


def _posted(books, slack: float):
    """mapInPandas: a row for each cell that a vector visits, its own cell first."""
    def run(batches):
        import pandas as pd

        half, wide = books[0].shape[1], len(books[1])
        for pdf in batches:
            for a in range(0, len(pdf), 1024):
                part = pdf.iloc[a:a + 1024]
                _, y = _unit(part["vec"].tolist())
                d1, d2 = _squares(y[:, :half], books[0]), _squares(y[:, half:], books[1])
                row, cell = multi_sequences(d1, d2, d1.min(1) + d2.min(1) + slack)
                home = cell[:len(part)]                                # the first step is the own cell
                by_row = np.lexsort((cell, row))
                visits = np.split(cell[by_row].astype("<i8"), np.cumsum(np.bincount(row))[:-1])
                told = np.full(len(row), None, object)                 # needed at home only
                told[:len(part)] = [v.tobytes() for v in visits]
                yield pd.DataFrame({"cell": cell, "resident": np.arange(len(row)) < len(part), "home": home[row],
                                    "node": part["node"].to_numpy()[row], "mult": part["mult"].to_numpy()[row],
                                    "visits": told})
    return run


POSTED = "cell long, resident boolean, home long, node long, mult long, visits binary"


def _raw(kind: str):
    """mapInPandas: the components of each vector as bytes, in the precision they came in."""
    def run(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"], "raw": [np.array(v, kind).tobytes() for v in pdf["vec"]]})
    return run


def _verify(cosine: float, kind: str):
    """Group function for one block pair of a cell: per vector the copies it is linked with here,
    and links that connect different vectors, as a forest.

    A pair is compared where one of the two is at home; a pair of vectors that visit each
    other's cells is left to the cell with the smaller number."""
    def run(pdf):
        import pandas as pd

        pdf = pdf.reset_index(drop=True)
        same = pdf["bi"].iat[0] == pdf["bj"].iat[0]
        _, x = _unit(np.frombuffer(b"".join(pdf["raw"]), kind).reshape(len(pdf), -1))
        side, res = pdf["side"].to_numpy(), pdf["resident"].to_numpy()
        cell, home = int(pdf["cell"].iat[0]), pdf["home"].to_numpy()
        node, mult = pdf["node"].to_numpy(), pdf["mult"].to_numpy()
        if same:
            left = right = np.arange(len(pdf))
        else:
            left, right = np.flatnonzero(side == pdf["bi"].iat[0]), np.flatnonzero(side == pdf["bj"].iat[0])
        if not len(left) or not len(right) or not res.any():
            return None
        links = np.zeros(len(pdf), np.int64)
        label, edges = np.arange(len(pdf)), []
        for a in range(0, len(left), 256):
            own = left[a:a + 256]
            hit = x[own] @ x[right].T >= cosine
            hit &= res[own][:, None] | res[right][None, :]
            if same:
                hit &= right[None, :] > own[:, None]
            i, j = np.nonzero(hit)
            i, j = own[i], right[j]
            # where both visit each other's cells, the resident is met in the smaller one as well
            at_home = home[i] == cell
            r, v = np.where(at_home, i, j), np.where(at_home, j, i)    # resident, visitor
            again, keep = np.flatnonzero(home[v] < cell), np.ones(len(i), bool)
            again = again[np.argsort(r[again], kind="stable")]
            cuts = np.flatnonzero(np.diff(r[again])) + 1
            for part in np.split(again, cuts) if len(again) else []:
                visits = np.frombuffer(pdf["visits"].iat[r[part[0]]], "<i8")
                keep[part] = ~np.isin(home[v[part]], visits)
            i, j = i[keep], j[keep]
            np.add.at(links, i, mult[j])
            np.add.at(links, j, mult[i])
            starts = np.flatnonzero(np.diff(i, prepend=-1))
            for p, q in zip(i[starts], np.split(j, starts[1:]), strict=True) if len(i) else []:
                trees, first = np.unique(label[q], return_index=True)
                new = trees != label[p]
                if new.any():
                    edges += [(node[p], node[k], 0) for k in q[first[new]]]
                    label[np.isin(label, trees[new])] = label[p]
        some = np.flatnonzero(links)
        counts = [(node[k], None, links[k]) for k in some]
        out = pd.DataFrame(counts + edges, columns=["a", "b", "n"])
        return out.astype({"b": "Int64"}) if len(out) else None
    return run


def _lengths(classes: DataFrame) -> list[int]:
    """All lengths of vectors met: each is indexed on its own."""
    return sorted(r["dim"] for r in classes.select("dim").distinct().collect())


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 cosine: float = 0.9, sample: int = SAMPLE, codewords: int = CODEWORDS,
                 recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """``id_col``, ``n_links`` (long), ``component_id`` (long), ``kept`` (boolean), one row per row
    of ``vectors``: how many other vectors have a cosine of at least ``cosine`` with it, the
    smallest id reachable by such links, and whether that is its own.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing (no links, own component, kept); so do rows with a null id (null component).
    Vectors of different lengths are compared only with their like.  Repeated rows are vectors
    of their own that link with each other; one id must not stand for different vectors.  Other
    columns are not read; an empty table gives
    an empty result.

    The codebooks are fitted on at most ``sample`` vectors (by hash of the vector); every vector
    is posted.  Equal vectors are one node with a multiplicity.  Cells are compared in block
    pairs of at most ``2 * block`` rows; counts and at most one edge per vector leave a block."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"))
    kind = "<f4" if vectors.schema[vector_col].dataType.elementType.simpleString() == "float" else "<f8"
    num = F.transform("vec", lambda v: v.cast("double"))
    good = (F.col("vec").isNotNull() & (F.size("vec") > 0)
            & F.forall(num, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
            & F.exists(num, lambda v: v != 0))
    rows = rows.withColumn("ok", F.coalesce(good, F.lit(False)) & F.col("id").isNotNull())
    rows = rows.withColumn("vec", F.when(F.col("ok"), num))
    classes = (rows.where("ok").groupBy("vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("mult"))
               .withColumn("dim", F.size("vec")))
    classes = materialise(classes, "vector-classes")
    found = []
    for dim in _lengths(classes):
        own = classes.where(F.col("dim") == dim)
        some = own.select("vec").orderBy(F.xxhash64("vec")).limit(sample).collect()
        _, unit = _unit([r["vec"] for r in some])
        half = max(1, dim // 2)
        if dim == 1:                                    # a second half of one zero
            unit = np.hstack([unit, np.zeros_like(unit)])
            own = own.withColumn("vec", F.concat("vec", F.array(F.lit(0.0))))
        books = (fit_codebook(unit[:, :half], codewords), fit_codebook(unit[:, half:], codewords))
        slack = calibrate(unit, books, cosine, recall)
        posted = materialise(own.select("node", "mult", "vec").mapInPandas(_posted(books, slack), POSTED), "cells")
        size = posted.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        # postings stay narrow until they are dealt out; the vectors join them just before
        cells = block_pairs(posted.join(materialise(size, "cell-sizes"), "cell"), ["cell"], "size", F.col("node"), block)
        raw = materialise(own.select("node", "vec").mapInPandas(_raw(kind), "node long, raw binary"), "raw-vectors")
        keys = ["cell", "bi", "bj"]
        cells = cells.join(raw, "node").select(*keys, "side", "resident", "home", "node", "mult", "raw", "visits")
        cells = cells.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, "node")
        found.append(materialise(cells.mapInPandas(by_group(keys, _verify(cosine, kind)), "a long, b long, n long"),
                                 "vector-links"))
    if not found:
        none = F.lit(None).cast("long")
        found = [rows.where("false").select(none.alias("a"), none.alias("b"), none.alias("n"))]
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.unionByName(more)
    counts = all_found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("far"))
    comps = connected_components(all_found.where("b is not null").select("a", "b"))
    known = (classes.select("vec", "node", "mult").join(counts, "node", "left")
             .join(comps.toDF("node", "comp"), "node", "left")
             .select("vec", (F.coalesce("far", F.lit(0)) + F.col("mult") - 1).alias("links"),
                     F.coalesce("comp", "node").alias("comp")))
    own = F.when(F.col("id").isNotNull(), F.coalesce("comp", "id"))
    return (rows.join(known, "vec", "left")
            .select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(True)).alias("kept")))
