"""Best-fit packing planned on the length histogram."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import apart, materialise
from eventlake.llm.tokens import CACHE_PIECES, LONG_PIECE, coder

TEXTS_AT_ONCE = 256


def cut_pieces(docs: DataFrame, path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
               text_col: str = "text", long_piece: int = LONG_PIECE, cache: int = CACHE_PIECES) -> DataFrame:
    """``id_col``, ``piece`` (int), ``start`` (long), ``length`` (long) and ``ids`` (binary,
    little-endian unsigned 32-bit) of every document's token ids with ``end_id`` appended.

    A document of at most ``size`` ids is one piece; of a longer one all pieces but the first
    have exactly ``size``.  No shuffle.  Null text is empty (its one piece is the end id);
    null ids and repeated rows stay; an empty table gives no pieces."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        own = coder(path, long_piece, cache)
        arrow = to_arrow_schema(schema)
        tail = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = [t or "" for t in texts.slice(a, TEXTS_AT_ONCE).to_pylist()]
                row, piece, start, length, ids = [], [], [], [], []
                for k, raw in enumerate(own.encode(part)):
                    whole = np.frombuffer(raw, own.dtype).astype("<u4").tobytes() + tail
                    n = len(whole) // 4
                    head = n % size or min(n, size)
                    cuts = [0, *range(head, n + 1, size)]
                    for p, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        row.append(a + k)
                        piece.append(p)
                        start.append(x)
                        length.append(y - x)
                        ids.append(whole[4 * x:4 * y])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(ids, pa.binary())], schema=arrow)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def plan_best_fit(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over counts: ``(length, rank from, rank to, sequence, offset)``
    rows that say where the pieces of a length with those ranks go (consecutive sequences,
    the same offset).

    Groups of equal sequences stand for their members: an item goes to the fullest sequence
    that still takes it, and a group of k sequences takes k items in one step; only the last
    group that a length needs is split.  So the plan has a few rows per length, whatever the
    number of documents."""
    room: dict[int, list[tuple[int, int]]] = {}     # free tokens -> groups (first sequence, count)
    plan, made = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            free = min((f for f in room if f >= length), default=None)
            if free is None:
                fill = size // length               # new sequences, filled with this length alone
                full, rest = divmod(left, fill)
                for seqs, each in ((full, fill), (1 if rest else 0, rest)):
                    if not seqs:
                        continue
                    for k in range(each):
                        plan.append((length, rank, rank + seqs, made, k * length))
                        rank += seqs
                    if size - each * length:
                        room.setdefault(size - each * length, []).append((made, seqs))
                    made += seqs
                break
            first, seqs = room[free].pop()
            take = min(seqs, left)
            if take < seqs:
                room[free].append((first + take, seqs - take))
            if not room[free]:
                del room[free]
            plan.append((length, rank, rank + take, first, size - free))
            if free - length:
                room.setdefault(free - length, []).append((first, take))
            left -= take
            rank += take
    return plan


@apart
def pack(pieces: DataFrame, size: int = 1024, length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` (long) and ``offset`` (long): as few sequences of at most
    ``size`` tokens as best fit gives, filled without gaps from 0.

    Only the histogram of lengths (at most ``size`` rows) reaches the driver; the plan made of
    it is a few rows per length.  A piece finds its slot by its rank among the pieces of its
    length: its place in its own input partition plus the counts of the partitions before
    (a window over counts), so one length may hold any share of all pieces.  Pieces are
    written once to the shared folder first, which fixes the partitions.  Pieces longer
    than ``size`` or without a length are refused; an empty table gives no rows; repeated
    rows get slots of their own.  ``sequence_id`` and ``offset`` of the input are replaced."""
    cols = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    kept = materialise(pieces.select(*cols, F.spark_partition_id().alias("__part")), "pieces")
    tally = materialise(kept.groupBy(F.col(length_col).cast("long").alias("__len"), "__part")
                        .agg(F.count(F.lit(1)).alias("__n")), "lengths")
    hist = {r["__len"]: r["n"] for r in tally.groupBy("__len").agg(F.sum("__n").alias("n"))
            .where(F.col("__len").isNull() | ~F.col("__len").between(1, size)).limit(1).collect()}
    if hist:
        raise ValueError(f"pieces must have a length from 1 to {size}; found {next(iter(hist))}")
    hist = {r["__len"]: r["n"] for r in tally.groupBy("__len").agg(F.sum("__n").alias("n")).collect()}
    plan = sorted(plan_best_fit(hist, size))
    before = F.sum("__n").over(Window.partitionBy("__len").orderBy("__part")
                               .rowsBetween(Window.unboundedPreceding, -1))
    bases = tally.withColumn("__base", F.coalesce(before, F.lit(0))).drop("__n")
    place = F.row_number().over(Window.partitionBy("__len", "__part").orderBy(F.xxhash64(*cols)))
    ranked = (kept.withColumn("__len", F.col(length_col).cast("long")).withColumn("__r", place)
              .join(bases, ["__len", "__part"])
              .withColumn("__rank", F.col("__base") + F.col("__r") - 1)
              .select(*cols, "__len", "__rank"))
    schema = T.StructType([*(ranked.schema[c] for c in cols), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    arr = np.array(plan or [(0, 0, 0, 0, 0)], dtype=np.int64)
    lens, froms, seqs, offs = arr[:, 0], arr[:, 1], arr[:, 3], arr[:, 4]
    firsts = np.searchsorted(lens, np.arange(size + 2))          # plan rows of each length

    def slots(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column(len(cols)).to_numpy(zero_copy_only=False)
            rank = batch.column(len(cols) + 1).to_numpy(zero_copy_only=False)
            at = np.zeros(len(n), dtype=np.int64)
            for length in np.unique(n):
                own = n == length
                a, b = firsts[length], firsts[length + 1]
                at[own] = a + np.searchsorted(froms[a:b], rank[own], side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(cols))),
                 pa.array(seqs[at] + rank - froms[at], pa.int64()), pa.array(offs[at], pa.int64())],
                schema=arrow)

    return ranked.mapInArrow(slots, schema)


def sequences(packed: DataFrame, ids_col: str = "ids") -> DataFrame:
    """``sequence_id``, ``ids`` (binary): the packed sequences themselves, from the output of
    :func:`pack` over pieces that still carry their ids.  A sequence is bounded by its size,
    so grouping by it is, too."""
    return (packed.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", F.hex(ids_col).alias("h")))).alias("p"))
            .select("sequence_id", F.unhex(F.array_join(F.transform("p", lambda x: x["h"]), "")).alias("ids")))
