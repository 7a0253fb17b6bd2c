"""Token-id files: frequency-ranked ids, one to four bytes each, control bytes apart.

File format (one block of whole documents per file, integers little-endian):
``EVTOK1\\n``; seven 64-bit numbers (partition, block, documents, tokens, control bytes, data
bytes, 0); document ids (64-bit), their null flags (1 byte each), token counts (32-bit);
control bytes (two bits per token, lowest first: its byte count less one); data bytes (the
token's frequency rank, lowest byte first); a closing ``\\n`` that Spark's text writer adds.
They stand in the folder ``tokens``; beside it, ``ranks`` holds the ids by rank as Parquet, so
that a folder can be read with nothing else.  Files are written and read by Spark's own sources,
so their commits survive lost executors and any file system that Spark reads will do.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import materialise
from eventlake.llm.tokens import CACHE_PIECES, LONG_PIECE, coder

MAGIC = b"EVTOK1\n"
HEAD = 7
TEXTS_AT_ONCE = 256
BLOCK_TOKENS = 1 << 22


# --- the byte code -------------------------------------------------------------------------------

def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of ``ranks`` (unsigned 32-bit)."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    code = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    code[:len(ranks)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) < size[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


# For each control byte: the byte counts of its four tokens.
SIZES = np.array([[1 + (c >> s & 3) for s in (0, 2, 4, 6)] for c in range(256)], dtype=np.uint8)


def unpack_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ranks of :func:`pack_ranks`, by table lookup: no step per token in Python."""
    size = SIZES[control].reshape(-1)[:n]
    end = np.cumsum(size, dtype=np.int64)
    start = end - size
    data = np.concatenate([data, np.zeros(3, np.uint8)])
    out = data[start].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        out[more] |= data[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# --- tokens in document order ----------------------------------------------------------------------

BLOCK = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("block", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("ids", T.BinaryType())])


def token_blocks(docs: DataFrame, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
                 block_tokens: int = BLOCK_TOKENS, long_piece: int = LONG_PIECE,
                 cache: int = CACHE_PIECES) -> DataFrame:
    """Blocks of whole documents in ascending order of ``id_col`` (nulls first, equal ids by
    text): partitions are ranges of ids, blocks are numbered within them and closed at
    ``block_tokens`` ids, each document's with ``end_id`` appended.  The order is one range
    exchange of the texts; sorting spills, a task holds one block."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from pyspark.sql.pandas.types import to_arrow_schema

        own = coder(path, long_piece, cache)
        arrow = to_arrow_schema(BLOCK)
        part = TaskContext.get().partitionId()
        tail = np.array([end_id], dtype=own.dtype).tobytes()
        wide = own.dtype.itemsize
        block, keys, lengths, held = 0, [], [], []

        def close():
            # ids travel as 32-bit numbers only where the vocabulary needs them
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([block], pa.int64()),
                 pa.array([keys], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([b"".join(held)], pa.binary())], schema=arrow)

        tokens = 0
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS_AT_ONCE):
                texts = [t or "" for t in batch.column(1).slice(a, TEXTS_AT_ONCE).to_pylist()]
                ids = batch.column(0).slice(a, TEXTS_AT_ONCE).to_pylist()
                for key, raw in zip(ids, own.encode(texts), strict=True):
                    keys.append(key)
                    lengths.append(len(raw) // wide + 1)
                    held += (raw, tail)
                    tokens += lengths[-1]
                    if tokens >= block_tokens:
                        yield close()
                        block, tokens, keys, lengths, held = block + 1, 0, [], [], []
        if keys:
            yield close()

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("id", "tie").sortWithinPartitions("id", "tie"))
    return ordered.select("id", "text").mapInArrow(run, BLOCK)


def token_counts(blocks: DataFrame, width: int) -> DataFrame:
    """``token`` (long), ``n`` (long): how often each id stands in ``blocks``; summed within
    each task before the exchange.  ``width``: bytes of an id in the blocks."""
    def run(batches):
        import pyarrow as pa

        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0):
                n = np.bincount(np.frombuffer(raw.as_buffer(), f"<u{width}"))
                if len(n) > len(total):
                    total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
                total[:len(n)] += n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())],
                                         names=["token", "n"])

    per_task = blocks.select("ids").mapInArrow(run, "token long, n long")
    return per_task.groupBy("token").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, out: str, end_id: int = 1, id_col: str = "doc_id",
                      text_col: str = "text", block_tokens: int = BLOCK_TOKENS,
                      long_piece: int = LONG_PIECE, cache: int = CACHE_PIECES) -> None:
    """Write the token files of ``docs`` under the folder ``out`` and, beside them, the ids by
    descending frequency (ties: smaller id first).

    Frequencies are counted over all tokens.  The ranking has at most one entry per
    vocabulary entry, and that is all the driver sees.  Null text is empty (only the end
    id); null and repeated ids are kept; an empty table writes no block."""
    own = coder(path, long_piece, cache)
    width = own.dtype.itemsize
    blocks = materialise(token_blocks(docs, path, end_id, id_col, text_col, block_tokens, long_piece, cache),
                         "token-blocks")
    order = [r["token"] for r in token_counts(blocks, width).orderBy(F.desc("n"), "token").collect()]
    rank = np.zeros(max(order, default=0) + 1, dtype="<u4")
    rank[order] = np.arange(len(order))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{width}")
                control, data = pack_ranks(rank[ids])
                keys = row["doc_ids"]
                head = np.array([row["part"], row["block"], len(keys), len(ids), len(control), len(data), 0], "<i8")
                blob = b"".join([MAGIC, head.tobytes(), np.array([k or 0 for k in keys], "<i8").tobytes(),
                                 np.array([k is None for k in keys], np.uint8).tobytes(),
                                 np.array(row["lengths"], "<u4").tobytes(), control, data])
                yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["value"])

    (blocks.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("compression", "none").text(f"{out}/tokens"))
    (docs.sparkSession.createDataFrame(list(enumerate(order)), "rank long, token long").coalesce(1)
     .write.parquet(f"{out}/ranks"))


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (binary,
    little-endian unsigned 32-bit) of every document in the files under ``out``.

    ``start`` is the document's place in its block plus the token totals of the blocks before
    it in its partition and of the partitions before that; the totals are windows over one
    row per block and per partition."""
    ranks = spark.read.schema("rank long, token long").parquet(f"{out}/ranks").orderBy("rank").collect()
    table = np.array([r["token"] for r in ranks] or [0], dtype="<u4")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for raw in batch.column(0):
                blob = np.frombuffer(raw.as_buffer(), np.uint8)
                if blob[:len(MAGIC)].tobytes() != MAGIC:
                    raise ValueError("not a token file")
                at = len(MAGIC)
                part, block, docs, n, n_control, n_data, _ = blob[at:at + 8 * HEAD].view("<i8").tolist()
                at += 8 * HEAD
                keys = blob[at:at + 8 * docs].view("<i8")
                at += 8 * docs
                null = blob[at:at + docs].astype(bool)
                at += docs
                lengths = blob[at:at + 4 * docs].view("<u4").astype(np.int64)
                at += 4 * docs
                ids = table[unpack_ranks(blob[at:at + n_control],
                                         blob[at + n_control:at + n_control + n_data], n)]
                ends = np.cumsum(lengths)
                raw_ids = ids.tobytes()
                pieces = [raw_ids[4 * (e - k):4 * e] for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * docs, pa.int64()), pa.array([block] * docs, pa.int64()),
                     pa.array(keys, pa.int64(), mask=null), pa.array(ends - lengths, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(pieces, pa.binary())],
                    names=["part", "block", "doc_id", "local", "n_tokens", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{out}/tokens").select("content")
    return files.mapInArrow(run, "part long, block long, doc_id long, local long, n_tokens long, ids binary")


def with_starts(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`read_token_files` with ``start`` in place of ``part``, ``block`` and
    ``local``; the rows are read twice, so materialise them first."""
    own = rows.groupBy("part", "block").agg(F.sum("n_tokens").alias("n"))
    parts = own.groupBy("part").agg(F.sum("n").alias("n"))
    first = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("block")
                                       .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = (own.withColumn("inner", inner).drop("n")
            .join(parts.select("part", first.alias("first")), "part")
            .select("part", "block", (F.col("first") + F.col("inner")).alias("base")))
    return (rows.join(base, ["part", "block"])
            .withColumn("start", (F.col("base") + F.col("local")).cast("long"))
            .drop("part", "block", "local", "base"))
