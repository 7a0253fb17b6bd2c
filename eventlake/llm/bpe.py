"""BPE encoding and decoding of whole texts by tree concatenation (see ``tokens.py``)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.tokens import CACHE_PIECES, LONG_PIECE, coder

TEXTS_AT_ONCE = 256


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 decode: bool = True, long_piece: int = LONG_PIECE, cache: int = CACHE_PIECES) -> DataFrame:
    """``id_col``, ``n_tokens`` (long), ``ids`` (binary, little-endian unsigned 32-bit) and, with
    ``decode``, ``decoded`` (string) of every text, as the tokenizers library encodes (without
    special tokens added) and decodes (special tokens kept) with the file at ``path``.

    One pass without a shuffle; a task holds one Arrow batch and a bounded memory of pieces.
    Null text is the empty text (no ids, empty decoded text); null ids and repeated rows are
    kept as they are; other columns of ``docs`` are not read; an empty table gives none."""
    kind = docs.schema[id_col].dataType
    fields = [T.StructField(id_col, kind), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids", T.BinaryType())]
    schema = T.StructType(fields + ([T.StructField("decoded", T.StringType())] if decode else []))

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        own = coder(path, long_piece, cache)
        arrow = to_arrow_schema(schema)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = [t or "" for t in texts.slice(a, TEXTS_AT_ONCE).to_pylist()]
                ids = [np.frombuffer(x, own.dtype) for x in own.encode(part)]
                cols = [keys.slice(a, TEXTS_AT_ONCE), pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
                if decode:
                    cols.append(pa.array([own.decode(x.tolist()) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)
