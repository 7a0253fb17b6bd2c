"""Chat formatting with offset-aligned loss masks.

Turns are rendered with markers; control strings inside roles and texts are escaped
reversibly.  The rendered text is encoded once, with offsets; the sorted spans of the turns to
learn from are met with the token spans by binary search.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.tokens import coder

# The template.
OPEN, SAYS, DONE = "<|turn|>", "<|says|>", "<|done|>\n"
SEGMENT_CHARS = 1 << 18

# A backslash, and the first character of whatever could be taken for a control string: <|...,
# <s>, </s>, [INST], [/INST], <<SYS>>, <</SYS>>.
CONTROL = re.compile(r"\\|[<\[](?=\||/?s>|</?SYS>>|/?INST\])")
TURN = re.compile(r"<\|turn\|>(.*?)<\|says\|>(.*?)<\|done\|>\n", re.S)


def escape(text: str) -> str:
    """A backslash after each character that CONTROL finds, so no control string is left."""
    return CONTROL.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    """The text that :func:`escape` was given."""
    out, last = [], 0
    for m in re.finditer(r"(\\|[<\[])\\", text):
        if m.start() < last:
            continue
        out.append(text[last:m.start() + 1])
        last = m.end()
    return "".join(out) + text[last:]


def render(turns: list[tuple[str, str]], learn: tuple[str, ...]) -> tuple[str, list[tuple[int, int]]]:
    """The rendered text of ``turns`` (role, text) and the sorted spans of the texts to learn."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + SAYS, escape(text)
        if role in learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, DONE)
        at += len(head) + len(body) + len(DONE)
    return "".join(parts), spans


def mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """For each token (rows start, end, in order) the index of the span it meets, or -1: the
    tokens of a span are a range, and binary search finds its ends."""
    out = np.full(len(offsets), -1, np.int64)
    for k, (a, b) in enumerate(spans):
        if a < b:
            first = np.searchsorted(offsets[:, 1], a, side="right")
            last = np.searchsorted(offsets[:, 0], b, side="left")
            out[first:last] = k
    return out


def masked_texts(text: str, starts, ends, spans) -> list[str]:
    """The text under the mask, one string per span: the union of its tokens' offsets within the
    span (the bytes of one character are tokens with the same offsets)."""
    offsets = np.stack([starts, ends], 1) if len(starts) else np.zeros((0, 2), np.int64)
    met = mask(offsets, spans)
    out = []
    for k, (a, b) in enumerate(spans):
        own = offsets[met == k]
        pieces, at = [], a
        for s, e in own.tolist():
            s, e = max(s, at), min(e, b)
            if s < e:
                pieces.append(text[s:e])
                at = e
        out.append("".join(pieces))
    return out


SEGMENT = [("part", T.LongType()), ("segment", T.LongType()), ("n_turns", T.LongType()),
           ("formatted", T.StringType()), ("ids", T.BinaryType()), ("starts", T.BinaryType()),
           ("ends", T.BinaryType()), ("loss", T.BinaryType()), ("spans", T.BinaryType())]


def format_conversations(rows: DataFrame, path: str, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", learn: tuple[str, ...] = ("assistant",),
                         segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """The formatted conversations, as segments of whole turns: ``conv_col``, ``part`` and
    ``segment`` (their order within the conversation), ``n_turns``, ``formatted`` (text), and, as
    little-endian 32-bit numbers, the token ``ids``, their ``starts`` and ``ends`` in the text,
    the loss mask ``loss`` (one byte per token) and the learned ``spans`` (start, end).

    Segments end at turns, where the tokenizer cuts anyway (a line feed between markers), so
    their tokens joined are those of the whole conversation.  The rows are dealt out by
    range of conversation and turn: a conversation of any length is split over tasks, and a
    task holds one segment (at least a turn).

    Null text and null roles are empty; turns of the same number stand by hash of role and text,
    repeated rows all stay; null conversations are one conversation, null turns come first;
    other columns are not read; an empty table gives none."""
    kind = rows.schema[conv_col].dataType
    schema = T.StructType([T.StructField(conv_col, kind), *(T.StructField(*f) for f in SEGMENT)])

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from pyspark.sql.pandas.types import to_arrow_schema

        own, arrow, part = coder(path), to_arrow_schema(schema), TaskContext.get().partitionId()
        number, conv, turns, chars, any_yet = 0, None, [], 0, False

        def close():
            text, spans = render(turns, learn)
            (ids, offsets), = own.with_offsets([text])
            offsets = np.array(offsets, dtype="<i4").reshape(-1, 2)
            row = [[conv], [part], [number], [len(turns)], [text], [np.array(ids, "<u4").tobytes()],
                   [offsets[:, 0].tobytes()], [offsets[:, 1].tobytes()],
                   [(mask(offsets, spans) >= 0).astype(np.uint8).tobytes()], [np.array(spans, "<i4").tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for key, role, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if turns and (key != conv or chars >= segment_chars):
                    yield close()
                    number, turns, chars = number + 1, [], 0
                conv = key
                turns.append((role or "", text or ""))
                chars += len(turns[-1][1])
        if turns:
            yield close()

    tie = F.xxhash64(F.col(role_col), F.col(text_col))
    own = rows.select(F.col(conv_col), F.col(role_col).cast("string").alias("__role"),
                      F.col(text_col).cast("string").alias("__text"), F.col(turn_col).alias("__turn"), tie.alias("__tie"))
    order = [conv_col, "__turn", "__tie"]
    return (own.repartitionByRange(*order).sortWithinPartitions(*order).select(conv_col, "__role", "__text")
            .mapInArrow(run, schema))


def read_back(segments: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, from the formatted output alone: ``n_turns``, ``turns_sha256`` (of role,
    line feed, text, line feed per turn, unescaped), ``loss_chars`` and ``loss_sha256`` (of all
    text under the loss mask, unescaped), ``formatted_chars``.

    A digest needs its text in order, so a conversation's segments meet in one task; they are
    streamed through it, one batch at a time."""
    kind = segments.schema[conv_col].dataType
    schema = T.StructType([T.StructField(conv_col, kind), T.StructField("n_turns", T.LongType()),
                           T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                           T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def run(batches):
        import hashlib

        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        done: list[tuple] = []
        state = None

        def close():
            conv, n, turns, chars, loss, total = state
            done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)],
                                              schema=arrow)

        for batch in batches:
            for conv, text, starts, ends, loss, spans in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in TURN.findall(text):
                    state[1] += 1
                    state[2].update(f"{unescape(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
                on = np.frombuffer(loss, np.uint8).astype(bool)
                spans = np.frombuffer(spans, "<i4").reshape(-1, 2).tolist()
                for own in masked_texts(text, np.frombuffer(starts, "<i4")[on], np.frombuffer(ends, "<i4")[on], spans):
                    own = unescape(own)
                    state[3] += len(own)
                    state[4].update(own.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            if done:
                yield batch_of(done)
                done.clear()
        if state is not None:
            close()
        if done:
            yield batch_of(done)

    order = [conv_col, "part", "segment"]
    return (segments.repartition(F.col(conv_col)).sortWithinPartitions(*order)
            .select(conv_col, "formatted", "starts", "ends", "loss", "spans").mapInArrow(run, schema))
