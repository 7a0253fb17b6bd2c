"""Spelling variants: words one inserted, deleted or replaced letter apart, by bit-sliced positions.

A cell of the vocabulary keeps, for each position and letter, the set of its words that have
that letter there, as a row of bits.  A query word walks its letters once and moves four sets
along, 64 words to a machine word: the words equal so far, and those that are equal but for one
replaced letter, one letter more (positions shifted up) or one letter less (shifted down).

Words meet by halves: of two words one error apart, the first or the last ``(shorter - 1) // 2``
letters agree.  A word therefore stands under four keys (its own length and the one below, by
its beginning and, reversed, by its end).  Small groups share a cell; a group of any size is
dealt out in pairs of blocks, so a task holds two blocks.  Pairs never leave a cell: a word's
count of near words and its best one do.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import block_pairs, bound_for_broadcast, materialise

# The letters of a run after A-Z are lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LETTERS = 7
CELL = 2048             # words of small groups that share a cell
BLOCK = 16_384          # words of a block of a large group, of up to 64 letters
HELD = 400_000          # different words that a task counts before it hands them on
AT_ONCE = 1 << 18       # machine words of a set of bits for the queries walked together
HALF_SIZED = 64


# --- the vocabulary ------------------------------------------------------------------------------

def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least: int = LEAST_LETTERS, drop_every: int | None = None) -> DataFrame:
    """(word, n): runs of letters of whole texts (null: none), A-Z lower-cased, of ``least`` letters
    or more, with their occurrences.  ``drop_every``: where that number divides the crc32 h of
    ``<id>:<run>``, the run loses its letter h modulo its length (a null id is written as '')."""
    def run(batches):
        import pyarrow as pa

        held: Counter = Counter()

        def out():
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                               pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                # bytes know the letters A-Z alone
                low = text.as_buffer().to_pybytes().lower().decode()
                own = Counter(w for w in RUN.findall(low) if len(w) >= least)
                if drop_every:
                    before = zlib.crc32(f"{i.as_py() if i.is_valid else ''}:".encode())
                    for w, n in own.items():
                        h = zlib.crc32(w.encode(), before)
                        if h % drop_every == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                            if len(w) < least:
                                continue
                        held[w] += n
                else:
                    held.update(own)
                if len(held) > HELD:
                    yield out()
        if held:
            yield out()

    texts = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- one cell ------------------------------------------------------------------------------------

def letters_of(words: list[str]) -> np.ndarray:
    """Code points, a row per word, 0 after its end."""
    wide = np.array(words, dtype=str)
    return wide.view(np.uint32).reshape(len(words), -1) if wide.dtype.itemsize else np.zeros((len(words), 1), np.uint32)


class PositionIndex:
    """Bit sets of a cell's words by (position, letter)."""

    def __init__(self, letters: np.ndarray):
        self.width = -(-len(letters) // 64)
        at = np.arange(len(letters))
        word, bit = at // 64, np.uint64(1) << (at % 64).astype(np.uint64)
        self.sets, self.known = [], []
        for p in range(letters.shape[1]):
            known, which = np.unique(letters[:, p], return_inverse=True)
            rows = np.zeros((len(known) + 1, self.width), np.uint64)       # the last row: no word
            np.bitwise_or.at(rows, (which, word), bit)
            if known[0] == 0:
                rows[0] = 0                                                 # a word's end is no letter
            self.sets.append(rows)
            self.known.append(known)

    def having(self, p: int, letters: np.ndarray) -> np.ndarray:
        """For each of ``letters``, the words with it at position ``p``."""
        if not 0 <= p < len(self.sets):
            return np.zeros((len(letters), self.width), np.uint64)
        known = self.known[p]
        at = np.minimum(np.searchsorted(known, letters), len(known) - 1)
        return self.sets[p][np.where(known[at] == letters, at, len(known))]

    def only(self, chosen: np.ndarray) -> np.ndarray:
        """The set of the words where ``chosen``."""
        bits = np.zeros(self.width * 64, bool)
        bits[:len(chosen)] = chosen
        return np.packbits(bits, bitorder="little").view(np.uint64)


def one_error(index: PositionIndex, lengths: np.ndarray, letters: np.ndarray, n: int, longer: bool) -> np.ndarray:
    """The sets of indexed words one error from each query (rows of ``letters``, ``n`` letters each):
    with ``longer``, words of ``n`` letters with one replaced and of ``n + 1`` with one more;
    otherwise words of ``n - 1`` letters, with one less."""
    shape = (len(letters), index.width)
    equal = np.broadcast_to(index.only(np.ones(len(lengths), bool)), shape)
    replaced = more = less = np.zeros(shape, np.uint64)
    for p in range(n):
        q = letters[:, p]
        here = index.having(p, q)
        if longer:
            replaced = (replaced & here) | (equal & ~here)
            more = (more | equal) & index.having(p + 1, q)
        else:
            less = (less & index.having(p - 1, q)) | equal
        equal = equal & here
    if longer:
        return (replaced & index.only(lengths == n)) | ((more | equal) & index.only(lengths == n + 1))
    return less & index.only(lengths == n - 1)


def hits(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and members of rows of bit sets."""
    row, word = np.nonzero(sets)
    bits = np.unpackbits(sets[row, word][:, None].view(np.uint8), axis=1, bitorder="little")
    k, bit = np.nonzero(bits)
    return row[k], word[k] * 64 + bit


def near_in_cell(words: list[str], n: np.ndarray, shorter: int, reverse: bool, block: np.ndarray,
                 crossing: bool):
    """Each word's near words in its cell: (row, near words, best one's row), for rows that have any.

    ``shorter``: the cell holds words of this many letters and of one more.  ``block`` is each
    row's block; with ``crossing``, only words of different blocks are compared.  A pair that
    meets by its beginning, too, is left to the cells that go by beginnings."""
    half = (shorter - 1) // 2
    ends = np.unique([w[len(w) - half:] for w in words], return_inverse=True)[1]
    starts = np.unique([w[:half] for w in words], return_inverse=True)[1]
    letters = letters_of([w[::-1] for w in words] if reverse else words)
    lengths = np.array([len(w) for w in words])
    index = PositionIndex(letters)
    order = np.lexsort((np.array(words, dtype=object), -n))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    count = np.zeros(len(words), np.int64)
    best = np.full(len(words), len(words), np.int64)
    step = max(1, AT_ONCE // index.width)
    for size in (shorter, shorter + 1):
        rows = np.flatnonzero(lengths == size)
        for a in range(0, len(rows), step):
            own = rows[a:a + step]
            q, w = hits(one_error(index, lengths, letters[own], size, size == shorter))
            q = own[q]
            good = (ends[q] == ends[w]) & (starts[q] != starts[w]) if reverse else starts[q] == starts[w]
            if crossing:
                good &= block[q] != block[w]
            q, w = q[good], w[good]
            count += np.bincount(q, minlength=len(words))
            np.minimum.at(best, q, rank[w])
    rows = np.flatnonzero(count)
    return rows, count[rows], order[best[rows]]


# --- the vocabulary's pairs ------------------------------------------------------------------------

FOUND = "word string, n_near long, best string, best_n long"
KEYS = ["shorter", "back", "half"]


def _cells(batches):
    """Rows sorted by :data:`KEYS`, bi and bj -> each cell's finds.  Small groups of words of like
    length share a cell of about :data:`CELL` words; a block pair is a cell of its own."""
    import pandas as pd

    held: list[pd.DataFrame] = []

    def close():
        pdf = pd.concat(held) if len(held) > 1 else held[0]
        held.clear()
        if len(pdf) < 2:
            return None
        words = pdf["word"].tolist()
        rows, count, best = near_in_cell(
            words, pdf["n"].to_numpy(), int(pdf["shorter"].iloc[0]), bool(pdf["back"].iloc[0]),
            pdf["side"].to_numpy(), bool(pdf["bi"].iloc[0] != pdf["bj"].iloc[0]))
        if not len(rows):
            return None
        return pd.DataFrame({"word": [words[r] for r in rows], "n_near": count,
                             "best": [words[b] for b in best], "best_n": pdf["n"].to_numpy()[best]})

    size, last = 0, None
    for pdf in batches:
        if not len(pdf):
            continue
        cols = [pdf[k].to_numpy() for k in (*KEYS, "bi", "bj", "blocks")]
        new = np.ones(len(pdf), bool)
        new[1:] = False
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = [*np.flatnonzero(new).tolist(), len(pdf)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in cols)
            room = CELL if key[0] <= HALF_SIZED else 1
            # a group goes on in the next batch; a new one joins the cell only if both are small
            if held and key != last and (key[:2] != last[:2] or key[5] > 1 or last[5] > 1 or size >= room):
                done = close()
                size = 0
                if done is not None:
                    yield done
            held.append(pdf.iloc[a:b])
            size += b - a
            last = key
    if held:
        done = close()
        if done is not None:
            yield done


def near_words(vocabulary: DataFrame, least: int = LEAST_LETTERS, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) for each word of ``vocabulary`` (word, n) with near words: how
    many, and the one of largest n (ties: smallest in code-point order)."""
    size = F.length("word")
    kinds = F.array(*[F.struct((size - less).alias("shorter"), F.lit(back).alias("back"))
                      for less in (0, 1) for back in (0, 1)])
    posted = vocabulary.select("word", "n", F.inline(kinds)).where(F.col("shorter") >= least)
    half = F.floor((F.col("shorter") - 1) / 2).cast("int")
    part = F.when(F.col("back") == 0, F.substring("word", F.lit(1), half)).otherwise(F.reverse(F.right("word", half)))
    posted = posted.withColumn("half", F.xxhash64(part))
    # blocks hold the fewer words, the longer the words are
    weight = F.ceil(F.count(F.lit(1)) * F.greatest(F.lit(1.0), F.col("shorter") / F.lit(float(HALF_SIZED))))
    large = materialise(posted.groupBy(*KEYS).agg(weight.cast("long").alias("weight"))
                        .where(F.col("weight") > block), "large-groups")
    # fewer than 4 words of the vocabulary in ``block`` can be a large group of short words
    few = bound_for_broadcast(large, large.count(), 100_000)
    sized = posted.join(few, KEYS, "left").withColumn("weight", F.coalesce("weight", F.lit(1).cast("long")))
    dealt = block_pairs(sized, KEYS, "weight", F.col("word"), block)
    dealt = dealt.withColumn("blocks", F.ceil(F.col("weight") / F.lit(block)))
    cells = dealt.repartition(*KEYS, "bi", "bj").sortWithinPartitions(*KEYS, "bi", "bj")
    found = cells.select("word", "n", *KEYS, "bi", "bj", "side", "blocks").mapInPandas(_cells, FOUND)
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("b"))
            .select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.less")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): forms followed to the last.  Pointers double, so a
    chain of any length takes logarithmically many joins; forms must not run in circles."""
    now = materialise(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while now.where("moved").limit(1).count():
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialise(now.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return now.select("word", "root")


def variants(counts: DataFrame, least: int = LEAST_LETTERS, least_n: int = 2, times: int = 10,
             block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the words of ``counts`` (word, n) with at least
    ``least`` letters and ``least_n`` occurrences.

    ``form``: the near word of largest n, if that is at least ``times`` (> 1) the word's own n;
    ``root``: from the word, forms followed to the last (itself without one).  Repeated words
    and nulls in ``counts`` are summed and left out; an empty table gives an empty result."""
    if times < 2:
        raise ValueError("a form must be more frequent than its variant")
    vocabulary = materialise(counts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
                             .where((F.length("word") >= least) & (F.col("n") >= least_n)), "vocabulary")
    near = near_words(vocabulary, least, block)
    is_form = F.col("best_n") >= F.lit(times) * F.col("n")
    own = materialise(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "variants")
    last = roots(own.where("form is not null").select("word", "form"))
    return (own.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
