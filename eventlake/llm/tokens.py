"""Tokenising whole texts with a tokenizer file of the ``tokenizers`` library, inside tasks.

The ids equal the library's ``encode(text, add_special_tokens=False)``.  A plain text (blank,
line feed, printable ASCII, Latin-1 letters) is cut by the file's own splitting rule, any other
one where that rule always cuts (around white space); each distinct piece is encoded once and
remembered, and the pieces' ids are joined.  A piece without white space
that is longer than ``long_piece`` is encoded by *tree concatenation*: its halves (of halves)
are encoded independently, as one batch, and joined bottom-up; around each join a growing
window is encoded again until it agrees with both sides (see :func:`join_halves`).
"""

from __future__ import annotations

import json
import re
from array import array
from codecs import charmap_decode
from itertools import chain, filterfalse

import numpy as np

# Unicode White_Space as a character class, and the four controls that
# Python's str.split() takes for white space although they are not in White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
NOT_WHITE = "\x1c\x1d\x1e\x1f"
RARE_WHITE = "\t\x0b\x0c\r\x85\xa0                　"

# The two splitting rules, restricted to blank, line feed, printable ASCII and
# Latin-1 letters (there, normalisation is the identity and lower-casing is one to one).
PLAIN = "!-~À-ÖØ-öø-ÿ"
WORD_RULE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \na-zß-öø-ÿ0-9]+")
SPACED_RULE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+"
                         r"| ?[^ \nA-Za-zÀ-ÖØ-öø-ÿ0-9]+|[ \n]+(?![^ \n])|[ \n]+")

LONG_PIECE = 4096
CACHE_PIECES = 400_000
CHARS_AT_ONCE = 1 << 19


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes
    stand for themselves, the others follow from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Memory(dict):
    """Ids of pieces by piece; :meth:`fill` makes those of all unknown pieces at once.  Two
    generations: :meth:`age` (called between batches) forgets pieces not met since the one
    before, so it stays bounded by ``most`` pieces and those of one batch."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def fill(self, pieces) -> None:
        new = set(filterfalse(self.__contains__, pieces))
        if self.old:
            met = {p: self.old[p] for p in new if p in self.old}
            self.update(met)
            new.difference_update(met)
        if new:
            made = list(new)
            self.update(zip(made, self.make(made), strict=True))

    def age(self) -> None:
        if len(self) > self.most // 2:
            self.old = dict(self)
            self.clear()


class PieceEncoder:
    """One tokenizer file with its splitting rule, a bounded memory of pieces, and decoding.

    The kind is read from the file: *words* drop white space and lower-case (a word-end mark
    closes each word); *bytes* keep it, a blank belonging to the word after it."""

    def __init__(self, path: str, long_piece: int = LONG_PIECE, cache: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.words = told["model"].get("end_of_word_suffix") is not None
        self.special = tuple(t["content"] for t in told.get("added_tokens", ()))
        # a special token can only stand in a piece that has its first two characters
        self.marks = tuple({t[:2] for t in self.special})
        self.long_piece = long_piece
        self.model = self.lib.model
        self.letters = "".join(_byte_letters())
        self.dtype = np.dtype("<u2") if self.lib.get_vocab_size() <= 65536 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.strings = ([self.lib.id_to_token(k) for k in range(self.lib.get_vocab_size())]
                        if told.get("decoder") is None else None)
        self.white = re.compile(f"[^{WHITE}]+" if self.words else f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
        self.rule = WORD_RULE if self.words else SPACED_RULE
        self.plain = re.compile(f"(?:[{PLAIN}]{{0,{long_piece}}}+[ \\n])*+[{PLAIN}]{{0,{long_piece}}}+")
        self.parts = Memory(self._parts, cache)               # what the rule cuts plain texts into
        self.pieces = Memory(self._pieces, cache // 4)        # what white space cuts other texts into

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of plain texts, straight from the model."""
        # 1 stands between them: no part holds it, and its byte has a letter of its own
        shown = charmap_decode("\x01".join(parts).encode(), "strict", self.letters)[0].split(self.letters[1])
        tokenize, code = self.model.tokenize, self.code
        return [array(code, [t.id for t in tokenize(p)]).tobytes() for p in shown]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces by the library, long ones by tree concatenation."""
        short = [p for p in pieces if len(p) <= self.long_piece]
        made = iter(self.lib.encode_batch(short, add_special_tokens=False))
        return [array(self.code, next(made).ids if len(p) <= self.long_piece else tree_encode(self, p)[0]).tobytes()
                for p in pieces]

    def _cut(self, text: str) -> tuple[Memory, list[str]]:
        """The memory that a text is looked up in and what the text is cut into: the rule's own
        parts where it is plain, has no long piece and cannot hold a special token; otherwise
        pieces, cut where the rule cuts whatever stands around."""
        if self.plain.fullmatch(text) and not any(m in text for m in self.marks):
            return self.parts, self.rule.findall(text.lower() if self.words else text)
        if self.words and not any(c in text for c in NOT_WHITE):
            return self.pieces, text.split()
        return self.pieces, self.white.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian bytes of ``self.dtype``; what about
        ``CHARS_AT_ONCE`` characters of whole texts are cut into is held at a time."""
        out: list[bytes] = []
        held, chars = [], 0
        for k, text in enumerate(texts, 1):
            held.append(self._cut(text))
            chars += len(text)
            if chars < CHARS_AT_ONCE and k < len(texts):
                continue
            for memory in (self.parts, self.pieces):
                memory.age()
                memory.fill(chain.from_iterable(cut for own, cut in held if own is memory))
            out += [b"".join(map(own.__getitem__, cut)) for own, cut in held]
            held, chars = [], 0
        return out

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode([text])[0], dtype=self.dtype)

    def with_offsets(self, texts: list[str]) -> list[tuple[list[int], list[tuple[int, int]]]]:
        """Ids and character offsets of each text, straight from the library."""
        return [(e.ids, e.offsets) for e in self.lib.encode_batch(texts, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        """The library's decode(ids, skip_special_tokens=False); a file without a decoder
        joins its tokens with blanks, which a table lookup does faster."""
        if self.strings is not None:
            return " ".join(map(self.strings.__getitem__, ids))
        return self.lib.decode(ids, skip_special_tokens=False)


# --- tree concatenation ------------------------------------------------------------------------

def tree_encode(own: PieceEncoder, text: str) -> tuple[list[int], list[tuple[int, int]]]:
    """Ids and offsets of one long text by tree concatenation.

    The text is halved until the leaves have at most ``own.long_piece`` characters; all
    leaves are encoded independently in one batch; neighbours are joined level by level."""
    n = 1
    while len(text) > n * max(16, own.long_piece):
        n *= 2
    cuts = [len(text) * k // n for k in range(n + 1)]
    spans = [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]
    leaves = []
    for (a, _), (ids, offs) in zip(spans, own.with_offsets([text[a:b] for a, b in spans]), strict=True):
        leaves.append((ids, [(s + a, e + a) for s, e in offs]))
    bounds = spans
    while len(leaves) > 1:
        joined, wider = [], []
        for k in range(0, len(leaves) - 1, 2):
            joined.append(join_halves(own, text, leaves[k], leaves[k + 1], bounds[k], bounds[k + 1]))
            wider.append((bounds[k][0], bounds[k + 1][1]))
        if len(leaves) % 2:
            joined.append(leaves[-1])
            wider.append(bounds[-1])
        leaves, bounds = joined, wider
    return leaves[0] if leaves else ([], [])


def join_halves(own: PieceEncoder, text: str, left, right, lspan, rspan, first: int = 64, agree: int = 8):
    """Ids and offsets of ``text[lspan[0]:rspan[1]]`` from those of its two halves.

    A window around the join is encoded again; it is taken when it has ``agree`` tokens in a
    row in common (same id, same place) with the left half before the join and with the right
    half after it, away from its own ends.  Then left of the first run, and right of the
    second, all neighbouring tokens stand as they do in an encoding of one text, and between
    them as in the window's.  Otherwise the window doubles; in the end it is the whole."""
    lo, mid, hi = lspan[0], lspan[1], rspan[1]
    size = first
    while True:
        a, b = max(lo, mid - size), min(hi, mid + size)
        if a == lo and b == hi:
            (ids, offs), = own.with_offsets([text[lo:hi]])
            return ids, [(s + lo, e + lo) for s, e in offs]
        (ids, offs), = own.with_offsets([text[a:b]])
        offs = [(s + a, e + a) for s, e in offs]
        # the window's own ends are cuts as well: only runs away from them count, unless an
        # end of the window is the end of the halves
        start = (0, 0) if a == lo else _run(left, (ids, offs), agree, a, mid)
        end = (len(right[0]), len(ids)) if b == hi else _run(right, (ids, offs), agree, mid, b)
        if start and end and start[1] <= end[1]:
            (i, w), (j, x) = start, end
            return (left[0][:i] + ids[w:x] + right[0][j:], left[1][:i] + offs[w:x] + right[1][j:])
        size *= 2


def _run(side, window, agree: int, lo: int, hi: int):
    """The middle (index in side, index in window) of the first stretch of ``agree`` tokens in
    a row, strictly inside ``(lo, hi)``, that ``side`` and ``window`` have in common (same id,
    same place); None without one."""
    (sid, soff), (wid, woff) = side, window
    place: dict[int, int] = {}
    for k, (s, _) in enumerate(soff):
        if lo <= s <= hi:
            place.setdefault(s, k)
    common: list[tuple[int, int]] = []
    for w, off in enumerate(woff):
        s = common[-1][0] + 1 if common else place.get(off[0])
        fits = (s is not None and s < len(sid) and sid[s] == wid[w] and soff[s] == off
                and lo < off[0] and off[1] < hi)
        if not fits and common:
            common = []
            s = place.get(off[0])
            fits = s is not None and sid[s] == wid[w] and soff[s] == off and lo < off[0] and off[1] < hi
        if fits:
            common.append((s, w))
        if len(common) == agree:
            return common[agree // 2]
    return None


_CODERS: dict[tuple, PieceEncoder] = {}


def coder(path: str, long_piece: int = LONG_PIECE, cache: int = CACHE_PIECES) -> PieceEncoder:
    """The encoder of a tokenizer file, kept for the life of a Python worker."""
    key = (path, long_piece, cache)
    if key not in _CODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _CODERS[key] = PieceEncoder(path, long_piece, cache)
    return _CODERS[key]
