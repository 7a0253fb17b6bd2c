"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def components(nodes: list[int], links) -> dict[int, int]:
    """Smallest node reachable from each."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out: dict[int, int] = {}
    for n in sorted(nodes):
        todo = [] if n in out else [n]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = n
                todo += near[x]
    return out


def shingle_set(text: str | None, k: int) -> set:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(low)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def near_duplicates(docs: list[tuple[int, str | None]], k: int, num: int, den: int) -> dict:
    sets = {i: shingle_set(t, k) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    root = components(list(sets), links)
    return {i: (len(s), root[i], root[i] == i) for i, s in sets.items()}


def text_statistics(text: str | None) -> tuple:
    text = text or ""
    w = WORDS.findall(text)
    where = defaultdict(list)
    for i in range(len(w) - 7):
        where[tuple(w[i:i + 8])].append(i)
    covered = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    worded = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(worded) - len(set(worded)), len(covered))


BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            if kind == "card":
                total = 0
                for k, d in enumerate(reversed(digits)):
                    v = int(d) * (1 + k % 2)
                    total += v - 9 if v > 9 else v
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            out.append((kind, m.start(), m.end()))
    return out


def without_boilerplate(docs: list[tuple[int, str | None, str | None]], most_sites: int) -> dict:
    """id -> (lines, removed, text) for documents (id, text, site)."""
    def key(x):
        return re.sub("[\t\x0b\x0c\r]", " ", x).strip(" ")

    sites, first = defaultdict(set), {}
    for i, text, site in sorted(docs, key=lambda d: d[0]):
        for k, x in enumerate((text or "").split("\n")):
            if key(x):
                sites[key(x)].add(site)
                first.setdefault(key(x), (i, k))
    out = {}
    for i, text, _ in docs:
        left, lines, removed = [], 0, 0
        for k, x in enumerate((text or "").split("\n")):
            lines += bool(key(x))
            if key(x) and len(sites[key(x)]) > most_sites and first[key(x)] != (i, k):
                removed += 1
            else:
                left.append(x)
        out[i] = (lines, removed, None if text is None else "\n".join(left))
    return out
