"""Toxic passages by maximum-scoring segment search.

Words and their beginnings have log-odds of standing in toxic rather than clean documents,
with a Dirichlet prior; a token scores the best odds among its own, and tokens without
significant odds cost a little.  A linear scan finds every maximal
scoring segment of a text; extreme-value statistics of clean text say how surprising the best
one is for the text's length; a logistic fit turns that into a probability.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[^\W\d_]+")
TRAIN_DOCS = 30_000        # at most so many labelled documents are learned from
LEXICON = 20_000           # at most so many tokens have odds of their own
PRIOR = 10.0               # documents that the Dirichlet prior is worth
LEAST_Z = 3.0              # tokens whose log-odds are fewer standard deviations above 0 have none
COST = 0.2                 # what a token without odds costs
SIGNIFICANT = 0.01         # passages at most so likely in clean text of that length are reported


@dataclass(frozen=True)
class Model:
    odds: dict[str, float]     # word or beginning of one -> score
    rate: float                # extreme values: decay of the best score in clean text
    scale: float               # and segments per token
    weights: tuple[float, float, float]    # logistic: bias, surprise, number of passages


def tokens(text: str) -> list[str]:
    return [w.lower() for w in TOKEN.findall(text)]


def features(word: str) -> list[str]:
    """A word and its beginnings of three to eight letters (marked by a star)."""
    return [word, *(word[:k] + "*" for k in range(3, min(8, len(word)) + 1))]


class Odds(dict):
    """Score of each word met: the best odds of its features, 0.0 without any; at most about
    ``most`` words are remembered."""

    def __init__(self, odds: dict[str, float], most: int = 300_000):
        super().__init__()
        self.odds, self.most = odds, most

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        best = max((self.odds.get(f, 0.0) for f in features(word)), default=0.0)
        self[word] = best
        return best


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score) of a list of scores, left to
    right, in linear time.  Candidates are kept with the totals before and after them; a new
    one either stands alone or takes in everything back to the last candidate that began
    lower, if that one ended lower, too."""
    kept: list[list] = []          # start, end, total before, total after, last one that began lower
    total = 0.0
    for k, s in enumerate(scores):
        if s > 0:
            start, low, high = k, total, total + s
            j = len(kept) - 1
            while True:
                while j >= 0 and kept[j][2] >= low:
                    j = kept[j][4]
                if j < 0 or kept[j][3] >= high:
                    # what lies behind j began no lower: it stays, but later ones skip it
                    kept.append([start, k + 1, low, high, j])
                    break
                start, low, back = kept[j][0], kept[j][2], kept[j][4]
                del kept[j:]
                j = back
        total += s
    return [(a, b, high - low) for a, b, low, high, _ in kept]


def segments(words: list[str], odds: Odds, cost: float = COST) -> list[tuple[int, int, float]]:
    """Maximal segments of a text as (first word, last word exclusive, score)."""
    values = list(map(odds.__getitem__, words))
    hits = [k for k, v in enumerate(values) if v]
    if not hits:
        return []
    scores, last = [], hits[0]
    for k in hits:
        scores += [-cost * (k - last), values[k]]
        last = k + 1
    return [(hits[a // 2], hits[(b - 1) // 2] + 1, s) for a, b, s in maximal_segments(scores)]


def surprise(best: float, n: int, rate: float, scale: float) -> float:
    """-log10 of the probability that clean text of ``n`` tokens has a segment as good as that."""
    if best <= 0 or n <= 0:
        return 0.0
    log_mean = math.log(scale * n) - rate * best          # of the number of such segments
    if log_mean < -20:
        return -log_mean / math.log(10)
    return -math.log10(max(1e-300, -math.expm1(-math.exp(log_mean))))


# --- training ----------------------------------------------------------------------------------

def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int, learn) -> DataFrame:
    """``id``, ``text``, ``toxic``, ``half`` of at most ``most`` labelled documents (by hash of
    the id) for which ``learn(id)`` holds.  Only their ids are broadcast: 16 bytes each."""
    own = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
           .select(F.col(id_col).cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")))
    own = own.where(learn(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    own = own.orderBy(F.xxhash64(F.lit(1), "id"), "id").limit(most)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (texts.join(F.broadcast(own), "id")
            .withColumn("half", F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(2)).cast("int")))


def _doc_frequencies(batches):
    """(token, clean, toxic): in how many of the task's documents each token stands."""
    from collections import Counter

    import pandas as pd

    count = (Counter(), Counter())
    for pdf in batches:
        for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
            met = {f for w in set(tokens(text or "")) for f in features(w)}
            count[1 if toxic else 0].update(met | {""})     # "" counts documents
    words = list(count[0].keys() | count[1].keys())
    for a in range(0, len(words), 50_000):
        own = words[a:a + 50_000]
        yield pd.DataFrame({"token": own, "clean": [count[0][w] for w in own], "toxic": [count[1][w] for w in own]})


def lexicon(sample: DataFrame, least_z: float = LEAST_Z, prior: float = PRIOR, most: int = LEXICON) -> dict[str, float]:
    """Tokens with significantly positive log-odds (Dirichlet prior in proportion to the pooled
    counts), at most ``most``, the most significant first."""
    freq = (sample.select("text", "toxic").mapInPandas(_doc_frequencies, "token string, clean long, toxic long")
            .groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    freq = freq.where("toxic > 2 or token = ''")
    docs = freq.where("token = ''").first()
    if docs is None or not docs["clean"]:
        return {}
    n0, n1 = float(docs["clean"]), float(docs["toxic"])
    a = F.lit(prior) * (F.col("clean") + F.col("toxic")) / (n0 + n1)
    y0, y1 = F.col("clean") + a, F.col("toxic") + a
    delta = F.log(y1 / (n1 + prior - y1 + 1)) - F.log(y0 / (n0 + prior - y0 + 1))
    rows = (freq.where("token <> ''").select("token", delta.alias("d"), (delta / F.sqrt(1 / y0 + 1 / y1)).alias("z"))
            .where(F.col("z") >= least_z).orderBy(F.desc("z"), "token").limit(most).collect())
    return {r["token"]: float(r["d"]) for r in rows}


def _measured(odds: dict[str, float]):
    def run(batches):
        import pandas as pd

        own = Odds(odds)
        for pdf in batches:
            rows = []
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                words = tokens(text or "")
                found = segments(words, own)
                values = [round(v, 2) for v in map(own.__getitem__, words) if v]
                rows.append((int(toxic), len(words), max((s for *_, s in found), default=0.0), len(found), values))
            yield pd.DataFrame(rows, columns=["toxic", "n", "best", "found", "values"])
    return run


def decay(shares: dict[float, float], cost: float = COST) -> float:
    """The positive root of E[exp(rate * score)] = 1, for the shares of the tokens of clean text
    that have each score."""
    s, p = np.array(list(shares)), np.array(list(shares.values()))
    rest = 1 - p.sum()

    def excess(x):
        return float((p * np.exp(np.minimum(x * s, 600))).sum() + rest * math.exp(-x * cost) - 1)

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    if (p * s).sum() >= rest * cost:
        return 1e-3
    low = 1e-6
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          most: int = TRAIN_DOCS, learn=lambda i: F.lit(True)) -> Model:
    """Learn from at most ``most`` labelled documents: the odds from one half of them, the
    extreme-value statistics and the logistic fit from the other.  The driver sees the
    lexicon and one small row per document of the second half."""
    sample = labelled(docs, labels, id_col, text_col, most, learn)
    odds = lexicon(sample.where("half = 0"))
    schema = "toxic int, n long, best double, found long, values array<double>"
    rows = sample.where("half = 1").select("text", "toxic").mapInPandas(_measured(odds), schema).collect()
    clean = [r for r in rows if not r["toxic"]]
    total = sum(r["n"] for r in clean) + 1
    shares = {round(max(odds.values(), default=1.0), 2): 0.5 / total}       # never none
    for r in clean:
        for v in r["values"]:
            shares[v] = shares.get(v, 0.0) + 1 / total
    rate = decay(shares)
    # segments per token: those seen in clean text, against what the decay alone would give
    several = sorted(r["best"] for r in clean if r["best"] > 0)
    middle = several[len(several) // 2] if several else 0.0
    above = sum(b >= middle for b in several)
    scale = min(1.0, max(1e-9, (above + 0.5) * math.exp(min(rate * middle, 50.0)) / total))
    x = np.array([[1.0, surprise(r["best"], r["n"], rate, scale), min(r["found"], 5)] for r in rows]).reshape(-1, 3)
    y = np.array([r["toxic"] for r in rows], float)
    return Model(odds, rate, scale, tuple(logistic(x, y)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> list[float]:
    """Newton's method with a ridge; weights of features stay non-negative."""
    w = np.zeros(x.shape[1])
    if not len(x):
        return [-2.0, 1.0, 0.0]
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (y - q) - ridge * w
        hess = (x * (q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -2, 2)
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


# --- scoring -----------------------------------------------------------------------------------

PASSAGE = "array<struct<start:bigint,end:bigint,score:double>>"


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
           significant: float = SIGNIFICANT) -> DataFrame:
    """``id_col``, ``score`` (0 to 1) and ``passages`` (start, end in code points, score) of every
    whole text.  The only input of a score is the text.

    Null and empty texts have no passage and the score of text without any sign; null ids and
    repeated rows are scored like others; an empty table gives none.  No shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pandas as pd

        bias, by_surprise, by_number = model.weights
        odds = Odds(model.odds)
        for pdf in batches:
            scores, passages = [], []
            for text in pdf["text"]:
                text = text or ""
                words = tokens(text)
                found = segments(words, odds)
                best = max((s for *_, s in found), default=0.0)
                z = bias + by_surprise * surprise(best, len(words), model.rate, model.scale) + by_number * min(len(found), 5)
                scores.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
                own = [f for f in found
                       if surprise(f[2], len(words), model.rate, model.scale) >= -math.log10(significant)]
                if own:
                    at = [m.span() for m in TOKEN.finditer(text)]
                    own = [{"start": at[a][0], "end": at[b - 1][1], "score": s} for a, b, s in own]
                passages.append(own)
            out = pd.DataFrame({id_col: pdf[id_col], "score": scores})
            out["passages"] = passages
            yield out

    return (docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
            .mapInPandas(run, f"`{id_col}` {kind}, score double, passages {PASSAGE}"))
