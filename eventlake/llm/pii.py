"""Personal data by weak supervision.

Candidates are the base patterns' spans and looser forms of them.  Labelers vote on each
candidate (pattern, gazetteer, context, surroundings); expectation-maximisation over the votes
estimates how reliable the labelers are and how likely each kind is; a span classifier fitted
on those posteriors decides on the spans that the method adds.  Base spans always stay.
DataFrame functions only: the driver sees the counts of vote patterns, at most 3 ** labelers
per kind.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import apart

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  Possessive forms and look-behinds match the same spans as
# the plain ones, without stack or backtracking on very long runs.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"

# Looser forms, as candidates of the method.
LOOSE = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?"
              r"[A-Za-z0-9-]{1,63}+(?:\x20?(?:[\[(]\x20?(?:dot|DOT)\x20?[\])]|\.)\x20?[A-Za-z0-9-]{1,63}+)+"),
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?[\[(]\.[\])]\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9._/-])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9])|(?<![0-9])[0-9]{13,19}+(?![0-9])",
    "phone": r"(?<![0-9.+-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}

# Gazetteer and context words of the labelers.
MAIL_ENDS = r"(?i)\.(?:com|org|net|edu|gov|io|info|de|fr|es|it|nl|uk|eu|at|ch|us)$"
DIAL_CODES = r"^\+(?:1|7|20|27|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])(?![0-9]{10})"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
CONTEXT = {
    "email": r"(?i)(?:mail|contact|kontakt|correo|courriel|write|schreib|escrib)[^\n]{0,30}$",
    "ip": r"(?i)(?:\bip\b|address|adresse|server|host|login|client)[^\n]{0,30}$",
    "card": r"(?i)(?:card|karte|carte|tarjeta|visa|mastercard|credit|kredit|iban|pay)[^\n]{0,30}$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobil|anruf|appel|llam|cell)[^\n]{0,30}$",
}
AGAINST = r"(?i)(?:version|release|section|isbn|issn|serial|order|chapter|kapitel|\bno\.?|\bnr\.?|#)[^\n0-9]{0,6}$"
LABELERS = ("pattern", "gazetteer", "context", "surround", "variety")
LEFT = 48


# --- spans of a row ----------------------------------------------------------------------------

def _found(text: Column, pattern: str, may: Column) -> tuple[Column, Column]:
    """Matches of ``pattern`` and the pieces between them (one more), only where ``may`` holds."""
    return (F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))),
            F.when(may, F.split(text, pattern, -1)))


def _spans(found: str, between: str) -> Column:
    """Array of (start, end, txt) from a column of matches and one of the pieces between.

    Starts are running sums of lengths, taken in blocks of 256 matches so that a text full of
    matches does not copy its spans once per match."""
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint,txt:string>>)")

    def one(acc, k):
        start = acc["at"] + F.length(F.get(F.col(between), k))
        end = (start + F.length(F.get(F.col(found), k))).cast("long")
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.cast("long").alias("start"), end.alias("end"), F.get(F.col(found), k).alias("txt")))).alias("out"))

    def block(acc, b):
        ks = F.sequence(b * 256, F.least(b * 256 + 255, F.size(found) - 1))
        own = F.aggregate(ks, F.struct(acc["at"].alias("at"), empty.alias("out")), one)
        return F.transform(F.array(own), lambda o: F.struct(
            o["at"].alias("at"), F.concat(acc["out"], o["out"]).alias("out")))[0]

    blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / 256).cast("int"))
    whole = F.aggregate(blocks, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")), block)
    return F.when(F.size(found) > 0, whole["out"]).otherwise(empty)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    """The check digit rule, for 13 to 19 digits."""
    own = F.reverse(_digits(x))
    at = F.sequence(F.lit(1), F.least(F.greatest(F.length(own), F.lit(1)), F.lit(19)))

    def add(acc, k):
        d = F.substring(own, k, F.lit(1)).cast("int") * (F.lit(2) - k % 2)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return (F.length(own).between(13, 19)) & (F.aggregate(at, F.lit(0), add) % 10 == 0)


def _base_ok(kind: str, x: Column) -> Column:
    if kind == "ip":
        return x.rlike(OCTETS)
    if kind == "card":
        return F.length(_digits(x)).between(16, 19) & _luhn(x)
    if kind == "phone":
        return F.length(_digits(x)).between(8, 15)
    return F.lit(True)


def _passes(kind: str):
    return lambda s: _base_ok(kind, s["txt"])


def _as(kind: str, base: bool):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                              s["txt"].alias("txt"), F.lit(base).alias("base"))


def with_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__base`` (array of kind, start, end: by kind as listed, then start; code
    points, end exclusive) and ``__cands`` (array of kind, start, end, base, and the labelers'
    votes 1, 0 or -1) of each whole text.  Null text has none."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.withColumn("__t", text)
    t, digit = F.col("__t"), F.col("__t").rlike("[0-9]")
    may = {"email": t.contains("@"), "ip": digit & t.rlike(r"[0-9]\.[0-9]"), "card": digit,
           "phone": t.contains("+")}
    loose_may = {"email": t.rlike(r"[\[(]\x20?(?:at|AT)\x20?[\])]"), "ip": digit & t.rlike(r"[\[(]\.[\])]"),
                 "card": digit, "phone": digit}
    for kind, pattern in zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True):
        for tag, p, m in (("b", pattern, may[kind]), ("l", LOOSE[kind], loose_may[kind])):
            found, between = _found(t, p, m)
            df = df.withColumn(f"__{tag}f_{kind}", found).withColumn(f"__{tag}p_{kind}", between)
    for kind in KINDS:
        df = df.withColumn(f"__bs_{kind}", F.filter(_spans(f"__bf_{kind}", f"__bp_{kind}"), _passes(kind)))
        df = df.withColumn(f"__ls_{kind}", _spans(f"__lf_{kind}", f"__lp_{kind}"))
    df = df.withColumn("__all", F.concat(*[F.transform(f"__bs_{k}", _as(k, True)) for k in KINDS]))
    fresh = [F.filter(f"__ls_{k}", lambda s: ~F.exists(
        "__all", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))) for k in KINDS]
    cands = F.concat("__all", *[F.transform(f, _as(k, False)) for k, f in zip(KINDS, fresh, strict=True)])
    df = df.withColumn("__c", cands)
    voted = F.transform("__c", _voted)
    light = F.transform("__all", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return df.select(*docs.columns, F.inline(F.array(F.struct(light.alias("__base"), voted.alias("__cands")))))


def _voted(s: Column) -> Column:
    """A candidate with its votes."""
    kind, x = s["kind"], s["txt"]
    left = F.substring(F.col("__t"), F.greatest(s["start"] - LEFT, F.lit(0)).cast("int") + 1,
                       F.least(s["start"], F.lit(LEFT)).cast("int"))
    before = F.when(s["start"] > 0, F.substring(F.col("__t"), s["start"].cast("int"), F.lit(1))).otherwise(F.lit(" "))
    after = F.substring(F.col("__t"), s["end"].cast("int") + 1, F.lit(1))
    pattern = F.when(s["base"], 1).when(kind == "card", F.when(_luhn(x), 1).otherwise(-1)).otherwise(0)
    gazetteer = (F.when(kind == "email", F.when(x.rlike(MAIL_ENDS), 1).otherwise(0))
                 .when(kind == "ip", F.when(x.rlike(r"^(?:0|255)\.|^127\.0\.0\.1$"), -1).otherwise(0))
                 .when(kind == "card", F.when(_digits(x).rlike(ISSUERS), 1).otherwise(-1))
                 .otherwise(F.when(x.rlike(DIAL_CODES), 1).otherwise(0)))
    near = F.lit(False)
    for k in KINDS:
        near = near | ((kind == k) & left.rlike(CONTEXT[k]))
    context = F.when(left.rlike(AGAINST), -1).when(near, 1).otherwise(0)
    surround = F.when(before.rlike(r"[A-Za-z0-9_]") | after.rlike(r"[A-Za-z0-9_]"), -1).otherwise(1)
    digits = _digits(x)
    variety = F.when((kind != "email") & (F.length(digits) > 7)
                     & (F.length(F.regexp_replace(digits, F.substring(digits, 1, 1), "")) <= 2), -1).otherwise(0)
    return F.struct(kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"),
                    *[v.cast("int").alias(n) for n, v in zip(LABELERS, (pattern, gazetteer, context, surround, variety), strict=True)])


# --- weak supervision --------------------------------------------------------------------------

def vote_counts(found: DataFrame) -> list[dict]:
    """How often each pattern of votes stands in the corpus, by kind: a bounded table."""
    rows = (found.where(F.size("__cands") > 0).select(F.explode("__cands").alias("c"))
            .groupBy("c.kind", *[f"c.{n}" for n in LABELERS]).agg(F.count(F.lit(1)).alias("n")))
    return [r.asDict() for r in rows.collect()]


def reliabilities(counts: list[dict], rounds: int = 50, strength: float = 20.0) -> dict:
    """Expectation-maximisation: the share of true spans of each kind, and each labeler's
    probability of each vote on true and on false ones, smoothed by ``strength`` votes of a
    labeler that is right four times in five (the pattern labeler, which knows check digits:
    twenty-four times in twenty-five)."""
    def votes(wrong: float, right: float) -> dict:
        rest = 1 - wrong - right
        return {(v, z): p for z, ps in ((1, (wrong, rest, right)), (0, (right, rest, wrong)))
                for v, p in zip((-1, 0, 1), ps, strict=True)}

    prior = {n: votes(0.02, 0.58) if n == "pattern" else votes(0.1, 0.5) for n in LABELERS}
    share = {k: 0.5 for k in KINDS}
    rate = {n: dict(prior[n]) for n in LABELERS}
    post = []
    for _ in range(rounds):
        post = []
        for r in counts:
            odds = math.log(share[r["kind"]] / (1 - share[r["kind"]]))
            odds += sum(math.log(rate[n][r[n], 1] / rate[n][r[n], 0]) for n in LABELERS)
            post.append(1 / (1 + math.exp(-max(-60.0, min(60.0, odds)))))
        for k in KINDS:
            n = sum(r["n"] for r in counts if r["kind"] == k)
            true = sum(p * r["n"] for p, r in zip(post, counts, strict=True) if r["kind"] == k)
            share[k] = (true + strength / 2) / (n + strength)
        for name in LABELERS:
            for z in (0, 1):
                weight = {v: strength * prior[name][v, z] for v in (-1, 0, 1)}
                for p, r in zip(post, counts, strict=True):
                    weight[r[name]] += r["n"] * (p if z else 1 - p)
                total = sum(weight.values())
                for v in (-1, 0, 1):
                    rate[name][v, z] = weight[v] / total
    return {"share": share, "rate": rate, "posterior": post}


def fit_classifier(counts: list[dict], posterior: list[float], rounds: int = 400, ridge: float = 1.0) -> dict:
    """Logistic regression on kind and votes, fitted to the posteriors by gradient steps."""
    weight = {("kind", k): 0.0 for k in KINDS} | {(n, v): 0.0 for n in LABELERS for v in (-1, 0, 1)}
    total = sum(r["n"] for r in counts) or 1
    for _ in range(rounds):
        step = {f: -ridge * w / total for f, w in weight.items()}
        for r, p in zip(counts, posterior, strict=True):
            own = [("kind", r["kind"]), *((n, r[n]) for n in LABELERS)]
            q = 1 / (1 + math.exp(-max(-60.0, min(60.0, sum(weight[f] for f in own)))))
            for f in own:
                step[f] += r["n"] / total * (p - q)
        for f in weight:
            weight[f] += 2.0 * step[f]
    return weight


def train(found: DataFrame) -> dict:
    """The span classifier's weights for the candidates of ``found`` (see :func:`with_candidates`)."""
    counts = sorted(vote_counts(found), key=lambda r: tuple(r.values()))
    return fit_classifier(counts, reliabilities(counts)["posterior"])


def _score(c: Column, weight: dict) -> Column:
    out = F.lit(0.0)
    for (name, value), w in weight.items():
        out = out + F.when(c[name] == value, F.lit(float(w))).otherwise(F.lit(0.0))
    return out


@apart
def personal_data(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``__base`` and ``__spans``: arrays of (kind, start, end) by kind as listed,
    then start, in code points with the end exclusive.  ``__spans`` holds the base spans and the
    candidates whose probability under the trained classifier exceeds ``threshold``.

    Null or empty text has no spans; repeated rows are alike; spans of different kinds may
    overlap; an empty table trains nothing and stays empty; other columns pass through.  Rows
    stay where they are: the only exchange sums vote patterns."""
    found = with_candidates(docs, text_col)
    weight = train(with_candidates(docs.select(text_col), text_col))
    limit = math.log(threshold / (1 - threshold))
    chosen = F.filter("__cands", lambda c: c["base"] | (_score(c, weight) > limit))
    def order(c):
        at = F.lit(len(KINDS))
        for i, k in enumerate(KINDS):
            at = F.when(c["kind"] == k, F.lit(i)).otherwise(at)
        return F.struct(at.alias("o"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))

    spans = F.transform(F.sort_array(F.transform(chosen, order)),
                        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.withColumn("__spans", spans).drop("__cands")


def joined(spans: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@apart
def masked(docs: DataFrame, text_col: str = "text", count_col: str = "n_chars", **how) -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets (of overlapping spans,
    the first; a shorter rest goes with it), columns as they were; ``count_col``, if there, is
    the new text's length."""
    df = personal_data(docs, text_col, **how)
    by_place = F.sort_array(F.transform("__spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    df = df.withColumn("__place", by_place)
    text = F.col(text_col).cast("string")

    def put(acc, s):
        fresh = s["start"] >= acc["at"]
        keep = F.substring(text, acc["at"].cast("int") + 1, F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(s["end"], acc["at"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], keep, F.lit("<"), F.upper(s["kind"]), F.lit(">")))
                        .otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    whole = F.aggregate("__place", start, put, lambda a: F.concat(
        a["out"], F.substring(text, a["at"].cast("int") + 1, F.lit(2 ** 31 - 1))))
    df = df.withColumn(text_col, F.when(F.size("__place") > 0, whole).otherwise(text))
    if count_col in docs.columns:
        kind = docs.schema[count_col].dataType
        df = df.withColumn(count_col, F.when(F.size("__place") > 0, F.length(text_col).cast(kind)).otherwise(F.col(count_col)))
    return df.select(*docs.columns)
