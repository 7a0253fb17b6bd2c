"""Secret scan with corpus-wide ownership frequency.

One pass finds candidates in whole texts: the base patterns, whose spans always stay, and looser
ones.  Each candidate's value is known by its SHA-256 from there on.  Per value the corpus is asked
how many repositories hold it, under how many owners, and how they are spread: a value of many
owners, none of whom holds most of its repositories, is a widely copied example; one that
belongs to few owners or mostly to one, and looks random, is a live-looking credential.  Looser
candidates are reported only if they look live.

A value that a third of all rows hold is counted through partial aggregates by (value, owner,
repository) and (value, owner), and met again by its holders over salted keys.
"""

from __future__ import annotations

import bisect
import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import materialise

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("loose", "service", "mixed")
KINDS = BASE_KINDS + ADDED_KINDS

# The base patterns, each with the group that is its value and that group's least
# length (the rest of the match may be of any length).
BASE = {
    "assign": (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}
# Looser forms, as candidates of the method.
ADDED = {
    "loose": (r"(?i:pwd|passphrase|auth|credentials?|bearer|access_?id|private_?key|client_?id)[\"']?\x20*"
              r"[:=]?\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12),
    "service": (r"(?:gh[opsu]_|github_pat_|glpat-|xox[abprs]-|sk_live_|rk_live_|sk-|npm_|AIza|ya29\.|eyJ)"
                r"[A-Za-z0-9_.-]+", 0, 20),
    "mixed": (r"[A-Za-z0-9]+", 0, 24),
}
#: What a text must hold, lower-cased, for a pattern to be tried.
HINTS = {
    "assign": (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
    "loose": (b"pwd", b"passphrase", b"auth", b"credential", b"bearer", b"accessid", b"access_id", b"privatekey",
              b"private_key", b"clientid", b"client_id"),
    "service": (b"gh", b"glpat-", b"xox", b"k_live_", b"sk-", b"npm_", b"aiza", b"ya29.", b"eyj"),
}
LIVE_LETTERS = 10       # different characters of a live-looking value, digits and letters among them
MOST_OWNERS = 2         # owners of a value that is nobody's in particular: more than this many
SALTS = 16

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType()),
                     T.StructField("value", T.BinaryType()), T.StructField("random", T.BooleanType())])
FOUND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("owner", T.StringType()),
                      T.StructField("repository", T.StringType()), T.StructField("spans", T.ArrayType(SPAN))])


# --- one text ------------------------------------------------------------------------------------

def _whole_runs(pattern: str, least: int) -> str:
    """A pattern of one class of characters matches whole runs, so short ones need not be built."""
    return pattern.removesuffix("+") + f"{{{least},}}"


_MATCH = {k: re.compile(_whole_runs(p, least) if k in ("hex", "mixed") else p, re.ASCII)
          for k, (p, _, least) in (BASE | ADDED).items()}


def looks_random(value: str) -> bool:
    """Letters and digits, and :data:`LIVE_LETTERS` different characters."""
    own = set(value)
    return len(own) >= LIVE_LETTERS and any(c.isdigit() for c in own) and any(c.isalpha() for c in own)


def candidates(text: str) -> list[tuple[str, int, int, bool, bytes, bool]]:
    """(kind, start, end, base, digest of the value, looks random) by start, then kind as listed.

    Each kind's matches are leftmost and do not overlap; one that fails its kind's rule is dropped
    and not tried again.  Looser candidates that touch a base span are that span's."""
    low = text.encode("utf-8", "surrogatepass").lower()
    out: list[tuple] = []
    for at, kind in enumerate(KINDS):
        if kind in HINTS and not any(h in low for h in HINTS[kind]):
            continue
        _, group, least = (BASE | ADDED)[kind]
        for m in _MATCH[kind].finditer(text):
            value = m.group(group)
            if len(value) >= least:
                out.append((m.start(), at, m.end(), value))
    base = sorted((s, e) for s, at, e, _ in out if at < len(BASE_KINDS))
    taken: list[list[int]] = []                     # the base spans' union
    for s, e in base:
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    begins = [s for s, _ in taken]
    kept = []
    for s, at, e, value in sorted(out, key=lambda c: c[:2]):
        if at >= len(BASE_KINDS):
            k = bisect.bisect_left(begins, e) - 1
            if k >= 0 and taken[k][1] > s:
                continue
        kept.append((KINDS[at], s, e, at < len(BASE_KINDS), hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest(),
                     looks_random(value)))
    return kept


def scan(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, owner, repository, spans) of each row, its whole text scanned once (null: empty)."""
    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        names = SPAN.fieldNames()
        kind = to_arrow_schema(FOUND).field("spans").type
        for batch in batches:
            spans = [[dict(zip(names, c, strict=True)) for c in candidates(t.as_py() or "")] for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, kind)], names=FOUND.fieldNames())

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), owner.cast("string").alias("owner"),
                      repository.cast("string").alias("repository"), F.col(text_col).cast("string").alias("t"))
    return own.mapInArrow(run, FOUND)


# --- ownership -------------------------------------------------------------------------------------

def ownership(found: DataFrame, most_owners: int = MOST_OWNERS) -> DataFrame:
    """One row per value: how many places, repositories and owners hold it, and its verdict:
    ``example`` (more than ``most_owners`` owners, none with more than half of its repositories),
    ``live`` (otherwise, if it looks random) or ``plain``.  A null owner is an owner of that name."""
    each = found.select("owner", "repository", F.explode("spans").alias("s"))
    held = (each.groupBy(F.col("s.value").alias("value"), "owner", "repository")
            .agg(F.count(F.lit(1)).alias("n"), F.max("s.random").alias("random")))
    owned = held.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"),
                                               F.max("random").alias("random"))
    out = owned.groupBy("value").agg(F.sum("n").alias("n_places"), F.sum("repositories").alias("n_repositories"),
                                     F.count(F.lit(1)).alias("n_owners"), F.max("repositories").alias("most"),
                                     F.max("random").alias("random"))
    spread = (F.col("n_owners") > most_owners) & (F.col("most") * 2 <= F.col("n_repositories"))
    verdict = F.when(spread, "example").when(F.col("random"), "live").otherwise("plain")
    return out.select("value", "n_places", "n_repositories", "n_owners", verdict.alias("verdict"))


def scanned(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text",
            most_owners: int = MOST_OWNERS) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, spans)`` for each row of ``docs``, and the corpus's :func:`ownership` table.

    ``spans``: array of (kind, start, end, base, verdict, n_repositories, n_owners) by start, then
    kind as listed; code points, end exclusive.  Base spans stay whatever their verdict; looser
    ones are there only if ``live``.  Null or empty text has none; repeated rows and equal or null
    ids are rows of their own; other columns of ``docs`` are not read."""
    # numbered once written, so that a repeated task cannot number anew
    found = materialise(scan(docs, owner, repository, id_col, text_col).withColumn(
        "row", F.monotonically_increasing_id()), "secret-candidates")
    values = materialise(ownership(found, most_owners), "secret-owners")
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS))
    each = found.select("row", F.inline("spans")).withColumn("salt", salt)
    salted = values.select("value", "verdict", "n_repositories", "n_owners",
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    # merged, never broadcast: the values grow with the corpus, and the planner does not see the salts
    judged = each.join(salted.hint("merge"), ["value", "salt"]).where("base or verdict = 'live'")
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    own = F.struct("start", order.alias("order"), "kind", "end", "base", "verdict", "n_repositories", "n_owners")
    spans = (judged.groupBy("row").agg(F.sort_array(F.collect_list(own)).alias("s"))
             .select("row", F.transform("s", lambda s: F.struct(
                 *[s[c].alias(c) for c in ("kind", "start", "end", "base", "verdict", "n_repositories", "n_owners")])).alias("spans")))
    none = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,base:boolean,"
                  "verdict:string,n_repositories:bigint,n_owners:bigint>>)")
    return found.select("row", "doc_id").join(spans, "row", "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans")), values


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
