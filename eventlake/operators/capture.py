"""The capture specification.

A session is a list of :class:`CaptureSpec`.  Each spec names one event kind,
an optional predicate over payload fields, the context columns (actions) to
keep and optional fields to switch on or off.  :func:`capture` applies the
whole session in ONE pass: one filter that ORs every (kind AND predicate) and
one projection that picks each kind's keep-lists with ``CASE Name``.  No
unions, no shuffle; Catalyst pushes ``Name IN (...)`` into the scan.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.envelope import ENVELOPE_COLUMNS, field_sql, json_path

_PLACEHOLDER = re.compile(r"\[([A-Za-z_][A-Za-z0-9_]*)\]")
_QUALIFIED = re.compile(r"\[([A-Za-z_][A-Za-z0-9_]*)\]\.\[([A-Za-z_][A-Za-z0-9_]*)\]")
_UNICODE_PREFIX = re.compile(r"(?<![A-Za-z0-9_])N$")
_QUOTED = re.compile(r"('(?:[^'\\]|''|\\.)*')")
_ATTR_PREFIX = "collect_"
# a field beside a comparison or an arithmetic sign, and the literal on its other side
_FIELD = r"\[(?:[A-Za-z_]\w*\]\.\[)?([A-Za-z_]\w*)\]"
_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_COMPARED = r"\s*(?:[<>]=?|=|==|<=>|<>|!=|(?:NOT\s+)?IN\s*\(|(?:NOT\s+)?BETWEEN\b)\s*"
_NUMERIC = (re.compile(_FIELD + _COMPARED + _NUMBER + r"(?![\w'])", re.IGNORECASE),
            re.compile(r"(?<![\w'.])" + _NUMBER + r"\s*(?:[<>]=?|=|==|<=>|<>|!=)\s*" + _FIELD, re.IGNORECASE),
            re.compile(_FIELD + r"\s*[-+*/%]"), re.compile(r"[-+*/%]\s*" + _FIELD))
#: Type of a field that is compared with a number and has no declared type: whole numbers of 64 bits and
#: fractions compare exactly, and text that is no number is NULL, so it never matches and never fails.
NUMBER_TYPE = "decimal(38,9)"


def inferred_types(predicate: str) -> dict[str, str]:
    """Types of the fields that ``predicate`` compares or reckons with numbers, outside its string literals."""
    plain = "".join(p if i % 2 == 0 else " '' " for i, p in enumerate(_QUOTED.split(predicate)))
    return {name: NUMBER_TYPE for pattern in _NUMERIC for name in pattern.findall(plain)}


@dataclass(frozen=True)
class CaptureSpec:
    """One event definition."""

    name: str
    package: str = "sqlserver"
    actions: Sequence[str] | None = None          # None: keep all context columns
    attributes: Mapping[str, str] = dc_field(default_factory=dict)   # collect_X -> "0"/"1"
    predicate: str | None = None                  # Spark SQL over [field] placeholders
    field_types: Mapping[str, str] = dc_field(default_factory=dict)  # field -> SQL type

    def predicate_column(self) -> Column | None:
        """``[x]`` reads payload field x, ``[package].[x]`` reads context column x
        (typed by ``field_types``, else by a number that it is compared with, else a string);
        ``N'...'`` literals are plain literals; blank means no filter.  Substitution happens outside
        string literals."""
        if self.predicate is None or not self.predicate.strip():
            return None
        types = {**inferred_types(self.predicate), **self.field_types}

        def typed(payload: str, key: str) -> str:
            return field_sql(payload, key, types.get(key, "string"))

        def outside(part: str, followed_by_literal: bool) -> str:
            part = _QUALIFIED.sub(lambda m: typed("Actions", m.group(2)), part)
            part = _PLACEHOLDER.sub(lambda m: typed("Fields", m.group(1)), part)
            return _UNICODE_PREFIX.sub("", part) if followed_by_literal else part

        parts = _QUOTED.split(self.predicate)      # odd positions are string literals
        text = "".join(p if i % 2 else outside(p, i + 1 < len(parts)) for i, p in enumerate(parts))
        return F.expr(text)

    def dropped_fields(self) -> list[str]:
        """C4: fields switched off by ``collect_X = 0``."""
        out = []
        for attr, value in self.attributes.items():
            if attr.startswith(_ATTR_PREFIX) and str(value).strip() in ("0", "false", "False"):
                out.append(attr[len(_ATTR_PREFIX):])
        return out


def _check(specs: Sequence[CaptureSpec]) -> None:
    seen = set()
    for s in specs:
        if s.name in seen:
            raise ValueError(f"event kind {s.name!r} is declared twice in one session")
        seen.add(s.name)
    if not specs:
        raise ValueError("a capture session needs at least one event definition")


# --- single operators ------------------------------------------------------------------------

def select_events(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep only the declared event kinds."""
    return df.filter(F.col("Name").isin(list(names)))


def where(df: DataFrame, spec: CaptureSpec) -> DataFrame:
    """Apply one definition's predicate (rows whose field is absent do not match)."""
    p = spec.predicate_column()
    return df if p is None else df.filter(F.coalesce(p, F.lit(False)))


def keep_keys(payload: Column, keep: Sequence[str]) -> Column:
    """Payload restricted to the listed keys (values and JSON nulls unchanged, absent keys
    stay absent).  Only the listed keys are read, so on a stored, shredded table the scan
    reads just those leaves.  A NULL payload stays NULL; a non-object gives ``{}``."""
    if not keep:
        return F.when(payload.isNotNull(), F.parse_json(F.lit("{}")))
    values = [F.try_variant_get(payload, json_path(k), "variant") for k in keep]
    pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in keep]), F.array(*values))
    present = F.map_filter(pairs, lambda k, v: v.isNotNull())   # JSON null is not SQL NULL
    return F.when(payload.isNotNull(), F.to_variant_object(present))


def drop_keys(payload: Column, drop: Sequence[str]) -> Column:
    """Payload without the listed keys; every other key passes."""
    if not drop:
        return payload
    as_map = payload.try_cast("map<string,variant>")   # a non-object payload gives NULL
    unwanted = F.array(*[F.lit(k) for k in drop])
    return F.to_variant_object(F.map_filter(as_map, lambda k, v: ~F.array_contains(unwanted, k)))


def keep_actions(df: DataFrame, actions: Sequence[str]) -> DataFrame:
    """Attach only the listed context columns to ``Actions``."""
    return df.withColumn("Actions", keep_keys(F.col("Actions"), actions))


def optional_fields(df: DataFrame, attributes: Mapping[str, str]) -> DataFrame:
    """C4: ``collect_X = 0`` drops field X; ``1`` and unlisted fields pass."""
    spec = CaptureSpec(name="_", attributes=attributes)
    return df.withColumn("Fields", drop_keys(F.col("Fields"), spec.dropped_fields()))


# The scalars of an event slot; a slot without any of them is empty.
SLOT = ("UUID", "Name", "Timestamp", "XEventStartOffsetInBytes", "XEventEndOffsetInBytes", "XEventSizeInBytes")


def empty_slot() -> Column:
    """None of the six scalars is set (an event that only lacks its UUID is not empty)."""
    cond = F.lit(True)
    for c in SLOT:
        cond = cond & F.col(c).isNull()
    return cond


def drop_null(df: DataFrame) -> DataFrame:
    """Skip event slots without a UUID."""
    return df.filter(F.col("UUID").isNotNull())


# --- the session -----------------------------------------------------------------------------

def session_filter(specs: Sequence[CaptureSpec]) -> Column:
    """OR over every definition of (Name = kind AND predicate)."""
    cond = None
    for s in specs:
        c = F.col("Name") == F.lit(s.name)
        p = s.predicate_column()
        if p is not None:
            c = c & F.coalesce(p, F.lit(False))
        cond = c if cond is None else (cond | c)
    # the plain IN list lets Catalyst push the kind filter into the scan
    return F.col("Name").isin([s.name for s in specs]) & cond


CORRUPT_COLUMN = "_corrupt_record"


def broken() -> Column:
    """Rows that no predicate can judge: a scalar or a payload that the constraints require is
    missing (a payload is NULL after malformed text)."""
    cond = F.lit(False)
    for c in ("UUID", "Name", "Timestamp", "Actions", "Fields"):
        cond = cond | F.col(c).isNull()
    return cond


def capture(df: DataFrame, specs: Sequence[CaptureSpec], keep_broken: bool = False) -> DataFrame:
    """C5 (+C1-C4, C6): one pass over an envelope frame, batch or streaming.

    With ``keep_broken`` (the ingest jobs), rows of a declared kind, or without a kind, that
    break a constraint pass whatever the predicate says, payloads as they are, so that the
    constraint split sends them to the dead letter; only empty slots are skipped.

    A source that keeps unparseable input in ``_corrupt_record`` (JSON landing files)
    has those rows passed through, with the column, so the constraint split sends them
    to the dead letter instead of the kind filter dropping them silently."""
    _check(specs)
    keep = F.col("UUID").isNotNull() & session_filter(specs)
    corrupt = CORRUPT_COLUMN in df.columns
    if keep_broken:
        declared = F.col("Name").isNull() | F.col("Name").isin([s.name for s in specs])
        keep = keep | (broken() & declared & ~empty_slot())
    if corrupt:
        keep = keep | F.col(CORRUPT_COLUMN).isNotNull()
    kept = df.filter(keep)
    actions = None
    fields = None
    for s in specs:
        a = F.col("Actions") if s.actions is None else keep_keys(F.col("Actions"), s.actions)
        f = drop_keys(F.col("Fields"), s.dropped_fields())
        actions = (F.when(F.col("Name") == s.name, a) if actions is None
                   else actions.when(F.col("Name") == s.name, a))
        fields = (F.when(F.col("Name") == s.name, f) if fields is None
                  else fields.when(F.col("Name") == s.name, f))
    if keep_broken:
        actions, fields = actions.otherwise(F.col("Actions")), fields.otherwise(F.col("Fields"))
    cols = [c for c in ENVELOPE_COLUMNS if c not in ("Actions", "Fields")]
    extra = [CORRUPT_COLUMN] if corrupt else []
    return kept.select(*cols, actions.alias("Actions"), fields.alias("Fields"), *extra)


DEFAULT_FIELD_TYPES = {"duration": "bigint"}


def specs_from_config(events: Sequence[Mapping], field_types: Mapping[str, str] | None = None
                      ) -> list[CaptureSpec]:
    """Event definitions in the documented configuration shape -> capture specs.

    Each entry has ``Package``, ``Name``, ``Actions`` (list), ``CustomizableAttributes``
    (list of ``{Name, Value}``) and an optional ``PredicateExpression``.  ``field_types``
    types the predicate's ``[field]`` reads (default: ``duration`` is bigint).  An entry
    without ``Actions`` keeps no context columns, as a definition with an empty action list."""
    types = dict(DEFAULT_FIELD_TYPES if field_types is None else field_types)
    specs = []
    for e in events:
        # The keys of the documented event-definition configuration.
        if "Name" not in e:
            raise ValueError(f"event definition without Name: {dict(e)}")
        attrs = {str(a["Name"]): str(a["Value"]) for a in e.get("CustomizableAttributes") or []}
        specs.append(CaptureSpec(
            name=str(e["Name"]),
            package=str(e.get("Package", "sqlserver")),
            actions=tuple(str(a) for a in e.get("Actions") or ()),
            attributes=attrs,
            predicate=e.get("PredicateExpression"),
            field_types=types))
    _check(specs)
    return specs
