"""Encoders: payload and event JSON, typed value rendering, timestamp forms,
UUID forms, byte sizes and payload parsing (E2-E12, E14).

All of these are built-in column expressions; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions.envelope import ENVELOPE_COLUMNS

# ISO-8601 rendering with microseconds and a numeric offset.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
# 2000-01-01T00:00:00Z in microseconds since 1970 (the binary-copy epoch).
MICROS_1970_TO_2000 = 946_684_800_000_000
# Constant part of an encoded row, in bytes (relational copy, sorted table).
ROW_OVERHEAD_BYTES = {"relational": 84, "sorted": 59}
# Canonical UUID grouping 8-4-4-4-12.
UUID_GROUPS = r"^(.{8})(.{4})(.{4})(.{4})(.{12})$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- E2 / E3 -------------------------------------------------------------------------------

def payload_json(payload: str | Column) -> Column:
    """Dictionary -> JSON object text.  Variant: keys sorted, nulls written.
    A map column is rendered with null values kept as well."""
    return F.to_json(_c(payload), {"ignoreNullFields": "false"})


def event_json(timestamp_pattern: str = ISO_PATTERN) -> Column:
    """The whole event as one JSON document, the eight keys in envelope order.

    ``timestamp_pattern`` is the documented ``DateTimeFormatString`` option.  An
    empty slot (all six scalar columns null) renders as the JSON literal ``null``.
    """
    ts_text = F.date_format(F.col("Timestamp"), timestamp_pattern)
    doc = F.struct(
        F.col("UUID"), F.col("Name"), ts_text.alias("Timestamp"),
        F.col("XEventStartOffsetInBytes"), F.col("XEventEndOffsetInBytes"),
        F.col("XEventSizeInBytes"), F.col("Actions"), F.col("Fields"),
    )
    all_null = None
    for name in ENVELOPE_COLUMNS[:6]:
        cond = F.col(name).isNull()
        all_null = cond if all_null is None else (all_null & cond)
    return F.when(all_null, F.lit("null")).otherwise(F.to_json(doc, {"ignoreNullFields": "false"}))


# --- E4 --------------------------------------------------------------------------------------

def render_value(col: str | Column, data_type: T.DataType) -> Column:
    """A typed column made ready to sit inside a payload.

    Integers, floats, booleans and strings go in as they are; timestamps become
    ISO text with offset; binary becomes base64 text; anything else (decimal,
    interval, ...) falls back to its string form, as the reference does.
    """
    c = _c(col)
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                              T.FloatType, T.DoubleType, T.BooleanType, T.StringType,
                              T.NullType, T.VariantType)):
        return c
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return iso_ts(c)
    if isinstance(data_type, T.BinaryType):
        return b64(c)
    if isinstance(data_type, T.DecimalType) and (data_type.precision, data_type.scale) == (20, 0):
        # unsigned 64-bit integers arrive as decimal(20,0) and stay numbers
        return c
    return c.cast("string")


def payload_from_columns(df_schema: T.StructType, names: list[str] | None = None) -> Column:
    """Build a payload variant from plain columns, each rendered by :func:`render_value`."""
    fields = [f for f in df_schema.fields if names is None or f.name in names]
    parts = []
    for f in fields:
        parts += [F.lit(f.name), render_value(f.name, f.dataType)]
    return F.to_variant_object(F.named_struct(*parts))


# --- E5 - E8: timestamps ---------------------------------------------------------------------

def epoch_seconds(ts: str | Column) -> Column:
    """E5: whole seconds since 1970 (floor).  64-bit, so no wrap after 2106."""
    return F.unix_seconds(_c(ts))


def micros_2000(ts: str | Column) -> Column:
    """Microseconds since 2000-01-01 UTC."""
    return F.unix_micros(_c(ts)) - F.lit(MICROS_1970_TO_2000)


def iso_ts(ts: str | Column, pattern: str = ISO_PATTERN) -> Column:
    """ISO-8601 text with offset (session zone, UTC by convention)."""
    return F.date_format(_c(ts), pattern)


def to_utc(text: str | Column, pattern: str | None = None) -> Column:
    """ISO-8601 text with any offset (``+03:00``, ``Z``, any fraction length) -> instant.
    Bad text gives NULL (dead-letter it).  ``pattern`` forces one exact format."""
    if pattern is None:
        return _c(text).try_cast("timestamp")
    return F.try_to_timestamp(_c(text), F.lit(pattern))


# --- E9 - E12 --------------------------------------------------------------------------------

def uuid_text(u: str | Column) -> Column:
    """Canonical lower-case 8-4-4-4-12 text from dashed, braced, bare or upper-case input."""
    bare = F.lower(F.regexp_replace(_c(u), r"[{}()\-\s]", ""))
    return F.when(bare.rlike("^[0-9a-f]{32}$"),
                  F.regexp_replace(bare, UUID_GROUPS, "$1-$2-$3-$4-$5"))


def uuid_bytes(u: str | Column) -> Column:
    """The 16 bytes in RFC 4122 (big-endian) order."""
    return F.unhex(F.regexp_replace(uuid_text(u), "-", ""))


def utf8_len(s: str | Column) -> Column:
    """Length in UTF-8 bytes, not characters."""
    return F.octet_length(_c(s))


def variable_bytes(name: str | Column = "Name", actions: str | Column = "Actions",
                   fields: str | Column = "Fields") -> Column:
    """E11, the part that varies per event: name + both payloads as UTF-8 JSON bytes."""
    return (F.octet_length(_c(name)).cast("bigint") + F.octet_length(payload_json(actions))
            + F.octet_length(payload_json(fields)))


def row_bytes(layout: str = "relational", name: str | Column = "Name",
              actions: str | Column = "Actions", fields: str | Column = "Fields",
              variable: Column | None = None) -> Column:
    """Encoded size of one event: the layout's constant part + :func:`variable_bytes`
    (pass ``variable`` when it is already computed for another layout)."""
    v = variable if variable is not None else variable_bytes(name, actions, fields)
    return F.lit(ROW_OVERHEAD_BYTES[layout]).cast("bigint") + v


def b64(b: str | Column) -> Column:
    """Binary -> base64 text."""
    return F.base64(_c(b))


# --- E14 -------------------------------------------------------------------------------------

def parse_payload(text: str | Column) -> Column:
    """JSON text -> payload variant.

    SQL NULL and JSON ``null`` become the empty object; malformed text, a
    non-object document and duplicate keys give NULL so that callers can route
    the row to the dead letter instead of silently storing ``{}``.
    """
    t = _c(text)
    parsed = F.try_parse_json(t)
    empty = F.parse_json(F.lit("{}"))
    is_object = t.rlike(r"^\s*\{")
    return (F.when(t.isNull(), empty)
            .when(parsed.isNull(), F.lit(None).cast("variant"))
            .when(F.is_variant_null(parsed), empty)
            .when(is_object, parsed)
            .otherwise(F.lit(None).cast("variant")))


def payload_error(text: str | Column) -> Column:
    """True where :func:`parse_payload` rejects the text."""
    return parse_payload(text).isNull()
