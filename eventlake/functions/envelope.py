"""The fixed eight-column event envelope with its two dynamic payloads.

``Actions`` (context columns) and ``Fields`` (event payload) are ``VARIANT``:
heterogeneous values keyed by name, never declared up front.  At text edges
(JDBC, Kafka, landing files) they travel as JSON strings.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Envelope column names and their order, as stored by every sink.
ENVELOPE_COLUMNS = (
    "UUID",
    "Name",
    "Timestamp",
    "XEventStartOffsetInBytes",
    "XEventEndOffsetInBytes",
    "XEventSizeInBytes",
    "Actions",
    "Fields",
)

ENVELOPE = T.StructType([
    T.StructField("UUID", T.StringType(), True),
    T.StructField("Name", T.StringType(), True),
    T.StructField("Timestamp", T.TimestampType(), True),
    T.StructField("XEventStartOffsetInBytes", T.LongType(), True),
    T.StructField("XEventEndOffsetInBytes", T.LongType(), True),
    T.StructField("XEventSizeInBytes", T.LongType(), True),
    T.StructField("Actions", T.VariantType(), True),
    T.StructField("Fields", T.VariantType(), True),
])

# The text form: payloads as JSON, timestamp as ISO-8601 text with offset.
ENVELOPE_TEXT = T.StructType([
    T.StructField("UUID", T.StringType(), True),
    T.StructField("Name", T.StringType(), True),
    T.StructField("Timestamp", T.StringType(), True),
    T.StructField("XEventStartOffsetInBytes", T.LongType(), True),
    T.StructField("XEventEndOffsetInBytes", T.LongType(), True),
    T.StructField("XEventSizeInBytes", T.LongType(), True),
    T.StructField("Actions", T.StringType(), True),
    T.StructField("Fields", T.StringType(), True),
])

_PLAIN_KEY = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def project(df: DataFrame) -> DataFrame:
    """The eight envelope columns in their fixed order (drops everything else)."""
    return df.select(*ENVELOPE_COLUMNS)


def json_path(key: str) -> str:
    """Variant path for one top-level payload key."""
    if _PLAIN_KEY.match(key):
        return f"$.{key}"
    return "$[" + "'" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"


def field(payload: str | Column, key: str, data_type: str = "string") -> Column:
    """One payload value by key, cast to ``data_type``; NULL when absent or not castable."""
    col = F.col(payload) if isinstance(payload, str) else payload
    return F.try_variant_get(col, json_path(key), data_type)


def field_sql(payload: str, key: str, data_type: str = "string") -> str:
    """SQL text of :func:`field`, for predicates written as SQL expressions."""
    path = json_path(key).replace("'", "\\'")
    return f"try_variant_get({payload}, '{path}', '{data_type}')"


def payload_text(payload: str | Column) -> Column:
    """Payload as canonical JSON text (keys sorted, nulls kept)."""
    col = F.col(payload) if isinstance(payload, str) else payload
    return F.to_json(col)


def to_text(df: DataFrame, iso_pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx") -> DataFrame:
    """The text form of an envelope frame: ISO timestamp, payloads as canonical JSON."""
    return df.select(
        "UUID", "Name", F.date_format("Timestamp", iso_pattern).alias("Timestamp"),
        "XEventStartOffsetInBytes", "XEventEndOffsetInBytes", "XEventSizeInBytes",
        F.to_json("Actions").alias("Actions"), F.to_json("Fields").alias("Fields"))


def conform(df: DataFrame) -> DataFrame:
    """An envelope-shaped frame from elsewhere, made to the envelope's types: a
    ``timestamp_ntz`` or text Timestamp becomes an instant (UTC session; watermarks
    reject NTZ), JSON-text payloads become variants (malformed text -> NULL, caught by
    the constraint split), integral offsets become bigint.  Missing columns are an error."""
    from eventlake.functions.encode import parse_payload   # encode imports this module

    missing = [c for c in ENVELOPE_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"not an event envelope, missing {missing}")
    types = dict(df.dtypes)
    cols = []
    for name, field_type in zip(ENVELOPE.fieldNames(), [f.dataType for f in ENVELOPE.fields]):
        c = F.col(name)
        if name == "Timestamp" and types[name] != "timestamp":
            c = c.try_cast("timestamp")
        elif name in ("Actions", "Fields") and types[name] != "variant":
            c = parse_payload(c.cast("string"))
        elif types[name] != field_type.simpleString():
            c = c.cast(field_type)
        cols.append(c.alias(name))
    return df.select(*cols)
