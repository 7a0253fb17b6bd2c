"""Small literal envelopes for operator tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.functions.envelope import ENVELOPE_TEXT
from eventlake.sources.readers import from_text


def text_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (UUID, Name, ISO ts, start, end, size, actions JSON, fields JSON)."""
    return spark.createDataFrame(rows, ENVELOPE_TEXT)


def env_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return from_text(text_rows(spark, rows))


def uuid_of(i: int) -> str:
    return f"{i:08x}-0000-4000-8000-{i:012x}"
