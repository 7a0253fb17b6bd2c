"""Encoders (E2-E14), with one row per line of the payload type switch."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.functions import encode as E
from tests.helpers import env_rows, uuid_of

TYPED = T.StructType([
    T.StructField("v_null", T.StringType()),
    T.StructField("v_byte", T.ShortType()),            # .NET byte 255 is unsigned: a short here
    T.StructField("v_sbyte", T.ByteType()),
    T.StructField("v_short", T.ShortType()),
    T.StructField("v_int", T.IntegerType()),
    T.StructField("v_long_min", T.LongType()),
    T.StructField("v_long_max", T.LongType()),
    T.StructField("v_ushort", T.IntegerType()),
    T.StructField("v_uint", T.LongType()),
    T.StructField("v_ulong", T.DecimalType(20, 0)),
    T.StructField("v_float", T.FloatType()),
    T.StructField("v_double", T.DoubleType()),
    T.StructField("v_string", T.StringType()),
    T.StructField("v_ts", T.TimestampType()),
    T.StructField("v_guid", T.StringType()),
    T.StructField("v_true", T.BooleanType()),
    T.StructField("v_false", T.BooleanType()),
    T.StructField("v_bytes", T.BinaryType()),
    T.StructField("v_decimal", T.DecimalType(10, 3)),
])

ROW = (None, 255, -128, -32768, 2147483647, -9223372036854775808, 9223372036854775807, 65535,
       4294967295, Decimal("18446744073709551615"), 1.5, 0.1, 'a "quoted"\nline ü',
       dt.datetime(2024, 1, 2, 3, 4, 5, 123456, tzinfo=dt.timezone.utc),
       "9f0b6b1e-3c1a-4c55-9a43-0e6f8b5b2d10", True, False, bytes([1, 2]), Decimal("1.100"))


def test_type_switch_rendering(spark):
    df = spark.createDataFrame([ROW], TYPED)
    text = df.select(F.to_json(E.payload_from_columns(df.schema))).first()[0]
    got = json.loads(text)
    assert text.startswith('{"v_bool"') is False
    assert got["v_null"] is None and '"v_null":null' in text
    assert got["v_byte"] == 255 and got["v_sbyte"] == -128 and got["v_short"] == -32768
    assert got["v_int"] == 2147483647
    assert got["v_long_min"] == -9223372036854775808 and got["v_long_max"] == 9223372036854775807
    assert got["v_ushort"] == 65535 and got["v_uint"] == 4294967295
    assert '"v_ulong":18446744073709551615' in text
    assert got["v_float"] == 1.5 and got["v_double"] == 0.1
    assert got["v_string"] == 'a "quoted"\nline ü'
    assert got["v_ts"] == "2024-01-02T03:04:05.123456+00:00"
    assert got["v_guid"] == "9f0b6b1e-3c1a-4c55-9a43-0e6f8b5b2d10"
    assert got["v_true"] is True and got["v_false"] is False
    assert got["v_bytes"] == "AQI="
    assert got["v_decimal"] == "1.100"          # fallback: string form, trailing zeros kept
    assert list(got) == sorted(got)             # canonical: keys sorted


def test_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 999999, tzinfo=dt.timezone.utc),)],
                               "Timestamp timestamp")
    r = df.select(E.epoch_seconds("Timestamp").alias("s"), E.micros_2000("Timestamp").alias("m"),
                  E.iso_ts("Timestamp").alias("iso")).first()
    assert r.s == 1704164645                                      # floor, not round
    assert r.m == 1704164645999999 - 946684800000000
    assert r.iso == "2024-01-02T03:04:05.999999+00:00"
    far = spark.createDataFrame([(dt.datetime(2200, 1, 1, tzinfo=dt.timezone.utc),)], "t timestamp")
    assert far.select(E.epoch_seconds("t")).first()[0] == 7258118400   # beyond 2106: no wrap


def test_to_utc(spark):
    df = spark.createDataFrame([("2024-01-02T06:04:05.123456+03:00",), ("2024-01-01T23:00:00.000000-05:00",),
                                ("not a time",), (None,), ("2024-01-02T03:04:05Z",),
                                ("2024-01-02T03:04:05.5+00:00",)], "t string")
    out = [r[0] for r in df.select(F.unix_micros(E.to_utc("t"))).collect()]
    assert out[0] == 1704164645123456
    assert out[1] == 1704168000000000
    assert out[2] is None and out[3] is None
    assert out[4] == 1704164645000000 and out[5] == 1704164645500000
    strict = [r[0] for r in df.select(E.to_utc("t", E.ISO_PATTERN)).collect()]
    assert strict[0] is not None and strict[4] is None


def test_uuid_forms(spark):
    u = "9f0b6b1e-3c1a-4c55-9a43-0e6f8b5b2d10"
    df = spark.createDataFrame([("{" + u.upper() + "}",), (u.replace("-", ""),), (u,), ("xyz",),
                                ("z" * 32,)], "u string")
    out = [r[0] for r in df.select(E.uuid_text("u")).collect()]
    assert out == [u, u, u, None, None]
    hexed = df.select(F.hex(E.uuid_bytes("u"))).first()[0]
    assert hexed == u.replace("-", "").upper()


def test_byte_lengths_and_row_size(spark):
    env = env_rows(spark, [(uuid_of(1), "ünï", "2024-01-01T00:00:00.000000+00:00", 0, 0, 0,
                            '{"a":1}', '{"b":"é"}')])
    r = env.select(E.utf8_len("Name").alias("n"), E.row_bytes("relational").alias("pg"),
                   E.row_bytes("sorted").alias("ch")).first()
    assert r.n == len("ünï".encode()) == 5
    assert r.pg == 84 + 5 + len('{"a":1}') + len('{"b":"é"}'.encode())
    assert r.ch == r.pg - 84 + 59


def test_base64(spark):
    df = spark.createDataFrame([(bytes([1, 2]),)], "b binary")
    assert df.select(E.b64("b")).first()[0] == "AQI="


def test_parse_payload(spark):
    df = spark.createDataFrame([('{"b":1,"a":[1,2]}',), ("null",), (None,), ("not json",),
                                ('{"a":1,"a":2}',), ("[1,2]",), ("  {}",), ("\n\t{\"x\": 1}",)], "t string")
    out = df.select(F.to_json(E.parse_payload("t")).alias("j"), E.payload_error("t").alias("e")).collect()
    assert [r.j for r in out] == ['{"a":[1,2],"b":1}', "{}", "{}", None, None, None, "{}", '{"x":1}']
    assert [r.e for r in out] == [False, False, False, True, True, True, False, False]


def test_event_json_order_and_null_event(spark):
    env = env_rows(spark, [(uuid_of(1), "k", "2024-01-01T00:00:00.000001+00:00", 1, 2, 1,
                            '{"b":2,"a":1}', '{"x":null}'),
                           (None, None, None, None, None, None, None, None)])
    out = env.select(E.event_json().alias("j")).collect()
    doc = json.loads(out[0].j)
    assert list(doc) == ["UUID", "Name", "Timestamp", "XEventStartOffsetInBytes",
                         "XEventEndOffsetInBytes", "XEventSizeInBytes", "Actions", "Fields"]
    assert doc["Timestamp"] == "2024-01-01T00:00:00.000001+00:00"
    assert doc["Actions"] == {"a": 1, "b": 2} and doc["Fields"] == {"x": None}
    assert out[1].j == "null"


def test_payload_json_of_map_keeps_nulls(spark):
    df = spark.createDataFrame([Row(m={"a": None, "b": "1"})], "m map<string,string>")
    assert json.loads(df.select(E.payload_json("m")).first()[0]) == {"a": None, "b": "1"}


def test_conform_foreign_envelope(spark):
    import pytest
    from eventlake.functions.envelope import conform
    df = spark.createDataFrame(
        [("u1", "k", dt.datetime(2024, 1, 2, 3, 4, 5), 1, 2, 1, '{"a":1}', "not json")],
        "UUID string, Name string, Timestamp timestamp_ntz, XEventStartOffsetInBytes int, "
        "XEventEndOffsetInBytes int, XEventSizeInBytes int, Actions string, Fields string")
    out = conform(df)
    assert [t for _, t in out.dtypes] == ["string", "string", "timestamp", "bigint", "bigint", "bigint",
                                          "variant", "variant"]
    r = out.select(F.unix_micros("Timestamp"), F.to_json("Actions"), "Fields").first()
    assert r[0] == 1704164645000000 and r[1] == '{"a":1}' and r[2] is None
    with pytest.raises(ValueError):
        conform(df.drop("Fields"))
