"""Verification operators (V1-V5)."""

from pyspark.sql import functions as F

from eventlake.operators import verify as V
from eventlake.sources import fixtures as X
from tests.conftest import SF001
from tests.helpers import env_rows, uuid_of


def test_distinct_ignores_key_order(spark):
    env = env_rows(spark, [
        (uuid_of(1), "k", "2024-01-01T00:00:00.000000+00:00", 0, 1, 1, '{"a":1,"b":2}', '{"x":[1,2]}'),
        (uuid_of(1), "k", "2024-01-01T00:00:00.000000+00:00", 0, 1, 1, '{"b":2,"a":1}', '{"x":[1,2]}'),
        (uuid_of(1), "k", "2024-01-01T00:00:00.000000+00:00", 0, 1, 1, '{"b":2,"a":1}', '{"x":[2,1]}'),
    ])
    assert V.distinct_events(env).count() == 2
    hashes = [r[0] for r in env.select(V.event_hash()).collect()]
    assert hashes[0] == hashes[1] != hashes[2]


def test_distinct_on_replays(spark):
    dup = X.env_dup(X.read_table(spark, SF001, "events"))
    assert V.distinct_events(dup).count() == 1000


def test_hash_distinguishes_null_from_text(spark):
    env = env_rows(spark, [
        (None, "k", "2024-01-01T00:00:00.000000+00:00", 0, 1, 1, "{}", "{}"),
        ("\\N", "k", "2024-01-01T00:00:00.000000+00:00", 0, 1, 1, "{}", "{}"),
        ("", "k", "2024-01-01T00:00:00.000000+00:00", 0, 1, 1, "{}", "{}"),
    ])
    hashes = [r[0] for r in env.select(V.event_hash()).collect()]
    assert hashes[0] != hashes[2]


def test_count_gate(spark):
    arrived = spark.createDataFrame([("a",), ("a",), ("b",)], "Name string")
    expected = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "Name string, expected long")
    got = {r.Name: (r.arrived, r.expected, r.ok) for r in V.count_gate(arrived, expected).collect()}
    assert got == {"a": (2, 2, True), "b": (1, 2, False), "c": (0, 1, False)}
    loose = {r.Name: r.ok for r in V.count_gate(arrived, expected, exact=False).collect()}
    assert loose == {"a": True, "b": False, "c": False}


def test_all_match(spark):
    df = spark.createDataFrame([("WAITFOR DELAY '0:00:06'",), ("WAITFOR DELAY '0:00:10'",)], "t string")
    pattern = r"WAITFOR DELAY '0:00:(0?[6-9]|10)'"
    r = V.all_match(df, F.col("t"), pattern).first()
    assert (r.n_rows, r.n_matching, r.all_match) == (2, 2, True)
    df2 = df.union(spark.createDataFrame([(None,), ("SELECT 1",)], "t string"))
    r = V.all_match(df2, F.col("t"), pattern).first()
    assert (r.n_rows, r.n_matching, r.all_match) == (4, 2, False)


def test_sorted_by_key(spark):
    env = X.envelope(spark, SF001)
    ids = [r[0] for r in V.sorted_by_key(env).select("UUID").collect()]
    assert ids == sorted(ids)
