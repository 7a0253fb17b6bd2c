"""Exact percentiles by radix selection against brute force, including a hot group,
negative and extreme values, NULL group keys and weighted input."""

import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from eventlake.operators.quantiles import exact_percentiles, percentile_columns


def _brute(rows, ps):
    grp = defaultdict(list)
    for g, v in rows:
        if v is not None:
            grp[g].append(v)
    out = {}
    for g, vs in grp.items():
        vs.sort()
        for p in ps:
            out[(g, p)] = vs[max(1, math.ceil(p * len(vs))) - 1]
    return out


def test_exact_percentiles_match_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for g in range(6):
        for _ in range(rnd.randint(1, 200)):
            v = rnd.choice([rnd.randint(-10 ** 15, 10 ** 15), rnd.randint(-3, 3), None])
            rows.append((f"g{g}" if g else None, v))
    # a hot group: a third of all rows are copies of one value, plus the extremes
    rows += [("hot", 42)] * 800 + [("hot", -(1 << 63)), ("hot", (1 << 63) - 1), ("hot", 41)]
    ps = [0.0, 0.01, 0.5, 0.95, 0.99, 1.0]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {(r.g, r.percentile): r.value for r in exact_percentiles(df, ["g"], "v", ps).collect()}
    assert got == _brute(rows, ps)


def test_salted_join_same_result(spark):
    rnd = random.Random(3)
    rows = [("hot", 5)] * 600 + [("hot", rnd.randint(0, 10 ** 9)) for _ in range(300)] + \
        [(f"g{i % 7}", rnd.randint(-10 ** 6, 10 ** 6)) for i in range(400)]
    ps = [0.5, 0.9, 0.999]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {(r.g, r.percentile): r.value for r in exact_percentiles(df, ["g"], "v", ps, salt_buckets=8).collect()}
    assert got == _brute(rows, ps)


def test_weighted_and_global(spark):
    df = spark.createDataFrame([(1, 10, 3), (1, 20, 1), (1, 5, 1)], "g int, v bigint, c bigint")
    out = percentile_columns(df, ["g"], "v", [0.5, 0.99], ["p50", "p99"], weight_col="c").first()
    assert (out.p50, out.p99) == (10, 20)          # values 5,10,10,10,20
    glob = {r.percentile: r.value for r in exact_percentiles(df, [], "v", [0.2, 1.0]).collect()}
    assert glob == {0.2: 5, 1.0: 20}


def test_narrow_range_skips_leading_passes(spark):
    df = spark.range(0, 1000).selectExpr("1 AS g", "id AS v")
    out = percentile_columns(df, ["g"], "v", [0.5, 0.99], ["p50", "p99"]).first()
    assert (out.p50, out.p99) == (499, 989)


def test_all_null_gives_no_rows(spark):
    df = spark.createDataFrame([(1, None)], "g int, v bigint")
    assert exact_percentiles(df, ["g"], "v", [0.5]).count() == 0


def test_double_keys_roundtrip_and_order(spark):
    from eventlake.operators.quantiles import double_key, key_double
    vals = [0.0, -0.0, 1.0, -1.0, 0.1, -0.1, 1e-310, -1e-310, 5e-324, 2.2250738585072014e-308,
            1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 3.0, 4.0,
            0.5, 1.5, 1e300, -1e-300, 123456.789]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = df.select("x", double_key(F.col("x")).alias("k")).collect()
    back = {r.k: r.x for r in rows}
    rt = df.select(key_double(double_key(F.col("x"))).alias("y"), "x").collect()
    assert all(r.y == r.x for r in rt)                       # exact round trip (-0.0 == 0.0)
    ordered = sorted(rows, key=lambda r: r.k)
    xs = [r.x for r in ordered]
    assert xs == sorted(xs)
    assert len(back) == len(vals) - 1                        # -0.0 and 0.0 share a key


def test_exact_percentiles_doubles(spark):
    rnd = random.Random(11)
    rows = [("a", rnd.uniform(-1e6, 1e6)) for _ in range(300)] + \
        [("b", rnd.choice([0.1, 0.2, -3.5, 1e-310, float("inf")])) for _ in range(200)] + [("b", None)]
    ps = [0.01, 0.5, 0.99, 1.0]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.percentile): r.value for r in exact_percentiles(df, ["g"], "v", ps).collect()}
    assert got == _brute(rows, ps)


def test_exact_percentiles_decimals(spark):
    from decimal import Decimal
    rnd = random.Random(5)
    rows = [("a", Decimal(rnd.randint(-10 ** 9, 10 ** 9)) / Decimal(1000)) for _ in range(200)]
    ps = [0.25, 0.5, 0.99]
    df = spark.createDataFrame(rows, "g string, v decimal(12,3)")
    got = {(r.g, r.percentile): r.value for r in exact_percentiles(df, ["g"], "v", ps).collect()}
    assert got == _brute(rows, ps)
    assert dict(exact_percentiles(df, ["g"], "v", ps).dtypes)["value"] == "decimal(12,3)"
