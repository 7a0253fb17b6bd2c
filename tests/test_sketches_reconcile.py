"""A9's stored sketches within their stated rank error; V3's lookup tables name every lost and extra row."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventlake.operators import reconcile as R
from eventlake.operators import sketches as Q
from eventlake.sources.readers import read_event_stream
from eventlake.streaming import runner as T
from tests.helpers import env_rows, uuid_of


# --- sketches ------------------------------------------------------------------------------------

def big_env(spark, rows, days=3):
    """Envelope rows with skewed durations: most in one database, many ties, some without a duration."""
    return spark.range(rows).repartition(8).selectExpr(
        "lower(hex(id)) AS UUID", "'click' AS Name", f"timestamp_seconds(1704067200 + (id % {days}) * 86400) AS Timestamp",
        "id AS XEventStartOffsetInBytes", "id AS XEventEndOffsetInBytes", "1L AS XEventSizeInBytes",
        "to_variant_object(named_struct('database_name', if(id % 10 < 9, 'hot', 'cold'))) AS Actions",
        "to_variant_object(named_struct('duration', if(id % 50 = 0, null, cast(exp(20.0 * (hash(id) % 1000003) / 1000003) AS bigint)))) AS Fields")


def test_percentiles_of_a_million_rows_are_within_the_stated_error(spark, tmp_dir):
    env = big_env(spark, 1_300_000)
    Q.capacity_sketches(env).write.partitionBy("day").parquet(f"{tmp_dir}/daily")
    daily = spark.read.parquet(f"{tmp_dir}/daily")
    assert daily.count() == 6
    for keys in (["database_name"], ["day", "database_name"]):
        found = Q.with_percentiles(Q.rollup(daily, keys))
        rows = Q.rank_errors(env, found, keys).collect()
        assert len(rows) == 2 * (1 if keys == ["database_name"] else 3)
        for r in rows:
            assert all(0 <= r[f"p{p}_error"] <= Q.rank_error() for p in (50, 95, 99)), r
    hot = next(r for r in Q.rollup(daily, ["database_name"]).collect() if r["database_name"] == "hot")
    assert hot["n_events"] == 1_170_000 and hot["n_durations"] == 1_144_000 < hot["n_events"]
    assert Q.rank_error() < 0.005 and Q.rank_error(200) > Q.rank_error(400)


def test_rank_errors_are_exact(spark):
    rows = [(uuid_of(i), "k", "2024-01-01T00:00:00+00:00", i, i, 1, '{"database_name":"d"}', f'{{"duration":{d}}}')
            for i, d in enumerate([1, 2, 2, 2, 3, 4, 5, 6, 7, 8])]
    env = env_rows(spark, rows)
    base = [("d", 10, 10, 40, 0)]
    for values, want in (((2, 8, 8), (0.1, 0, 0)), ((3, 7, 1), (0.0, 0.1, 0.9)), ((4, 100, 0), (0.1, 0.1, 1.0))):
        found = spark.createDataFrame([(*base[0], *values)], "database_name string, n_events long, n_durations long, sum_duration long, "
                                                             "total_bytes long, p50 long, p95 long, p99 long")
        got = Q.rank_errors(env, found, ["database_name"]).first()
        assert [round(got[f"p{p}_error"], 9) for p in (50, 95, 99)] == [round(w, 9) for w in want]


def test_sketches_of_a_stream_merge_with_those_of_a_batch(spark, tmp_dir):
    env = big_env(spark, 60_000)
    env.where("XEventStartOffsetInBytes < 40000").repartition(4).write.parquet(f"{tmp_dir}/in")
    src = read_event_stream(spark, f"{tmp_dir}/in", options={"maxFilesPerTrigger": "1"})
    write = Q.sketches_by_batch()
    for _ in range(2):                                                   # a replay replaces its batch
        T.drain(src.writeStream.foreachBatch(lambda b, i: [write(b, f"{tmp_dir}/out", i) for _ in range(2)] and None)
                .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    streamed = spark.read.parquet(f"{tmp_dir}/out").drop("batch_id")
    assert streamed.count() > 6
    both = streamed.unionByName(Q.capacity_sketches(env.where("XEventStartOffsetInBytes >= 40000")))
    found = Q.with_percentiles(Q.rollup(both, ["day"]))
    assert {r["n_events"] for r in found.collect()} == {20_000}
    for r in Q.rank_errors(env, found, ["day"]).collect():
        assert all(r[f"p{p}_error"] <= Q.rank_error() for p in (50, 95, 99)), r


def test_groups_without_durations_and_no_events(spark):
    rows = [(uuid_of(1), "k", None, 1, 1, 1, "{}", "{}"), (uuid_of(2), "k", None, 1, 1, 1, "{}", '{"duration":"n/a"}')]
    env = env_rows(spark, rows)
    found = Q.with_percentiles(Q.rollup(Q.capacity_sketches(env), ["day", "database_name"]))
    assert [tuple(r) for r in found.collect()] == [(None, None, 2, 0, None, 2 * (84 + 1) + 3 * 2 + 18, None, None, None)]
    assert Q.rank_errors(env, found, ["day", "database_name"]).first()["p50_error"] is None
    assert Q.rollup(Q.capacity_sketches(env_rows(spark, [])), ["day"]).count() == 0


# --- lookup tables -------------------------------------------------------------------------------

def event(i, hour=0, name="click", uuid=None):
    return (uuid_of(i) if uuid is None else uuid, name, f"2024-01-01T{hour:02d}:00:{i % 60:02d}.{i % 1000000:06d}+00:00", i, i, 1, "{}", "{}")


def compare(spark, a, b, **how):
    rows = R.reconcile(env_rows(spark, a), env_rows(spark, b), **how).collect()
    return sorted((r["Name"] or "", r["UUID"] or "", r["side"], r["copies"]) for r in rows)


def brute(a, b):
    left, right = (Counter((r[1], r[0], r[2]) for r in x) for x in (a, b))
    return sorted([(k[0] or "", k[1] or "", "lost", n) for k, n in (left - right).items()]
                  + [(k[0] or "", k[1] or "", "extra", n) for k, n in (right - left).items()])


@pytest.mark.parametrize("seed, losses", [(1, 0), (2, 3), (3, 60), (4, 500)])
def test_every_loss_and_extra_is_named(spark, seed, losses):
    """Few differences are peeled; more than an hour's cells can name are compared exactly."""
    rng = random.Random(seed)
    a = [event(i, rng.randint(0, 3), rng.choice(["click", "error"])) for i in range(1500)]
    b = [r for r in a if r not in rng.sample(a, losses)] + [event(5000 + i, rng.randint(0, 3)) for i in range(losses // 2)]
    b += rng.sample(b, losses // 5)                                            # stored twice
    rng.shuffle(b)
    assert compare(spark, a, b, cells=30) == brute(a, b)


def test_few_differences_need_no_second_look_at_the_rows(spark):
    a = [event(i, i % 4) for i in range(2000)]
    b = [r for r in a if int(r[3]) % 400 != 7]
    named, stuck = R.decode(R.subtract(R.table_of(env_rows(spark, a)), R.table_of(env_rows(spark, b))))
    assert stuck.count() == 0 and named.count() == 5 and {r["n"] for r in named.collect()} == {1}
    assert R.table_of(env_rows(spark, a)).count() <= 4 * R.CELLS               # whatever the number of rows


def test_copies_null_keys_and_ids_that_are_no_uuids(spark):
    a = [event(1), event(2), event(2), event(3), event(3, uuid="not a uuid"), (None, "click", None, 1, 1, 1, "{}", "{}"),
         event(4, name=None), (uuid_of(9), "click", None, 1, 1, 1, "{}", "{}"), event(7, uuid="ABCDEF00-0000-4000-8000-000000000000")]
    b = [event(1), event(1), event(1), event(1), event(2), event(3, uuid="other"), event(4, name=None), event(4, name=None)]
    assert compare(spark, a, b) == brute(a, b)
    assert compare(spark, a, []) == brute(a, []) and compare(spark, [], []) == []


def test_stored_tables_stand_for_their_sides(spark, tmp_dir):
    a, b = [event(i, i % 3) for i in range(300)], [event(i, i % 3) for i in range(300) if i not in (5, 250)]
    for name, rows in (("a", a), ("b", b)):
        R.table_of(env_rows(spark, rows)).write.parquet(f"{tmp_dir}/{name}")
    got = compare(spark, a, b, source_table=spark.read.parquet(f"{tmp_dir}/a"), sink_table=spark.read.parquet(f"{tmp_dir}/b"))
    assert got == brute(a, b)
    assert R.table_of(env_rows(spark, a)).agg(F.sum("n")).first()[0] == 3 * 300
