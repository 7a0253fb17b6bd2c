"""K6 against the stored table: the key index and repeatable batch ingest."""

import random

from pyspark.sql import functions as F

from eventlake import folders
from eventlake.operators.capture import CaptureSpec
from eventlake.sinks import ingest as I
from eventlake.sinks.keyindex import KEY, KeyIndex
from tests.helpers import env_rows, uuid_of


def row(i, day, name="click", uuid=None, ts="T00:00:00.000001+00:00", offset=None, fields='{"duration": 6000000}'):
    return (uuid or uuid_of(i), name, None if day is None else f"2024-01-{day:02d}{ts}", i if offset is None else offset, i + 10, 10,
            '{"username": "u"}', fields)


def stored(spark, root):
    rows = I.with_key(spark.read.parquet(root)).select("status", *KEY, "XEventStartOffsetInBytes").collect()
    return sorted((r["status"], r["day"], r["ts"], r["key"], r["XEventStartOffsetInBytes"]) for r in rows)


def test_known_keys_are_exact_over_many_runs(spark, tmp_dir):
    rng = random.Random(1)
    every = [(f"2024-01-{rng.randint(1, 4):02d}", rng.randint(0, 5), f"k{i}") for i in range(3000)] + [("none", -(2 ** 63), "dead:x")]
    index = KeyIndex(spark, f"{tmp_dir}/index")
    assert index.known(spark.createDataFrame(every[:5], KEY)).count() == 0
    have: set = set()
    for size in (1, 700, 40, 900, 3):
        fresh = set(rng.sample(every, size)) - have
        index.add(spark.createDataFrame(sorted(fresh) or [every[0]], KEY) if fresh else spark.createDataFrame([], "day string, ts bigint, key string"))
        have |= fresh
    asked = spark.createDataFrame(every, KEY)
    assert {tuple(r) for r in index.known(asked).collect()} == have
    assert {tuple(r) for r in index.keys().select(*KEY).collect()} == have
    # the filter rules most unknown keys out and no known one
    maybe = {tuple(r) for r in index.maybe_known(asked, None).select(*KEY).collect()}
    assert have <= maybe and len(maybe - have) < 0.25 * (len(set(every)) - len(have))


def test_probe_reads_only_the_days_of_the_batch(spark, tmp_dir):
    index = KeyIndex(spark, f"{tmp_dir}/index")
    index.add(spark.createDataFrame([(f"2024-01-{d:02d}", d, f"k{d}") for d in range(1, 9)], KEY))
    plan = index.keys(["2024-01-03"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-03" in plan
    assert [r["key"] for r in index.known(spark.createDataFrame([("2024-01-03", 3, "k3"), ("2024-01-03", 4, "k4")], KEY)).collect()] == ["k3"]


DELIVERY = [row(1, 1), row(2, 1), row(2, 1, offset=900), row(2, 1), row(3, 2), row(4, None), row(5, 2, fields="not json"),
            row(5, 2, fields="not json"), row(6, 3, name="x" * 300), row(66, 3, name=None), row(7, 31), row(8, 2, uuid="shared")]


def test_a_delivery_is_stored_once_however_often_it_comes(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    df = env_rows(spark, DELIVERY)
    I.ingest(df, None, root)
    once = stored(spark, root)
    assert len(once) == 9 and ("good", "2024-01-01", once[5][2], uuid_of(2), 2) in once
    I.ingest(df, None, root)
    I.ingest(df.repartition(7), None, root)
    assert stored(spark, root) == once
    # the next delivery overlaps: new keys, late ones on old days, a key at another time
    more = [*DELIVERY, row(20, 1), row(21, 2), row(8, 3, uuid="shared"), row(2, 1, ts="T00:00:00.000002+00:00")]
    I.ingest(env_rows(spark, more), None, root)
    assert len(stored(spark, root)) == 13 and set(once) <= set(stored(spark, root))
    assert I.read_status(spark, root).count() == 9
    assert {r["reject_reason"] for r in I.read_status(spark, root, "dead").collect()} == {
        "Timestamp is null or malformed", "Fields malformed", "Name longer than 255", "Name is null"}
    assert "row_key" not in I.read_status(spark, root).columns


def test_rows_without_an_index_are_indexed_first(spark, tmp_dir):
    """A run that was lost between the rows and their index, or a table from before it had one."""
    root = f"{tmp_dir}/table"
    df = env_rows(spark, DELIVERY)
    I.ingest(df, None, root)
    once = stored(spark, root)
    folders.remove(spark, f"{root}/{I.INDEX}/keys/day=2024-01-02")          # lost: one day's keys
    I.ingest(df, None, root)
    assert stored(spark, root) == once
    folders.remove(spark, f"{root}/{I.INDEX}")                              # lost: all of it
    I.ingest(df, None, root)
    assert stored(spark, root) == once
    # the index is whole again: nothing to heal
    index = KeyIndex(spark, f"{root}/{I.INDEX}")
    assert index.heal(I.stored_keys(spark, root), I.stored_keys(spark, root)) == []


def test_ingest_with_specs_keeps_broken_rows_and_nothing_empty(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    specs = [CaptureSpec(name="click", predicate="[duration] >= 5000000", field_types={"duration": "bigint"})]
    rows = [row(1, 1), row(2, 1, fields='{"duration": 1}'), row(3, 1, name="other"), row(4, 1, fields="no")]
    for _ in range(2):
        I.ingest(env_rows(spark, rows), specs, root)
    assert [x[0] for x in stored(spark, root)] == ["dead", "good"]
    empty = f"{tmp_dir}/empty"
    I.ingest(env_rows(spark, []), specs, empty)
    assert not folders.exists(spark, empty)


def test_a_first_delivery_is_not_shuffled_for_its_keys(spark, tmp_dir):
    """Rows whose key stands once and is new are written as they are read (but for the day's rebalance)."""
    df = env_rows(spark, [row(i, 1 + i % 3) for i in range(50)])
    I.ingest(df, None, f"{tmp_dir}/table")
    files = [f for d in (1, 2, 3) for f in folders.children(spark, f"{tmp_dir}/table/status=good/event_date=2024-01-{d:02d}")
             if f.endswith(".parquet")]
    assert len(files) <= 6
    assert I.read_status(spark, f"{tmp_dir}/table").agg(F.count_distinct("UUID")).first()[0] == 50
    I.ingest(df, None, f"{tmp_dir}/table", unique=False)
    assert I.read_status(spark, f"{tmp_dir}/table").count() == 100


def test_a_delivery_with_known_and_repeated_keys_is_evaluated_twice(spark, tmp_dir):
    """Once for its keys and once for its rows, whatever of it is known or comes again."""
    root = f"{tmp_dir}/table"
    I.ingest(env_rows(spark, DELIVERY[:4]), None, root)
    seen = spark.sparkContext.accumulator(0)

    def named(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    more = env_rows(spark, [*DELIVERY, row(20, 1), row(21, 2), row(21, 2)])
    # (variants do not pass Arrow: the ids do)
    ids = more.select("XEventStartOffsetInBytes", F.monotonically_increasing_id().alias("i"), "UUID", "Name", "Timestamp")
    passed = ids.mapInArrow(named, ids.schema).select(
        "UUID", "Name", "Timestamp", "XEventStartOffsetInBytes", F.lit(1).cast("long").alias("XEventEndOffsetInBytes"),
        F.lit(1).cast("long").alias("XEventSizeInBytes"), F.parse_json(F.lit("{}")).alias("Actions"), F.parse_json(F.lit("{}")).alias("Fields"))
    I.ingest(passed, None, root)
    assert seen.value == 2 * more.count()
    got = stored(spark, root)
    assert len(got) == len(set(x[1:4] for x in got)) == 11


def test_few_and_many_keys_are_marked_alike(spark, tmp_dir):
    """A delivery of few keys asks the filter first, one of many meets the keys themselves."""
    index = KeyIndex(spark, f"{tmp_dir}/index")
    have = [(f"2024-01-{1 + i % 3:02d}", i, f"k{i}") for i in range(400)]
    index.add(spark.createDataFrame(have[:300], KEY))
    index.add(spark.createDataFrame(have[300:], KEY))
    asked = [*have[:20], *have[390:], *[(d, t, f"{k}x") for d, t, k in have[:10]], ("2024-02-01", 1, "k1")]
    for keys in (asked, asked + [(d, t, f"{k}y") for d, t, k in have]):
        batch = spark.createDataFrame([(*k, 1 + k[1] % 2) for k in keys], "day string, ts bigint, key string, n bigint")
        got = index.marked(batch).collect()
        assert sorted(tuple(r[c] for c in (*KEY, "n")) for r in got) == sorted((*k, 1 + k[1] % 2) for k in keys)
        assert {tuple(r[c] for c in KEY) for r in got if r["known"]} == set(keys) & set(have)
        assert {r["known"] for r in got} == {True, None}


# --- dead letters come back (T7) ---------------------------------------------------------------------

def restored(dead):
    return dead.withColumn("Name", F.coalesce("Name", F.lit("named"))).withColumn("Name", F.substring("Name", 1, 255))


def test_repaired_dead_letters_are_stored_once_with_their_lineage(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    I.ingest(env_rows(spark, DELIVERY), None, root)
    dead = {r["row_key"]: r["reject_reason"] for r in I.pending_dead(spark, root).collect()}
    assert len(dead) == 4
    assert I.replay_dead(spark, root, restored, run="r1") == {"settled": 2, "pending": 2}
    good = I.with_lineage(spark, root).where("lineage is not null").collect()
    assert {dead[r["lineage"]] for r in good} == {"Name longer than 255", "Name is null"}
    before = stored(spark, root)
    assert I.replay_dead(spark, root, restored) == {"settled": 0, "pending": 2}
    I.ingest(env_rows(spark, DELIVERY), None, root)                       # the delivery again: nothing new
    assert stored(spark, root) == before
    ledger = spark.read.parquet(f"{root}/{I.REPLAYED}").collect()
    assert len(ledger) == 2 and {r["run"] for r in ledger} == {"r1"}
    assert I.read_status(spark, root).columns == [c for c in I.with_lineage(spark, root).columns if c != "lineage"]


def test_a_replay_lost_before_its_ledger_is_made_again(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    I.ingest(env_rows(spark, DELIVERY), None, root)
    I.replay_dead(spark, root, restored)
    before = stored(spark, root)
    folders.remove(spark, f"{root}/{I.REPLAYED}")
    assert I.replay_dead(spark, root, restored) == {"settled": 2, "pending": 2}
    assert stored(spark, root) == before


def test_rows_left_out_or_still_broken_stay_pending(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    I.ingest(env_rows(spark, DELIVERY), None, root)
    assert I.replay_dead(spark, root, lambda dead: dead) == {"settled": 0, "pending": 4}
    assert I.replay_dead(spark, root, lambda dead: dead.limit(0)) == {"settled": 0, "pending": 4}
    # a repair may find that the event is there already: settled, not stored again
    known = lambda dead: dead.where("Timestamp is null").withColumn("Timestamp", F.lit("2024-01-01T00:00:00.000001+00:00").cast("timestamp")).withColumn("UUID", F.lit(uuid_of(1)))
    n = I.read_status(spark, root).count()
    assert I.replay_dead(spark, root, known) == {"settled": 1, "pending": 3}
    assert I.read_status(spark, root).count() == n
