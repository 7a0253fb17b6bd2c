"""Streaming (S1, T1-T7): stream equals batch, restart without loss or duplicates,
late rows, dead letters and replay-safe batches."""

import os

import pytest

from pyspark.sql import functions as F

from eventlake.functions.envelope import to_text
from eventlake.operators import capture as C
from eventlake.plans.catalog import STANDARD_SPECS
from eventlake.sinks import writers as K
from eventlake.sources import fixtures as X
from eventlake.sources import readers as S
from eventlake.streaming import runner as T
from tests.conftest import SF001
from tests.helpers import env_rows, uuid_of


def _events(spark):
    return X.read_table(spark, SF001, "events", spread=False)


def _land_parquet(df, landing, name):
    df.coalesce(1).write.mode("overwrite").parquet(f"{landing}/{name}")
    # move the single part file up into the landing folder under a stable name
    sub = f"{landing}/{name}"
    part = next(f for f in os.listdir(sub) if f.endswith(".parquet"))
    os.link(f"{sub}/{part}", f"{landing}/{name}.parquet")


def _good(spark, root):
    return spark.read.parquet(root).drop("batch_id", "event_date")


def test_stream_equals_batch(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    env = X.envelope_from_events(_events(spark))
    _land_parquet(env, landing, "f1")
    src = S.read_event_stream(spark, landing, options={"pathGlobFilter": "*.parquet"})
    q = T.run(src, STANDARD_SPECS, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt", watermark=None)
    T.drain(q)
    got = sorted(tuple(r) for r in to_text(_good(spark, f"{tmp_dir}/good")).collect())
    want = sorted(tuple(r) for r in to_text(C.capture(env, STANDARD_SPECS)).collect())
    assert got == want and len(got) > 0


def test_restart_no_loss_no_duplicates(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    ev = _events(spark)
    env = X.envelope_from_events(ev)
    _land_parquet(X.envelope_from_events(ev.filter("event_id < 500")), landing, "a")
    src = S.read_event_stream(spark, landing, options={"pathGlobFilter": "*.parquet"})
    args = (src, None, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt")
    T.drain(T.run(*args, watermark="31 days"))
    assert _good(spark, f"{tmp_dir}/good").count() == 500
    # second file overlaps the first by 100 events (a replayed delivery)
    _land_parquet(X.envelope_from_events(ev.filter("event_id >= 400")), landing, "b")
    T.drain(T.run(*args, watermark="31 days"))
    good = _good(spark, f"{tmp_dir}/good")
    assert good.count() == 1000
    assert good.select("UUID").distinct().count() == 1000
    assert sorted(tuple(r) for r in to_text(good).collect()) == sorted(tuple(r) for r in to_text(env).collect())


def test_late_rows_dropped_by_watermark(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    ev = _events(spark)
    days = [r[0] for r in ev.select(F.to_date("ts")).distinct().orderBy(1).collect()]
    cut = days[15]
    _land_parquet(X.envelope_from_events(ev.filter(F.to_date("ts") < cut)), landing, "a1")
    _land_parquet(X.envelope_from_events(ev.filter(F.to_date("ts") >= cut)), landing, "a2")
    late = X.envelope_from_events(ev.filter(F.to_date("ts") == days[0]).limit(5)) \
        .withColumn("UUID", F.concat(F.lit("late-"), F.col("UUID")))
    src = S.read_event_stream(spark, landing, options={"pathGlobFilter": "*.parquet", "maxFilesPerTrigger": "1"})
    args = (src, None, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt")
    T.drain(T.run(*args, watermark="30 seconds"))
    assert _good(spark, f"{tmp_dir}/good").count() == 1000
    _land_parquet(late, landing, "z_late")
    T.drain(T.run(*args, watermark="30 seconds"))
    good = _good(spark, f"{tmp_dir}/good")
    assert good.count() == 1000
    assert good.filter(F.col("UUID").startswith("late-")).count() == 0


def test_dead_letters_from_corrupt_text(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    txt = X.env_text(_events(spark)).limit(20)
    lines = [r[0] for r in txt.select(F.to_json(F.struct(*txt.columns))).collect()]
    lines += ["not json", "", '{"UUID":"u1","Name":"k","Timestamp":"2024-01-01T00:00:00.000000+03:00",'
              '"XEventStartOffsetInBytes":1,"XEventEndOffsetInBytes":2,"XEventSizeInBytes":1,'
              '"Actions":"{\\"a\\":1,\\"a\\":2}","Fields":"{}"}']
    with open(f"{landing}/part-0.json", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    src = S.read_event_stream(spark, landing, fmt="json")
    T.drain(T.run(src, None, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt", watermark=None))
    good = _good(spark, f"{tmp_dir}/good")
    dead = spark.read.parquet(f"{tmp_dir}/dead")
    assert good.count() == 20
    reasons = sorted(r.reject_reason for r in dead.collect())
    assert reasons == ["Actions malformed", "corrupt record"]


@pytest.mark.parametrize("watermark", [None, "31 days"])
def test_corrupt_lines_reach_dead_letter_with_specs(spark, tmp_dir, watermark):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    txt = X.env_text(_events(spark))
    lines = [r[0] for r in txt.select(F.to_json(F.struct(*txt.columns))).collect()] + ["not json", "{broken"]
    with open(f"{landing}/part-0.json", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    src = S.read_event_stream(spark, landing, fmt="json")
    T.drain(T.run(src, STANDARD_SPECS, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt",
                  watermark=watermark))
    good = _good(spark, f"{tmp_dir}/good")
    want = C.capture(X.envelope_from_events(_events(spark)), STANDARD_SPECS).count()
    assert good.count() == want
    dead = spark.read.parquet(f"{tmp_dir}/dead")
    assert sorted(r.reject_reason for r in dead.collect()) == ["corrupt record", "corrupt record"]


def test_idempotent_batch_replay(spark, tmp_dir):
    env = X.envelope_from_events(_events(spark)).limit(30)
    fn = T.idempotent_batch(f"{tmp_dir}/out")
    fn(env, 7)
    fn(env, 7)   # replay of the same batch after a failure
    fn(env.limit(10), 8)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 40
    days = [d for d in os.listdir(f"{tmp_dir}/out") if d.startswith("event_date=")]
    assert days and all(b.startswith("batch_id=") for d in days
                        for b in os.listdir(f"{tmp_dir}/out/{d}") if not b.startswith((".", "_")))


def test_dedup_stream_uses_watermark(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    _land_parquet(X.envelope_from_events(_events(spark)), landing, "f1")
    src = S.read_event_stream(spark, landing, options={"pathGlobFilter": "*.parquet"})
    out = K.dedup_key(src, watermark="30 seconds")
    assert out.isStreaming
    plan = out._jdf.queryExecution().logical().toString()
    assert "EventTimeWatermark" in plan and "DeduplicateWithinWatermark" in plan


def test_rate_options():
    assert T.rate_options(max_files=2, max_bytes="10m", max_offsets=100) == {
        "maxFilesPerTrigger": "2", "maxBytesPerTrigger": "10m", "maxOffsetsPerTrigger": "100"}
    assert T.rate_options() == {}
    assert T.rate_options(max_offsets=100000, min_offsets=100000, max_trigger_delay="30s") == {
        "maxOffsetsPerTrigger": "100000", "minOffsetsPerTrigger": "100000", "maxTriggerDelay": "30s"}


def test_streaming_windowed_stats_append(spark, tmp_dir):
    """A2 on a stream: append mode with a watermark emits each closed window once."""
    from eventlake.operators import analytics as A
    landing = f"{tmp_dir}/landing"
    ev = _events(spark)
    _land_parquet(X.envelope_from_events(ev), landing, "f1")
    src = S.read_event_stream(spark, landing, options={"pathGlobFilter": "*.parquet"})
    agg = A.windowed_stats(src.withWatermark("Timestamp", "1 hour"))
    out = f"{tmp_dir}/agg"
    q = (agg.select(F.col("window.start").alias("ws"), "Name", "n_events").writeStream
         .format("parquet").option("path", out).option("checkpointLocation", f"{tmp_dir}/ck")
         .outputMode("append").trigger(availableNow=True).start())
    T.drain(q)
    got = spark.read.parquet(out)
    batch = A.windowed_stats(X.envelope_from_events(ev))
    # every window except those still open at the end of the data is emitted, once
    assert got.count() > 0
    assert got.count() == got.select("ws", "Name").distinct().count()
    assert got.count() <= batch.count()


def test_update_log_across_batches_equals_batch(spark, tmp_dir):
    """Two micro-batches update the same windows; the latest versions equal the batch result."""
    from eventlake.operators import analytics as A
    landing = f"{tmp_dir}/landing"
    ev = _events(spark)
    _land_parquet(X.envelope_from_events(ev.filter("event_id % 2 = 0")), landing, "even")
    _land_parquet(X.envelope_from_events(ev.filter("event_id % 2 = 1")), landing, "odd")
    src = S.read_event_stream(spark, landing, options={"pathGlobFilter": "*.parquet", "maxFilesPerTrigger": "1"})
    agg = A.windowed_stats(src.withWatermark("Timestamp", "31 days"))
    flat = agg.select(F.col("window.start").alias("ws"), "Name", "n_events", "sum_duration", "max_duration")
    q = T.run_aggregate(flat, f"{tmp_dir}/log", f"{tmp_dir}/ck")
    T.drain(q)
    assert spark.read.parquet(f"{tmp_dir}/log").select("batch_id").distinct().count() == 2
    got = sorted(tuple(r) for r in T.latest_versions(spark, f"{tmp_dir}/log", ["ws", "Name"]).collect())
    batch = A.windowed_stats(X.envelope_from_events(ev))
    want = sorted(tuple(r) for r in batch.select(F.col("window.start").alias("ws"), "Name", "n_events",
                                                 "sum_duration", "max_duration").collect())
    assert got == want


def test_keep_late_dedups_against_target(spark, tmp_dir):
    """Late rows are kept and replays dropped when batches dedup against the stored target."""
    landing = f"{tmp_dir}/landing"
    ev = _events(spark)
    days = [r[0] for r in ev.select(F.to_date("ts")).distinct().orderBy(1).collect()]
    cut = days[15]
    _land_parquet(X.envelope_from_events(ev.filter(F.to_date("ts") >= cut)), landing, "a1")
    src = S.read_event_stream(spark, landing, options={"pathGlobFilter": "*.parquet", "maxFilesPerTrigger": "1"})
    args = (src, None, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt")
    T.drain(T.run(*args, watermark=None, keep_late=True))
    n_new = ev.filter(F.to_date("ts") >= cut).count()
    assert _good(spark, f"{tmp_dir}/good").count() == n_new
    # late: the older half, plus a replay of 50 rows already stored
    old = ev.filter(F.to_date("ts") < cut)
    replay = ev.filter(F.to_date("ts") >= cut).orderBy("event_id").limit(50)
    _land_parquet(X.envelope_from_events(old.unionByName(replay)), landing, "b1")
    T.drain(T.run(*args, watermark=None, keep_late=True))
    good = _good(spark, f"{tmp_dir}/good")
    assert good.count() == 1000
    assert good.select("UUID").distinct().count() == 1000
    # replaying a stored batch id rewrites the same rows, it does not drop them
    fn = T.with_dead_letter(f"{tmp_dir}/good", f"{tmp_dir}/dead", keep_late=True)
    last = spark.read.parquet(f"{tmp_dir}/good").agg(F.max("batch_id")).first()[0]
    spark.read.parquet(f"{tmp_dir}/good").filter(F.col("batch_id") == last) \
        .drop("event_date", "batch_id").write.parquet(f"{tmp_dir}/replay")
    again = spark.read.parquet(f"{tmp_dir}/replay")
    fn(again, last)
    assert _good(spark, f"{tmp_dir}/good").count() == 1000


def test_compact_day_is_idempotent(spark, tmp_dir):
    env = X.envelope_from_events(_events(spark))
    fn = T.idempotent_batch(f"{tmp_dir}/good")
    fn(env.filter("XEventStartOffsetInBytes % 2048 = 0"), 0)       # even events in batch 0
    fn(env.filter("XEventStartOffsetInBytes % 2048 <> 0"), 1)      # odd events in batch 1
    fn(env.limit(10), 2)                                            # a replayed delivery
    day = "2024-01-05"
    T.compact_day(spark, f"{tmp_dir}/good", f"{tmp_dir}/table", day)
    T.compact_day(spark, f"{tmp_dir}/good", f"{tmp_dir}/table", day)   # rerun: same result
    T.compact_day(spark, f"{tmp_dir}/good", f"{tmp_dir}/table", "2024-01-06")
    table = spark.read.parquet(f"{tmp_dir}/table")
    want5 = env.filter(F.to_date("Timestamp") == day).count()
    assert table.filter(F.col("event_date") == day).count() == want5
    assert table.filter(F.col("event_date") == "2024-01-06").count() == \
        env.filter(F.to_date("Timestamp") == "2024-01-06").count()
    days = sorted(d for d in os.listdir(f"{tmp_dir}/table") if d.startswith("event_date="))
    assert days == ["event_date=2024-01-05", "event_date=2024-01-06"]
    # retention: only a verified, compacted day is removed from the per-batch folders
    assert not T.retire_day(spark, f"{tmp_dir}/good", f"{tmp_dir}/table", "2024-01-07")   # not compacted
    assert T.retire_day(spark, f"{tmp_dir}/good", f"{tmp_dir}/table", day)
    assert not os.path.exists(f"{tmp_dir}/good/event_date={day}")
    assert os.path.exists(f"{tmp_dir}/good/event_date=2024-01-07")
    assert spark.read.parquet(f"{tmp_dir}/table").filter(F.col("event_date") == day).count() == want5


def test_continuous_run_picks_up_new_files(spark, tmp_dir):
    """A long-running query on a processing-time trigger takes files as they land."""
    landing = f"{tmp_dir}/landing"
    ev = _events(spark)
    _land_parquet(X.envelope_from_events(ev.filter("event_id < 300")), landing, "a")
    src = S.read_event_stream(spark, landing, options={"pathGlobFilter": "*.parquet"})
    q = T.run(src, None, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt",
              watermark="31 days", available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        assert _good(spark, f"{tmp_dir}/good").count() == 300
        _land_parquet(X.envelope_from_events(ev.filter("event_id >= 250")), landing, "b")
        q.processAllAvailable()
        good = _good(spark, f"{tmp_dir}/good")
        assert good.count() == 1000 and good.select("UUID").distinct().count() == 1000
    finally:
        q.stop()
    assert q.exception() is None


def test_state_partitions_fixed_and_session_restored(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    _land_parquet(X.envelope_from_events(_events(spark)), landing, "f1")
    src = S.read_event_stream(spark, landing, options={"pathGlobFilter": "*.parquet"})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = T.run(src, None, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt",
              watermark="31 days", state_partitions=3)
    T.drain(q)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    operator_state = f"{tmp_dir}/ckpt/state/0"          # state/<operator>/<partition>
    assert sorted(p for p in os.listdir(operator_state) if p.isdigit()) == ["0", "1", "2"]
    assert _good(spark, f"{tmp_dir}/good").count() == 1000


def test_aggregate_log_keeps_queries_apart(spark, tmp_dir):
    """A second checkpoint on one log overwrites nothing; a query that began anew on the same input has its groups,
    queries over different inputs are merged."""
    from eventlake.operators import analytics as A
    ev = _events(spark)
    for half in (0, 1):
        _land_parquet(X.envelope_from_events(ev.filter(F.col("event_id") % 2 == half)), f"{tmp_dir}/{half}", "part")

    def go(half, checkpoint, log):
        src = S.read_event_stream(spark, f"{tmp_dir}/{half}", options={"pathGlobFilter": "*.parquet"})
        agg = A.windowed_stats(src).select(F.col("window.start").alias("ws"), "Name", "n_events", "sum_duration", "max_duration")
        T.drain(T.run_aggregate(agg, f"{tmp_dir}/{log}", f"{tmp_dir}/{checkpoint}"))

    go(0, "c0", "log")
    go(1, "c1", "log")
    merged = T.latest_versions(spark, f"{tmp_dir}/log", ["ws", "Name"], {"n_events": "sum", "sum_duration": "sum", "max_duration": "max"})
    want = A.windowed_stats(X.envelope_from_events(ev)).select(F.col("window.start").alias("ws"), "Name", "n_events", "sum_duration", "max_duration")
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, want.collect()))
    # the same input again under a new checkpoint: the newest query's versions stand once
    go(0, "c2", "again")
    go(0, "c3", "again")
    newest = T.latest_versions(spark, f"{tmp_dir}/again", ["ws", "Name"])
    half = A.windowed_stats(X.envelope_from_events(ev.filter("event_id % 2 = 0"))).select(F.col("window.start").alias("ws"), "Name", "n_events", "sum_duration", "max_duration")
    assert sorted(map(tuple, newest.collect())) == sorted(map(tuple, half.collect()))
    with pytest.raises(ValueError):
        T.latest_versions(spark, f"{tmp_dir}/log", ["ws", "Name"], {"n_events": "sum"})


def test_a_batch_of_one_split_is_dealt_over_tasks_by_size(spark, tmp_dir):
    from contextlib import ExitStack

    from eventlake.session import sql_conf
    rows = env_rows(spark, [(uuid_of(i), "click", "2024-01-01T00:00:00.000000+00:00", i, i, 1, "{}", "{}")
                            for i in range(4000)]).coalesce(1)
    rows.write.parquet(f"{tmp_dir}/in")
    seen = []

    def write(batch, root, key):
        seen.append((batch.rdd.getNumPartitions(), batch.count()))

    with ExitStack() as settings:
        for key, value in (("advisoryPartitionSizeInBytes", "16k"), ("coalescePartitions.minPartitionSize", "1k")):
            settings.enter_context(sql_conf(spark, f"spark.sql.adaptive.{key}", value))
        T.with_dead_letter(f"{tmp_dir}/good", f"{tmp_dir}/dead", write)(spark.read.parquet(f"{tmp_dir}/in"), 0)
    assert seen[0][0] > 1 and seen[0][1] == 4000
