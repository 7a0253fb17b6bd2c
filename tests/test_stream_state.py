"""Keyed stream state: deduplication without a read of the target (T6), alerts that fire once (A3)."""

import random

import pandas as pd
from pyspark.sql import functions as F

from eventlake.sources.readers import read_event_stream
from eventlake.streaming import runner as T
from eventlake.streaming import state as S
from tests.helpers import env_rows, uuid_of


def at(minutes):
    return f"2024-01-{1 + minutes // 1440:02d}T{minutes // 60 % 24:02d}:{minutes % 60:02d}:00.000000+00:00"


def row(i, minutes, name="click", offset=None, duration=6_000_000):
    return (uuid_of(i), name, at(minutes) if minutes is not None else None, i if offset is None else offset, i, 1, "{}", f'{{"duration":{duration}}}')


def land(spark, folder, files):
    """Each list of rows as one file, in the order that the stream takes them."""
    for k, rows in enumerate(files):
        env_rows(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/{k:03d}")


def source(spark, folder):
    return read_event_stream(spark, folder, options={"recursiveFileLookup": "true", "maxFilesPerTrigger": "1"})


def run(spark, tmp_dir, horizon, **how):
    T.drain(S.run_state_dedup(source(spark, f"{tmp_dir}/in"), None, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt",
                              horizon=horizon, buckets=2, state_partitions=2, **how))


def stored(spark, tmp_dir, what="good"):
    return sorted((r["UUID"] or "", r["XEventStartOffsetInBytes"]) for r in spark.read.parquet(f"{tmp_dir}/{what}").collect())


def test_unordered_files_and_replays_are_stored_once(spark, tmp_dir):
    rng = random.Random(2)
    rows = [row(i, rng.randrange(5000)) for i in range(200)]
    again = [(*r[:3], r[3] + 10_000, *r[4:]) for r in rng.sample(rows, 60)]
    mixed = rows[:100] + again[:30]
    rng.shuffle(mixed)
    files = [mixed[:50], mixed[50:], rows[100:] + [again[0]]]
    land(spark, f"{tmp_dir}/in", files)
    run(spark, tmp_dir, "30 days")
    got = stored(spark, tmp_dir)
    assert [u for u, _ in got] == sorted(r[0] for r in rows)
    # a restart goes on with the state: the late replays of the first run's keys find them there
    land(spark, f"{tmp_dir}/in", [[], [], [], again + [row(900, 10)]])
    run(spark, tmp_dir, "30 days")
    assert stored(spark, tmp_dir) == sorted([*got, (uuid_of(900), 900)])
    assert spark.read.parquet(f"{tmp_dir}/dead").count() == 0


def test_rows_behind_the_horizon_are_dead_letters(spark, tmp_dir):
    files = [[row(1, 0), row(2, 30)], [row(3, 600)], [row(1, 0, offset=77), row(4, 10), row(5, 590)], [row(5, 590, offset=78)]]
    land(spark, f"{tmp_dir}/in", files)
    run(spark, tmp_dir, "2 hours", sweep_ms=0)
    assert [u for u, _ in stored(spark, tmp_dir)] == sorted(uuid_of(i) for i in (1, 2, 3, 5))
    dead = {(r["UUID"], r["XEventStartOffsetInBytes"]): r["reject_reason"] for r in spark.read.parquet(f"{tmp_dir}/dead").collect()}
    # the replay of 1 and the late 4 cannot be told apart any more; the replay of 5 can
    assert dead == {(uuid_of(1), 77): S.LATE, (uuid_of(4), 4): S.LATE}


def test_past_hours_leave_the_state(spark, tmp_dir):
    land(spark, f"{tmp_dir}/in", [[row(100 * k + i, 600 * k + i) for i in range(20)] for k in range(6)])
    q = S.run_state_dedup(source(spark, f"{tmp_dir}/in"), None, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt",
                          horizon="1 hour", buckets=1, state_partitions=1, sweep_ms=0)
    T.drain(q)
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert stored(spark, tmp_dir) and max(rows) <= 3 and len(rows) == 6


def test_broken_rows_go_to_the_dead_letter_once(spark, tmp_dir):
    broken = [row(1, None), row(1, None), row(2, 5, name="x" * 300), row(2, 6, name=None)]
    land(spark, f"{tmp_dir}/in", [broken + [row(3, 5)], broken])
    run(spark, tmp_dir, "1 day")
    assert stored(spark, tmp_dir) == [(uuid_of(3), 3)]
    assert sorted(r["reject_reason"] for r in spark.read.parquet(f"{tmp_dir}/dead").collect()) == [
        "Name is null", "Name longer than 255", "Timestamp is null or malformed"]


def test_no_batch_reads_the_target(spark, tmp_dir):
    land(spark, f"{tmp_dir}/in", [[row(1, 1)], [row(1, 1, offset=5), row(2, 2)]])
    seen = []

    def write(batch, root, key):
        seen.append(sorted(r["UUID"] for r in batch.collect()))

    run(spark, tmp_dir, "1 day", write_good=write)
    assert sorted(u for b in seen for u in b) == [uuid_of(1), uuid_of(2)]


# --- alerts --------------------------------------------------------------------------------------

def alert_run(spark, tmp_dir, min_slow=2):
    changes = S.alert_transitions(source(spark, f"{tmp_dir}/in"), min_slow=min_slow, delay="10 minutes")
    T.drain(S.run_alerts(changes, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", state_partitions=2))
    rows = spark.read.schema(changes.schema).parquet(f"{tmp_dir}/out").collect()
    first = 1_704_067_200_000
    return sorted((r["Name"], (r["window_ms"] - first) // S.HOUR_MS, r["state"], r["n_slow"]) for r in rows)


def test_an_alert_fires_on_crossing_and_clears_on_recovery(spark, tmp_dir):
    def hour(h, n, name="click", fast=0):
        return ([row(1000 * h + i, 60 * h + i, name) for i in range(n)]
                + [row(1000 * h + 500 + i, 60 * h + 30 + i, name, duration=1) for i in range(fast)])

    land(spark, f"{tmp_dir}/in", [
        hour(0, 2) + hour(0, 1, "error"),                        # click crosses
        hour(1, 3) + hour(2, 2),                                 # still high: nothing new
        hour(3, 1, fast=2),                                      # below: cleared
        hour(4, 5), hour(6, 2) + hour(7, 0, fast=1),             # high, no event at 5, high again, below
        hour(8, 4), hour(11, 0, "error", fast=1)])               # high, then silence: a timer clears it
    want = [("click", 0, "raised", 2), ("click", 3, "cleared", 1), ("click", 4, "raised", 5), ("click", 5, "cleared", 0),
            ("click", 6, "raised", 2), ("click", 7, "cleared", 0), ("click", 8, "raised", 4), ("click", 9, "cleared", 0)]
    assert alert_run(spark, tmp_dir) == want
    # a restart goes on: the open window is judged when later events come, nothing is said twice
    land(spark, f"{tmp_dir}/in", [[]] * 7 + [hour(12, 2, "error"), hour(13, 2, "error") + hour(15, 0, fast=1)])
    assert alert_run(spark, tmp_dir) == sorted([*want, ("error", 12, "raised", 2), ("error", 14, "cleared", 0)])


def test_events_in_any_order_within_the_delay(spark, tmp_dir):
    rows = [row(i, 60 * (i // 3) + 7 * (i % 3)) for i in range(30)]
    random.Random(4).shuffle(rows)
    land(spark, f"{tmp_dir}/in", [rows, [row(99, 60 * 24)]])
    assert alert_run(spark, tmp_dir, min_slow=3) == [("click", 0, "raised", 3), ("click", 10, "cleared", 0)]
    assert spark.read.parquet(f"{tmp_dir}/out").where(F.col("n_slow") > 3).count() == 0


def test_rows_reach_the_state_as_frames_and_whole_numbers_stay_whole(spark, tmp_dir):
    class Pieces(list):
        get, appendValue = (lambda self: iter(self)), list.append

    class Handle:
        def __init__(self):
            self.pieces, self.timers = Pieces(), []

        def getListState(self, *_):  # noqa: N802 - Spark's name
            return self.pieces

        def registerTimer(self, at):  # noqa: N802 - Spark's name
            self.timers.append(at)

    class Times:
        getCurrentWatermarkInMs = getCurrentProcessingTimeInMs = staticmethod(lambda: 0)  # noqa: N815

    handle, own = Handle(), S.SeenKeys()
    own.init(handle)
    frame = pd.DataFrame({"ts": ["1", None, "1", "1"], "row_key": ["a", "a", "b", "a"]})
    got = pd.concat(own.handleInputRows((0, 0), iter([frame, frame]), Times()))
    assert got.index.tolist() == [0, 1, 2] and not got["late"].any()
    assert len(handle.pieces) == 1 and len(handle.pieces[0][0]) == 3 * S.DIGEST and len(handle.timers) == 1
    assert list(own.handleInputRows((0, 0), iter([frame]), Times())) == []

    big = 2 ** 60 + 1
    land(spark, f"{tmp_dir}/in", [[row(1, 0, offset=big), (*row(2, 5)[:3], None, None, None, *row(2, 5)[6:])]])
    run(spark, tmp_dir, "30 days")
    back = {r["UUID"]: r["XEventStartOffsetInBytes"] for r in spark.read.parquet(f"{tmp_dir}/good").collect()}
    assert back == {uuid_of(1): big, uuid_of(2): None}
