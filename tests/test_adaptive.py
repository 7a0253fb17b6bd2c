"""Triggers sized by what the sink can take."""

import time

import pytest

from eventlake.sources.readers import read_event_stream
from eventlake.streaming import runner as T
from eventlake.streaming.adaptive import RateController, drain_adaptive
from tests.helpers import env_rows, uuid_of


def test_the_limit_follows_the_processing_rate():
    c = RateController(limit=10, target_seconds=2.0, most=100)
    assert not c.heard(1000, 2.0) and c.limit == 10                      # as wanted
    assert c.heard(1000, 8.0) and c.limit == 4                           # slower: smoothed to 5 ms a row
    for _ in range(6):
        c.heard(100 * c.limit, 0.8 * c.limit)
    assert c.limit in (2, 3, 4)                                             # 0.8 s a unit: 2 s hold two or three
    for _ in range(9):
        c.heard(100 * c.limit, 0.01 * c.limit)
    assert 70 <= c.limit <= 100                                         # fast again: up to the most, by steps
    assert not c.heard(0, 1.0)
    for _ in range(20):
        c.heard(100 * c.limit, 50.0 * c.limit)
    assert c.limit == 1                                                  # never below the least
    with pytest.raises(ValueError):
        RateController(limit=5, target_seconds=1, most=4)


def test_batches_shrink_for_a_slow_sink_and_lose_nothing(spark, tmp_dir):
    for k in range(40):
        env_rows(spark, [(uuid_of(20 * k + i), "click", "2024-01-01T00:00:00+00:00", i, i, 1, "{}", "{}") for i in range(20)]
                 ).coalesce(1).write.parquet(f"{tmp_dir}/in/{k:03d}")

    def write(batch, root, key):
        time.sleep(0.03 * batch.count())                                 # 0.6 s a file
        T.daily_by_batch(batch, root, key)

    def start(limit):
        src = read_event_stream(spark, f"{tmp_dir}/in", options={"recursiveFileLookup": "true", **T.rate_options(max_files=limit)})
        return T.run(src, None, f"{tmp_dir}/good", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt", write_good=write)

    controller = RateController(limit=16, target_seconds=3.0, least=1, most=16)
    batches = drain_adaptive(spark, start, controller)
    sizes = [rows // 20 for _, rows, _ in batches]
    assert sizes[0] == 16 and max(sizes) <= 16 and len(batches) >= 5
    assert 1 <= controller.limit <= 5 and sizes[-2] <= 5                 # 3 s hold some four files
    stored = spark.read.parquet(f"{tmp_dir}/good")
    assert stored.count() == 800 and stored.select("UUID").distinct().count() == 800
    assert drain_adaptive(spark, start, controller) == []                # nothing left
