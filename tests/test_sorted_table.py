"""K1 with merges: runs and files stay few, ranges open few files, lost writes leave no trace."""

import math

import pytest

from eventlake import folders
from eventlake.sinks.sorted_table import SortedTable
from tests.helpers import env_rows, uuid_of


def rows(lo, hi, step=1):
    return [(uuid_of(i * 7919 % 1000), "click", "2024-01-01T00:00:00+00:00", i, i, 1, "{}", "{}") for i in range(lo, hi, step)]


def keys(df):
    return sorted((r["UUID"], r["XEventStartOffsetInBytes"]) for r in df.select("UUID", "XEventStartOffsetInBytes").collect())


def test_appends_leave_few_runs_and_ranges_open_few_files(spark, tmp_dir):
    table = SortedTable(spark, tmp_dir, fanout=3, file_rows=10)
    want = []
    for k in range(14):
        own = rows(20 * k, 20 * k + 20)
        table.append(env_rows(spark, own))
        want += [(r[0], r[3]) for r in own]
        tiers = [t for t, _, _ in table.runs()]
        assert max(tiers.count(t) for t in tiers) < 3 and len(tiers) <= 2 * (math.log(k + 1, 3) + 1)
        assert sum(n for _, _, n in table.runs()) == len(want)
    assert keys(table.read()) == sorted(want)
    assert [t for t, _, _ in table.runs()] == [0, 0, 1, 2]
    low, high = uuid_of(500), uuid_of(505)
    opened = table.files(low, high).count()
    # of each run at most two files: a range boundary may cut the range in two
    assert opened <= 2 * len(table.runs()) < table.manifest().count()
    assert keys(table.read(low, high)) == sorted(x for x in want if low <= x[0] <= high)
    assert len(table.read(low, high).inputFiles()) == opened
    assert keys(table.read(high=uuid_of(3))) == sorted(x for x in want if x[0] <= uuid_of(3))
    assert table.read("zz", "zzz").count() == 0


def test_files_of_a_run_are_in_order_and_a_hot_key_is_split(spark, tmp_dir):
    hot = [(uuid_of(5), "click", "2024-01-01T00:00:00+00:00", i, i, 1, "{}", "{}") for i in range(200)]
    table = SortedTable(spark, tmp_dir, fanout=4, file_rows=50)
    table.append(env_rows(spark, hot + rows(0, 100)))
    files = sorted((r["low"], r["high"], r["n"]) for r in table.manifest().collect())
    assert all(a[1] <= b[0] for a, b in zip(files, files[1:], strict=False))
    assert max(n for *_, n in files) <= 150 and len(files) >= 4
    for f in table.manifest().collect():
        own = [(r["UUID"], r["XEventStartOffsetInBytes"]) for r in spark.read.parquet(f["path"]).collect()]
        assert own == sorted(own) and len(own) == f["n"]


def test_lost_writes_are_in_no_version(spark, tmp_dir):
    table = SortedTable(spark, tmp_dir, fanout=3, file_rows=100)
    table.append(env_rows(spark, rows(0, 10)))
    table.append(env_rows(spark, rows(10, 20)))
    before = keys(table.read())
    # a run that was written but not committed, and a manifest that was cut off
    table._write(env_rows(spark, rows(20, 30)), 10, 0)
    env_rows(spark, rows(0, 1)).select("UUID").write.parquet(f"{tmp_dir}/manifest/v{table.version() + 1}")
    folders.remove(spark, f"{tmp_dir}/manifest/v{table.version()}/_SUCCESS")
    assert keys(table.read()) == before and len(folders.children(spark, f"{tmp_dir}/runs")) == 3
    table.append(env_rows(spark, rows(20, 30)))                       # the append again; it also fills the tier
    assert [t for t, _, _ in table.runs()] == [1]
    assert len(keys(table.read())) == 30 and len(set(keys(table.read()))) == 30
    gone = table.vacuum()
    assert len(gone) == 4 and folders.children(spark, f"{tmp_dir}/runs") == [table.runs()[0][1]]
    assert len(keys(table.read())) == 30


def test_no_rows_and_null_keys(spark, tmp_dir):
    table = SortedTable(spark, f"{tmp_dir}/a", fanout=2)
    assert table.read() is None and table.read("a", "b") is None
    table.append(env_rows(spark, []))
    assert table.version() == 0
    table.append(env_rows(spark, [(None, "click", None, 1, 1, 1, "{}", "{}"), *rows(0, 2)]))
    table.append(env_rows(spark, [(None, "click", None, 2, 1, 1, "{}", "{}")]))
    assert table.read().count() == 4 and table.read("0", "z").count() == 2
    with pytest.raises(ValueError):
        SortedTable(spark, tmp_dir, fanout=1)


def test_a_stream_stores_each_batch_once(spark, tmp_dir):
    from eventlake.sources.readers import read_event_stream
    from eventlake.streaming import runner as T

    landing = f"{tmp_dir}/landing"
    env_rows(spark, rows(0, 30)).repartition(3).write.parquet(landing + "/a")
    table = SortedTable(spark, f"{tmp_dir}/table", fanout=3)
    options = {"recursiveFileLookup": "true", "maxFilesPerTrigger": "1"}
    again = []

    def write(batch, root, key):
        T.sorted_by_batch(table)(batch, root, key)
        T.sorted_by_batch(table)(batch, root, key)                    # a replay of the batch finds itself
        again.append(key)

    for part in (rows(30, 40), rows(40, 50)):
        T.drain(T.run(read_event_stream(spark, landing, options=options), None, f"{tmp_dir}/table", f"{tmp_dir}/dead",
                      f"{tmp_dir}/ckpt", write_good=write))
        env_rows(spark, part).coalesce(1).write.parquet(f"{landing}/{len(again)}")
    T.drain(T.run(read_event_stream(spark, landing, options=options), None, f"{tmp_dir}/table", f"{tmp_dir}/dead",
                  f"{tmp_dir}/ckpt", write_good=write))
    assert len(again) == 5 and len(set(again)) == 5
    assert len(keys(table.read())) == 50 and len(set(keys(table.read()))) == 50
    assert len(table.runs()) == 3 and table._all().where("tier = -1").count() == 1
