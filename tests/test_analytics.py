"""Analytics (A1-A9) against brute-force computations in plain Python on sf0.001."""

import math
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from eventlake.operators import analytics as A
from eventlake.sources import fixtures as X
from tests.conftest import SF001


@pytest.fixture(scope="module")
def raw():
    con = duckdb.connect()
    rows = con.execute(f"SELECT event_id, ts, user_id, event_type, value, props "
                       f"FROM '{SF001}/events.parquet'").fetchall()
    out = []
    for eid, ts, uid, et, val, props in rows:
        out.append(dict(ts=ts, user=f"u{uid}", kind=et, dur=int(round(val * 100000)),
                        hash=uid % 20, app=f"app{uid % 7}", db=f"db{uid % 3}"))
    return out


@pytest.fixture(scope="module")
def env(spark):
    return X.envelope(spark, SF001)


def test_slow_queries(env, raw):
    assert A.slow_queries(env).count() == sum(1 for r in raw if r["dur"] >= 5_000_000)


def test_query_hash_stats(env, raw):
    want = defaultdict(list)
    for r in raw:
        want[r["hash"]].append(r["dur"])
    got = {r.query_hash: r for r in A.query_hash_stats(env).collect()}
    assert set(got) == set(want)
    for h, ds in want.items():
        g = got[h]
        assert (g.executions, g.sum_duration, g.min_duration, g.max_duration) == (len(ds), sum(ds), min(ds), max(ds))
        assert g.avg_duration == sum(ds) / len(ds)


def test_windowed_stats_and_alerts(env, raw):
    want = defaultdict(list)
    for r in raw:
        want[(r["ts"].replace(minute=0, second=0, microsecond=0), r["kind"])].append(r["dur"])
    got = A.windowed_stats(env).collect()
    assert len(got) == len(want)
    assert sum(r.n_events for r in got) == len(raw)
    slow = {k: sum(1 for d in v if d >= 5_000_000) for k, v in want.items()}
    assert A.alerts(env, min_slow=2).count() == sum(1 for v in slow.values() if v >= 2)


def test_regressions(env, raw):
    daily = defaultdict(list)
    for r in raw:
        daily[(r["hash"], r["ts"].date())].append(r["dur"])
    n = 0
    by_hash = defaultdict(list)
    for (h, d), ds in daily.items():
        by_hash[h].append((d, sum(ds) / len(ds)))
    for h, seq in by_hash.items():
        seq.sort()
        n += sum(1 for (d0, m0), (d1, m1) in zip(seq, seq[1:]) if m1 / m0 >= 1.5)
    assert A.regressions(env, 1.5).count() == n


def test_workload(env, raw):
    want = defaultdict(set)
    cnt = defaultdict(int)
    for r in raw:
        want[(r["app"], r["ts"].hour)].add(r["hash"])
        cnt[(r["app"], r["ts"].hour)] += 1
    got = {(r.client_app_name, r.hour_of_day): (r.n_events, r.n_query_hashes) for r in A.workload(env).collect()}
    assert got == {k: (cnt[k], len(v)) for k, v in want.items()}
    approx = A.workload(env, exact=False).collect()
    assert len(approx) == len(got)


def test_audit_log(env, raw):
    out = A.audit_log(env)
    assert out.count() == sum(1 for r in raw if r["kind"] in ("signup", "purchase"))
    assert {"username", "client_hostname", "database_name", "client_app_name", "event_date"} <= set(out.columns)


def test_failure_bursts(env, raw):
    cnt = defaultdict(int)
    for r in raw:
        if r["kind"] == "error":
            cnt[(r["user"], r["ts"].date())] += 1
    assert A.failure_bursts(env, min_failures=2).count() == sum(1 for v in cnt.values() if v >= 2)


def test_capacity_percentiles_nearest_rank(env, raw):
    groups = defaultdict(list)
    for r in raw:
        groups[(r["ts"].date(), r["db"])].append(r["dur"])
    got = {(r.day, r.database_name): r for r in A.capacity_daily(env).collect()}
    assert len(got) == len(groups)
    for k, ds in groups.items():
        ds.sort()
        g = got[k]
        for p, v in ((0.5, g.p50_duration), (0.95, g.p95_duration), (0.99, g.p99_duration)):
            assert v == ds[max(1, math.ceil(p * len(ds))) - 1]
        assert g.n_events == len(ds) and g.sum_duration == sum(ds)


def test_streaming_frames_accepted(spark, tmp_dir):
    src = spark.readStream.schema(X.read_table(spark, SF001, "events", spread=False).schema) \
        .option("pathGlobFilter", "events.parquet").parquet(SF001)
    env = X.envelope_from_events(src).withWatermark("Timestamp", "30 seconds")
    for df in (A.windowed_stats(env), A.alerts(env), A.failure_bursts(env)):
        assert df.isStreaming
