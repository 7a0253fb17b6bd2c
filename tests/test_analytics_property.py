"""Property tests: windowed analytics with random windows and thresholds against brute force."""

import datetime as dt
from collections import defaultdict

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake.operators import analytics as A
from eventlake.sources import fixtures as X
from tests.conftest import SF001

EPOCH = dt.datetime(1970, 1, 1)


@pytest.fixture(scope="module")
def raw():
    rows = duckdb.connect().execute(
        f"SELECT ts, user_id, event_type, value FROM '{SF001}/events.parquet'").fetchall()
    return [dict(ts=ts, user=f"u{uid}", kind=et, dur=int(round(v * 100000))) for ts, uid, et, v in rows]


def _bucket(ts: dt.datetime, minutes: int) -> int:
    us = (ts - EPOCH) // dt.timedelta(microseconds=1)
    width = minutes * 60_000_000
    return us - us % width


SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.sampled_from([1, 7, 30, 60, 90, 240, 1440]))
def test_windowed_stats_any_width(spark, raw, minutes):
    env = X.envelope(spark, SF001)
    got = {(r.ws, r.Name): (r.n_events, r.sum_duration, r.max_duration)
           for r in A.windowed_stats(env, f"{minutes} minutes")
           .select(F.unix_micros("window.start").alias("ws"), "Name", "n_events", "sum_duration",
                   "max_duration").collect()}
    want = defaultdict(list)
    for r in raw:
        want[(_bucket(r["ts"], minutes), r["kind"])].append(r["dur"])
    assert got == {k: (len(v), sum(v), max(v)) for k, v in want.items()}


@SETTINGS
@given(st.integers(min_value=1, max_value=4), st.sampled_from([60, 720, 1440]))
def test_failure_bursts_any_threshold(spark, raw, min_failures, minutes):
    env = X.envelope(spark, SF001)
    got = {(r.username, r.ws): r.n_failures
           for r in A.failure_bursts(env, min_failures=min_failures, every=f"{minutes} minutes")
           .select("username", F.unix_micros("window.start").alias("ws"), "n_failures").collect()}
    cnt = defaultdict(int)
    for r in raw:
        if r["kind"] == "error":
            cnt[(r["user"], _bucket(r["ts"], minutes))] += 1
    assert got == {k: v for k, v in cnt.items() if v >= min_failures}
