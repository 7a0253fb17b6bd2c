"""Property test: random capture sessions against a plain-Python model of the rules."""

import hashlib
import json

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake.operators import capture as C
from eventlake.sources import fixtures as X
from tests.conftest import SF001

KINDS = ["click", "error", "purchase", "signup", "view"]
ACTION_KEYS = ["client_app_name", "client_hostname", "database_name", "query_hash", "username"]
FIELD_KEYS = ["duration", "k", "note", "statement"]


def _uuid(eid: int) -> str:
    h = hashlib.md5(str(eid).encode()).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


@pytest.fixture(scope="module")
def model_rows():
    rows = duckdb.connect().execute(
        f"SELECT event_id, event_type, user_id, value, props FROM '{SF001}/events.parquet'").fetchall()
    out = []
    for eid, et, uid, val, props in rows:
        k = json.loads(props)["k"]
        out.append(dict(
            uuid=_uuid(eid), name=et,
            actions={"client_app_name": f"app{uid % 7}", "client_hostname": f"host{uid % 11}",
                     "database_name": f"db{uid % 3}", "query_hash": uid % 20, "username": f"u{uid}"},
            fields={"duration": int(round(val * 100000)), "k": k, "note": None, "statement": f"stmt {et} {k}"}))
    return out


@pytest.fixture(scope="module")
def env(spark):
    df = X.envelope(spark, SF001).cache()
    yield df
    df.unpersist(blocking=True)   # later plan tests must see the Parquet scan, not the cache


spec_st = st.fixed_dictionaries({
    "name": st.sampled_from(KINDS),
    "actions": st.one_of(st.none(), st.lists(st.sampled_from(ACTION_KEYS), unique=True, max_size=5)),
    "drop": st.lists(st.sampled_from(FIELD_KEYS), unique=True, max_size=2),
    "threshold": st.one_of(st.none(), st.integers(min_value=0, max_value=20_000_000)),
})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(spec_st, min_size=1, max_size=4, unique_by=lambda s: s["name"]))
def test_capture_matches_model(env, model_rows, raw_specs):
    specs = [C.CaptureSpec(name=s["name"], actions=None if s["actions"] is None else tuple(s["actions"]),
                           attributes={f"collect_{f}": "0" for f in s["drop"]},
                           predicate=None if s["threshold"] is None else f"[duration] >= {s['threshold']}",
                           field_types={"duration": "bigint"})
             for s in raw_specs]
    got = {r[0]: (json.loads(r[1]), json.loads(r[2]))
           for r in C.capture(env, specs).select("UUID", F.to_json("Actions"), F.to_json("Fields")).collect()}
    want = {}
    by_name = {s["name"]: s for s in raw_specs}
    for row in model_rows:
        s = by_name.get(row["name"])
        if s is None or (s["threshold"] is not None and row["fields"]["duration"] < s["threshold"]):
            continue
        acts = row["actions"] if s["actions"] is None else {k: v for k, v in row["actions"].items()
                                                            if k in s["actions"]}
        flds = {k: v for k, v in row["fields"].items() if k not in s["drop"]}
        want[row["uuid"]] = (acts, flds)
    assert got == want
