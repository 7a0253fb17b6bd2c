"""Every registered query against its DuckDB oracle at sf0.001: names, types and an
order-insensitive multiset of rows (the correctness gate, run inside pytest)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF001
from tools.check_oracles import TABLES, TYPE_MAP, rows_of

QUERIES = entry_mod.queries()
ORACLES = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    s_names = df.columns
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    d_names = [d[0] for d in res.description]
    d_types = {d[0]: str(d[1]) for d in res.description}
    d_rows = res.fetchall()
    assert sorted(s_names) == sorted(d_names)
    assert {c: TYPE_MAP.get(t, t) for c, t in s_types.items()} == d_types
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_names, s_rows) == rows_of(d_names, d_rows)
