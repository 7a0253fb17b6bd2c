"""The driver contract and the plan properties the design relies on."""

import __spark_entry__ as entry_mod
from eventlake.plans import catalog
from tests.conftest import SF001


def test_entry_returns_rows(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["query_hash", "executions", "sum_duration", "min_duration",
                          "max_duration", "avg_duration"]


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_kind_filter_reaches_the_scan(spark):
    plan = _plan(catalog.capture_session(spark, SF001))
    assert "PushedFilters: [IsNotNull(event_type), In(event_type, [click,error])]" in plan or \
        "In(event_type, [click,error])" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(catalog.failure_bursts(spark, SF001))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_aggregates_are_partial_before_the_shuffle(spark):
    for q in (catalog.query_hash_stats, catalog.hourly_stats, catalog.capacity_daily, catalog.dedup_key):
        plan = _plan(q(spark, SF001))
        assert "partial_" in plan or "HashAggregate(keys=" in plan


def test_no_python_udf_in_any_query(spark):
    for name, q in catalog.QUERIES.items():
        if name.startswith(("stream_", "sink_", "ordered")):
            continue
        plan = _plan(q(spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_cluster_conf_applies_at_runtime(spark):
    from eventlake.session import CLUSTER_CONF, apply_cluster_conf
    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        apply_cluster_conf(spark, {"spark.sql.shuffle.partitions": "16"})
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_shuffle_partition_sizing():
    from eventlake.session import shuffle_partitions_for
    assert shuffle_partitions_for(100 * 2 ** 40) == 102400          # 100 TiB at 1 GiB per task
    assert shuffle_partitions_for(10 * 2 ** 20) == 200              # small shuffles: the floor
