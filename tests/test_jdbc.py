"""The relational sink with its batch ledger and the balanced scan, on embedded in-memory Derby (only
this process sees that database, so these are tests and no registered queries)."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from eventlake.sinks import writers as K
from eventlake.sinks.jdbc_ledger import JdbcLedgerSink
from eventlake.sources import readers as S
from eventlake.streaming import runner as T
from tests.helpers import env_rows, uuid_of

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture()
def url():
    return f"jdbc:derby:memory:ev{uuid.uuid4().hex[:8]};create=true"


def row(i, name="click", offset=None, day=1):
    return (uuid_of(i), name, f"2024-01-{day:02d}T00:00:00.000000+00:00", i if offset is None else offset, i, 1, '{"a":1}', f'{{"duration":{i}}}')


def stored(spark, url, table="xe_data"):
    rows = S.read_jdbc(spark, url, table, properties=DRIVER).select(
        "UUID", "XEventStartOffsetInBytes", F.to_json("Fields").alias("f")).collect()
    return sorted((r["UUID"], r["XEventStartOffsetInBytes"], r["f"]) for r in rows)


# --- the ledger ----------------------------------------------------------------------------------

def test_a_replayed_batch_stores_nothing_twice(spark, url):
    sink = JdbcLedgerSink(spark, url, properties=DRIVER, parallelism=3, batch_size=4)
    first = env_rows(spark, [row(i) for i in range(20)])
    assert sink.store(first, "q", 0) == 20
    assert sink.store(first, "q", 0) == 0                                    # the replay: the ledger has it
    assert sink.store(env_rows(spark, [row(i) for i in range(15, 30)]), "q", 1) == 10   # overlapping keys
    assert sink.store(first, "another", 0) == 0 and sink.last_batch("another") == 0     # another query's replay
    assert sink.last_batch("q") == 1 and sink.last_batch("nobody") == -1
    assert [k for k, *_ in stored(spark, url)] == sorted(uuid_of(i) for i in range(30))
    again = JdbcLedgerSink(spark, url, properties=DRIVER)                     # a restart finds its tables
    assert again.last_batch("q") == 1 and again.store(first, "q", 1) == 0


def test_a_lost_attempt_and_a_repeated_task_leave_no_trace(spark, url):
    sink = JdbcLedgerSink(spark, url, properties=DRIVER)
    batch = env_rows(spark, [row(i) for i in range(12)])
    sink.load(batch)                                                          # lost before the transaction
    assert stored(spark, url) == [] and sink.last_batch("q") == -1
    assert sink.store(batch, "q", 0) == 12
    # a task whose rows were committed and that ran again: its rows stand in the staging table twice
    more = env_rows(spark, [row(i) for i in range(12, 20)])
    sink.load(more)
    K.jdbc_frame(more.limit(5)).write.format("jdbc").mode("append").option("url", url).option("dbtable", sink.stage).options(**DRIVER).save()
    assert sink.move("q", 1) == 8
    assert [k for k, *_ in stored(spark, url)] == [uuid_of(i) for i in range(20)]


def test_rows_and_ledger_are_one_transaction(spark, url):
    sink = JdbcLedgerSink(spark, url, properties=DRIVER)
    bad = env_rows(spark, [row(1), row(2, name=None)])                        # breaks the target's NOT NULL
    with pytest.raises(Exception, match="(?i)null"):
        sink.store(bad, "q", 0)
    assert stored(spark, url) == [] and sink.last_batch("q") == -1
    assert sink.store(env_rows(spark, [row(1)]), "q", 0) == 1
    with pytest.raises(ValueError):
        JdbcLedgerSink(spark, url, table="x; DROP TABLE y", properties=DRIVER)


def test_stream_into_a_relational_table_survives_replay_and_restart(spark, tmp_dir, url):
    landing = f"{tmp_dir}/landing"
    env_rows(spark, [row(i) for i in range(30)]).repartition(3).write.parquet(landing + "/a")
    sink = JdbcLedgerSink(spark, url, properties=DRIVER)
    calls = []

    def write(batch, root, key):
        T.jdbc_by_batch(sink)(batch, root, key)
        calls.append(key)
        if len(calls) == 2:
            raise RuntimeError("lost after the commit")                       # the batch is replayed on restart

    def run():
        src = S.read_event_stream(spark, landing, options={"recursiveFileLookup": "true", "maxFilesPerTrigger": "1"})
        T.drain(T.run(src, None, "unused", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt", write_good=write))

    with pytest.raises(Exception, match="lost after the commit"):
        run()
    env_rows(spark, [row(i) for i in range(25, 40)] + [row(50, name=None)]).coalesce(1).write.parquet(landing + "/b")
    run()
    assert calls[1] == calls[2]                                               # the same batch came again
    assert [k for k, *_ in stored(spark, url)] == sorted(uuid_of(i) for i in range(40))
    assert spark.read.parquet(f"{tmp_dir}/dead").count() == 1


# --- the balanced scan -----------------------------------------------------------------------------

def sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_balanced_scan_of_a_skewed_table(spark, url):
    # nine tenths of the offsets lie in a thousandth of their range, a third of all on one value
    rows = ([row(i, offset=i) for i in range(1200)] + [row(2000 + i, offset=500) for i in range(800)]
            + [row(4000 + i, offset=1_000_000 + 5000 * i) for i in range(200)])
    env = env_rows(spark, rows).withColumn("XEventSizeInBytes", F.col("XEventEndOffsetInBytes"))
    K.write_jdbc(env, url, "xe_data", properties=DRIVER)
    plain = S.read_jdbc(spark, url, "xe_data", "XEventStartOffsetInBytes", 0, 2_000_000, 8, properties=DRIVER)
    assert max(sizes(plain)) > 0.8 * len(rows)
    for fraction in (None, 0.5):
        df = S.read_jdbc_balanced(spark, url, "xe_data", "XEventStartOffsetInBytes", 8, tie="XEventSizeInBytes",
                                  fraction=fraction, properties=DRIVER)
        n = sizes(df)
        assert sum(n) == len(rows) and df.select("UUID").distinct().count() == len(rows)
        assert max(n) < 2 * len(rows) / df.rdd.getNumPartitions() and 8 <= df.rdd.getNumPartitions() <= 11
    alone = S.read_jdbc_balanced(spark, url, "xe_data", "XEventStartOffsetInBytes", 8, properties=DRIVER)
    assert sum(sizes(alone)) == len(rows)                                      # without a tie: one heavy part
    by_time = S.read_jdbc_balanced(spark, url, "xe_data", "Timestamp", 4, tie="XEventSizeInBytes", properties=DRIVER)
    assert sum(sizes(by_time)) == len(rows) and max(sizes(by_time)) < 2 * len(rows) / by_time.rdd.getNumPartitions()


@pytest.mark.parametrize("values", [[], [None] * 40, [5] * 40, [None] * 30 + [1, 2, 3], list(range(100)), [1] * 50 + [2] * 50,
                                    [7] * 90 + list(range(10)) + [None] * 3, [3, None]])
@pytest.mark.parametrize("parts", [1, 3, 7])
def test_predicates_take_each_row_once(spark, values, parts):
    df = spark.createDataFrame([(v, None if i == 4 else -i) for i, v in enumerate(values)], "v long, t long").coalesce(2)
    for tie in ("t", None):
        clauses = [re.sub('"', "", c) for c in S.balanced_predicates(df, "v", parts, tie)]
        counts = df.select(*[F.count_if(F.expr(c)).alias(f"c{k}") for k, c in enumerate(clauses)],
                           F.count(F.lit(1)).alias("n")).first()
        assert sum(counts[:-1]) == counts[-1] == len(values), clauses
        hits = df.select(sum([F.when(F.expr(c), 1).otherwise(0) for c in clauses], F.lit(0)).alias("k"))
        assert hits.where("k <> 1").count() == 0, clauses
        if tie and len(values) > 30:
            assert max(counts[:-1]) <= 2.1 * len(values) / parts, (clauses, counts)
