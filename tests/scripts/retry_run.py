"""Run a few operators twice in a session that allows task retries: once clean, once with
the first attempt of some tasks failing after the scan's exchange.  Prints OK when the
retried results equal the clean ones (the recomputation is deterministic)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from eventlake.functions.envelope import to_text  # noqa: E402
from eventlake.operators import analytics as A  # noqa: E402
from eventlake.operators import capture as C  # noqa: E402
from eventlake.plans.catalog import STANDARD_SPECS  # noqa: E402
from eventlake.sinks import writers as K  # noqa: E402
from eventlake.sources import fixtures as X  # noqa: E402

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
spark.sparkContext.setLogLevel("OFF")
sf = sys.argv[1]
MARKS = sys.argv[2]          # a folder: one file per injected failure


def _chaos(_):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 1:
        open(os.path.join(MARKS, f"stage{ctx.stageId()}-part{ctx.partitionId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return True


# nondeterministic: keeps the filter above the exchange (a deterministic one is pushed into the scan)
chaos = F.udf(_chaos, "boolean").asNondeterministic()


def runs(events):
    dup = X.env_dup(events)
    return {
        "dedup": sorted(tuple(r) for r in to_text(K.dedup_key(dup)).collect()),
        "capture": sorted(tuple(r) for r in to_text(C.capture(X.envelope_from_events(events), STANDARD_SPECS)).collect()),
        "stats": sorted(tuple(r) for r in A.query_hash_stats(X.envelope_from_events(events)).collect()),
        "capacity": sorted(tuple(r) for r in A.capacity_daily(X.envelope_from_events(events)).collect()),
    }


events = X.read_table(spark, sf, "events")
clean = runs(events)
flaky = runs(events.filter(chaos(F.col("event_id"))))
print("OK" if clean == flaky else "MISMATCH", len(os.listdir(MARKS)), {k: len(v) for k, v in clean.items()})
