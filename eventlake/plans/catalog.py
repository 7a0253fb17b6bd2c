"""The registered queries: one per operator of the inventory, each reading the given
tables (whole) at ``sf_dir`` and returning a DataFrame whose columns are plain
strings and numbers, so an independent engine can check them value for value.

Timestamps leave as ``*_us`` (microseconds since 1970) or ISO text; payloads as
canonical JSON text; dates as ``yyyy-MM-dd`` text.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions import encode as E
from eventlake.functions.envelope import field, project, to_text
from eventlake.operators import analytics as A
from eventlake.operators import capture as C
from eventlake.operators import verify as V
from eventlake.session import ensure_utc, scratch_path
from eventlake.sinks import writers as K
from eventlake.sources import fixtures as X
from eventlake.sources import readers as S
from eventlake.streaming import runner as T

Query = Callable[[SparkSession, str], DataFrame]

# The standard capture session of the registered queries.
STANDARD_SPECS = (
    C.CaptureSpec(name="error", actions=("query_hash", "username"),
                  attributes={"collect_statement": "0"}, predicate="[duration]>= 5000000",
                  field_types={"duration": "bigint"}),
    C.CaptureSpec(name="click", actions=("query_hash", "username"),
                  attributes={"collect_statement": "0"}, predicate="[duration]>= 5000000",
                  field_types={"duration": "bigint"}),
)
STATEMENT_PATTERN = r"^stmt (click|error|purchase|signup|view) [0-9]+$"


def _env(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return X.envelope(spark, sf_dir)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return X.read_table(spark, sf_dir, "events")


def _slots(spark: SparkSession) -> int | None:
    """State partitions for the registered streaming queries: the cluster's task slots
    (the test inputs are small; Spark's default of 200 would mostly run empty tasks)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no classic context: keep the session setting
        return None


def _us(col: str = "Timestamp") -> Column:
    return F.unix_micros(F.col(col))


def _day_text(col: str) -> Column:
    return F.date_format(F.col(col), "yyyy-MM-dd")


# --- sources and envelope ----------------------------------------------------------------------

def envelope_project(spark, sf_dir):
    """E1 (+E2, E7): the eight envelope columns in text form."""
    wide = _env(spark, sf_dir).withColumn("ingest_note", F.lit("extra column"))
    return to_text(project(wide))


def field_get(spark, sf_dir):
    """Payload values by key with their types."""
    env = _env(spark, sf_dir)
    return env.select(
        "UUID",
        field("Fields", "duration", "bigint").alias("duration"),
        field("Fields", "k", "bigint").alias("k"),
        field("Fields", "statement").alias("statement"),
        field("Fields", "note").alias("note"),
        field("Fields", "missing_key", "bigint").alias("missing"),
        field("Actions", "query_hash", "bigint").alias("query_hash"),
        field("Actions", "username").alias("username"))


# --- capture ---------------------------------------------------------------------------------------

def filter_name(spark, sf_dir):
    """C1."""
    return C.select_events(_env(spark, sf_dir), ["error", "click"]).select(
        "UUID", "Name", _us().alias("Timestamp_us"))


def filter_predicate(spark, sf_dir):
    """C2 over every kind."""
    spec = STANDARD_SPECS[0]
    return C.where(_env(spark, sf_dir), spec).select(
        "UUID", "Name", field("Fields", "duration", "bigint").alias("duration"))


def filter_predicate_dirty(spark, sf_dir):
    """C2 without declared types over payloads in which some durations are text, some fractions and some not
    there: the numbers that fields are compared with give the types, and what is no number does not match."""
    env = _env(spark, sf_dir)
    eid = X.source_id()
    text = (F.when(eid % 89 == 0, F.lit('{"duration": "n/a"}'))
            .when(eid % 83 == 0, F.concat(F.lit('{"duration": "'), field("Fields", "duration"), F.lit('"}')))
            .when(eid % 79 == 0, F.lit('{"duration": 5000000.5}'))
            .when(eid % 73 == 0, F.lit("{}")).otherwise(F.to_json("Fields")))
    spec = C.CaptureSpec(name="any", predicate="5000000 < [duration] AND [sqlserver].[query_hash] IN (1, 2, 3)")
    return C.where(env.withColumn("Fields", F.parse_json(text)), spec).select(
        "UUID", "Name", field("Fields", "duration").alias("duration"))


def project_actions(spark, sf_dir):
    """C3."""
    return C.keep_actions(_env(spark, sf_dir), ["query_hash", "username"]).select(
        "UUID", F.to_json("Actions").alias("Actions"))


def project_optional_fields(spark, sf_dir):
    """C4."""
    return C.optional_fields(_env(spark, sf_dir), {"collect_statement": "0"}).select(
        "UUID", F.to_json("Fields").alias("Fields"))


def capture_session(spark, sf_dir):
    """The two standard definitions in one pass."""
    return to_text(C.capture(_env(spark, sf_dir), STANDARD_SPECS))


def drop_null_events(spark, sf_dir):
    """C6 over the dirty envelope."""
    return C.drop_null(X.env_dirty(_events(spark, sf_dir))).select("UUID", "Name")


# --- encoders ----------------------------------------------------------------------------------

def fields_json(spark, sf_dir):
    """E2."""
    env = _env(spark, sf_dir)
    return env.select("UUID", E.payload_json("Actions").alias("actions_json"),
                      E.payload_json("Fields").alias("fields_json"))


def event_json(spark, sf_dir):
    """E3."""
    return _env(spark, sf_dir).select("UUID", E.event_json().alias("event_json"))


def typed_values(spark, sf_dir):
    """One payload per event holding every value type of the type switch,
    derived from the event's own columns, rendered to JSON text."""
    ev = _events(spark, sf_dir)
    typed = ev.select(
        F.col("event_id"),
        F.lit(None).cast("string").alias("t_null"),
        (F.col("user_id") % 128).cast("tinyint").alias("t_byte"),
        (-(F.col("user_id") % 32768)).cast("smallint").alias("t_short"),
        F.col("event_id").cast("int").alias("t_int"),
        (F.col("event_id") * 1000000007).alias("t_long"),
        (F.col("user_id") * 400 % 65536).cast("int").alias("t_ushort"),
        (F.lit(4294967295) - F.col("event_id")).alias("t_uint"),
        (F.lit(Decimal("18446744073709551615")) - F.col("event_id")).cast("decimal(20,0)").alias("t_ulong"),
        ((F.col("event_id") % 64) + F.lit(0.5)).cast("float").alias("t_float"),
        F.col("value").alias("t_double"),
        F.concat(F.lit('say "hi"\n'), F.col("event_type"), F.lit(" ü€")).alias("t_string"),
        F.col("ts").cast("timestamp").alias("t_timestamp"),
        F.regexp_replace(F.md5(F.col("props")), E.UUID_GROUPS, "$1-$2-$3-$4-$5").alias("t_guid"),
        (F.col("event_id") % 2 == 0).alias("t_bool"),
        F.unhex(F.substring(F.md5(F.col("event_type")), 1, 8)).alias("t_binary"),
        F.col("value").cast("decimal(12,2)").alias("t_decimal"),
    )
    payload = E.payload_from_columns(typed.schema, [c for c in typed.columns if c != "event_id"])
    return typed.select(F.col("event_id"), F.to_json(payload).alias("payload_json"))


def ts_epoch_seconds(spark, sf_dir):
    """E5."""
    env = _env(spark, sf_dir)
    return env.select("UUID", E.epoch_seconds("Timestamp").alias("epoch_seconds"),
                      F.unix_micros(F.date_trunc("second", "Timestamp")).alias("second_us"))


def ts_micros(spark, sf_dir):
    """E6."""
    return _env(spark, sf_dir).select("UUID", E.micros_2000("Timestamp").alias("micros_2000"))


def ts_iso(spark, sf_dir):
    """E7."""
    return _env(spark, sf_dir).select("UUID", E.iso_ts("Timestamp").alias("ts_iso"))


def ts_utc(spark, sf_dir):
    """Text with a +03:00 offset back to the UTC instant."""
    txt = X.env_text(_events(spark, sf_dir))
    return txt.select("UUID", F.col("Timestamp").alias("ts_text"),
                      F.unix_micros(E.to_utc("Timestamp")).alias("Timestamp_us"))


def uuid_canonical(spark, sf_dir):
    """The same UUID text from braced upper-case and bare forms; RFC byte order."""
    env = _env(spark, sf_dir)
    braced = F.concat(F.lit("{"), F.upper("UUID"), F.lit("}"))
    bare = F.regexp_replace("UUID", "-", "")
    return env.select("UUID", E.uuid_text(braced).alias("from_braced"),
                      E.uuid_text(bare).alias("from_bare"),
                      F.hex(E.uuid_bytes("UUID")).alias("bytes_hex"))


def encoded_bytes(spark, sf_dir):
    """E10 + E11: encoded volume per event kind and hour."""
    env = _env(spark, sf_dir)
    sized = env.select("Name", F.date_trunc("hour", "Timestamp").alias("hour"),
                       E.utf8_len("Name").alias("name_bytes"), E.variable_bytes().alias("var_bytes"))
    return (sized.select("Name", "hour", "name_bytes",
                         E.row_bytes("relational", variable=F.col("var_bytes")).alias("rel_bytes"),
                         E.row_bytes("sorted", variable=F.col("var_bytes")).alias("sorted_bytes"))
            .groupBy("Name", "hour")
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum("name_bytes").alias("name_bytes"),
                 F.sum("rel_bytes").alias("relational_bytes"), F.sum("sorted_bytes").alias("sorted_bytes"))
            .select("Name", _us("hour").alias("hour_us"), "n_events", "name_bytes",
                    "relational_bytes", "sorted_bytes"))


def bytes_base64(spark, sf_dir):
    """E12."""
    return _env(spark, sf_dir).select("UUID", E.b64(E.uuid_bytes("UUID")).alias("uuid_base64"))


def parse_payload(spark, sf_dir):
    """Payload text (with JSON null, SQL NULL and malformed rows mixed in) parsed back."""
    txt = X.env_text(_events(spark, sf_dir))
    eid = X.source_id()
    raw = (F.when(eid % 19 == 0, F.lit("not json"))
           .when(eid % 17 == 0, F.lit(None).cast("string"))
           .when(eid % 13 == 0, F.lit("null"))
           .otherwise(F.col("Fields")))
    parsed = txt.select("UUID", raw.alias("raw")).select("UUID", E.parse_payload("raw").alias("p"))
    return parsed.select("UUID", F.to_json("p").alias("fields_json"),
                         F.col("p").isNull().alias("dead_letter"))


# --- sinks ---------------------------------------------------------------------------------------

def sink_sorted(spark, sf_dir):
    """K1: captured events appended to a UUID-sorted table and read back."""
    path = scratch_path(spark, "sink-sorted")
    K.write_sorted(C.capture(_env(spark, sf_dir), STANDARD_SPECS), path)
    return to_text(spark.read.parquet(path))


def sorted_merge(spark, sf_dir):
    """K1 with merges: the captured events in seven appends to a UUID-sorted table (a tier of three
    runs is merged); the live runs read back."""
    from eventlake.sinks.sorted_table import SortedTable
    table = SortedTable(spark, scratch_path(spark, "sorted-table"), fanout=3)
    captured = C.capture(_env(spark, sf_dir), STANDARD_SPECS)
    for delivery in range(7):
        table.append(captured.filter(X.source_id() % 7 == delivery))
    return to_text(table.read())


def sink_daily(spark, sf_dir):
    """K2: the whole envelope appended to UTC-day partitions and read back."""
    path = scratch_path(spark, "sink-daily")
    K.write_daily(_env(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.select("UUID", "Name", _us().alias("Timestamp_us"),
                       _day_text("event_date").alias("event_date"))


def sink_ingest(spark, sf_dir):
    """K1-K7 in one job: capture, dedup and constraint check of the envelope with replays
    and broken rows, written once (good and dead by partition); good rows read back."""
    from eventlake.sinks.ingest import ingest
    root = scratch_path(spark, "ingest")
    dirty = X.env_dirty(_events(spark, sf_dir))
    replays = dirty.filter(X.source_id() % 10 == 0)
    ingest(dirty.unionByName(replays), None, root)
    return _ingested(spark, root)


def _ingested(spark, root):
    from eventlake.sinks.ingest import read_status
    good = read_status(spark, root)
    dead = read_status(spark, root, "dead")
    return (good.select("UUID", "Name", _us().alias("Timestamp_us"), F.lit(None).cast("string").alias("reject_reason"))
            .unionByName(dead.select("UUID", "Name", _us().alias("Timestamp_us"), "reject_reason")))


# The first delivery of the repeated ingest ends here.
FIRST_DELIVERY = "2024-01-16"


def ingest_twice(spark, sf_dir):
    """K6 over what is stored: the older half of the dirty envelope is ingested, then the whole of it
    with replays, then the whole again; every event and every dead letter is stored once."""
    from eventlake.sinks.ingest import ingest
    root = scratch_path(spark, "ingest")
    dirty = X.env_dirty(_events(spark, sf_dir))
    ingest(dirty.filter(F.col("Timestamp") < F.lit(FIRST_DELIVERY).cast("timestamp")), None, root)
    ingest(dirty.unionByName(dirty.filter(X.source_id() % 10 == 0)), None, root)
    ingest(dirty, None, root)
    return _ingested(spark, root)


def _landed(spark, sf_dir):
    """The text lines with all seven faults, landed."""
    path = scratch_path(spark, "lines")
    X.landing_lines(_events(spark, sf_dir)).write.text(path)
    return path


def ingest_captured_dirty(spark, sf_dir):
    """C5 and K7 on dirty input: landed lines with all seven faults are captured and ingested; broken rows of a
    declared kind, or of none, are dead letters with their reason, whatever the predicate."""
    from eventlake.sinks.ingest import ingest
    root = scratch_path(spark, "ingest")
    specs = [*STANDARD_SPECS, C.CaptureSpec(name="x" * 256)]
    ingest(S.read_event_lines(spark, _landed(spark, sf_dir)), specs, root)
    return _ingested(spark, root)


def stream_dead_letter(spark, sf_dir):
    """T7 on a stream: landed lines with all seven faults; good rows to the sink, the others to the dead letter
    with their reason."""
    good, dead, ckpt = (scratch_path(spark, n) for n in ("good", "dead", "ckpt"))
    src = S.read_event_stream(spark, _landed(spark, sf_dir), fmt="json")
    T.drain(T.run(src, None, good, dead, ckpt, state_partitions=_slots(spark)))
    columns = ["UUID", "Name", _us().alias("Timestamp_us")]
    return (spark.read.parquet(good).select(*columns, F.lit(None).cast("string").alias("reject_reason"))
            .unionByName(spark.read.parquet(dead).select(*columns, "reject_reason")))


def dead_letter_replay(spark, sf_dir):
    """T7, dead letters come back: the dirty envelope is ingested, its dead letters are repaired (an id from the
    row's offset, a name cut to its limit) and replayed, twice; each is stored once, with its lineage."""
    from eventlake.sinks import ingest as I
    root = scratch_path(spark, "replay")
    I.ingest(X.env_dirty(_events(spark, sf_dir)), None, root)

    def repair(dead):
        own = F.regexp_replace(F.md5(X.source_id().cast("string")), E.UUID_GROUPS, "$1-$2-$3-$4-$5")
        return (dead.withColumn("UUID", F.coalesce("UUID", own))
                .withColumn("Name", F.substring("Name", 1, K.NAME_MAX_CHARS)))

    I.replay_dead(spark, root, repair)
    I.replay_dead(spark, root, repair)
    return I.with_lineage(spark, root).select("UUID", "Name", _us().alias("Timestamp_us"),
                                              F.col("lineage").isNotNull().alias("repaired"))


def sink_table(spark, sf_dir):
    """K4: the target table created if absent (twice: the second call is a no-op), the
    envelope inserted, and the catalog table read back."""
    import uuid as _uuid
    name = f"xe_data_{_uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "table")
    K.ensure_table(spark, name, path)
    K.ensure_table(spark, name, path)
    target = spark.table(name)
    K.with_event_date(_env(spark, sf_dir)).select(*target.columns).write.insertInto(name)
    back = spark.table(name)
    return back.select("UUID", "Name", _us().alias("Timestamp_us"), _day_text("event_date").alias("event_date"))


# The sink section of the options query (batch size and codec as documented).
SINK_SECTIONS = {"ClickHouse": {"BatchSize": 1000, "Compression": "GZip"}, "Postgres": None, "Kafka": None}


def sink_options(spark, sf_dir):
    """The sink chosen from configuration sections (exactly one present), its
    compression and batch size (rows per file) applied to a write of the whole envelope;
    the table read back."""
    kind, opts = K.sink_from_config(SINK_SECTIONS)
    path = scratch_path(spark, f"sink-{kind}")
    K.write_sorted(_env(spark, sf_dir), path, compression=opts["compression"],
                   batch_size=int(opts["maxRecordsPerFile"]))
    return spark.read.parquet(path).select("UUID", "Name", _us().alias("Timestamp_us"))


def kafka_payload(spark, sf_dir):
    """K3: message key and value per event."""
    msgs = K.kafka_payload(_env(spark, sf_dir))
    return msgs.select(F.col("key").isNull().alias("key_is_null"),
                       F.col("value").cast("string").alias("value"))


def kafka_roundtrip(spark, sf_dir):
    """Messages decoded back into the envelope (text form for comparison)."""
    decoded = S.decode_value(K.kafka_payload(_env(spark, sf_dir)))
    return to_text(decoded)


def kafka_dirty(spark, sf_dir):
    """S2 on a topic that holds more than events: messages without JSON, of another shape, empty or cut off keep
    their text and get a reason; the others decode."""
    messages = K.kafka_payload(_env(spark, sf_dir))
    text = F.col("value").cast("string")
    own = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    value = (F.when(own % 31 == 0, F.concat(F.lit("not json "), F.md5(text))).when(own % 29 == 0, F.lit("[1, 2]"))
             .when(own % 23 == 0, F.lit("")).when(own % 19 == 0, F.substring(text, 1, 40)).otherwise(text))
    decoded = S.decode_value(messages.select("key", value.cast("binary").alias("value")))
    return K.label_valid(decoded).select("UUID", F.col(S.CORRUPT_COLUMN).alias("corrupt"), "reject_reason")


def day_partition(spark, sf_dir):
    """K5: the day partitions the envelope needs, with names and ranges."""
    env = _env(spark, sf_dir)
    parts = env.select(K.day_partition("Timestamp").alias("p")).select("p.*").distinct()
    return parts.select(_day_text("event_date").alias("event_date"), "partition_name",
                        _day_text("range_start").alias("range_start"),
                        _day_text("range_end").alias("range_end"))


def dedup_key(spark, sf_dir):
    """K6 over the envelope with replayed events."""
    out = K.dedup_key(X.env_dup(_events(spark, sf_dir)))
    return out.select("UUID", _us().alias("Timestamp_us"), F.to_json("Fields").alias("Fields"))


def constraint_split(spark, sf_dir):
    """Every row of the dirty envelope with its reject reason (NULL = good)."""
    labelled = K.label_valid(X.env_dirty(_events(spark, sf_dir)))
    return labelled.select("UUID", F.char_length("Name").alias("name_chars"),
                           _us().alias("Timestamp_us"), "reject_reason")


def ordered_by_uuid(spark, sf_dir):
    """A stored table read back in UUID order."""
    path = scratch_path(spark, "ordered")
    K.write_sorted(C.capture(_env(spark, sf_dir), STANDARD_SPECS), path)
    return S.read_ordered(spark, path).select("UUID", "Name", _us().alias("Timestamp_us"))


# --- streaming -----------------------------------------------------------------------------------

def _event_stream(spark, sf_dir):
    ensure_utc(spark)
    schema = X.read_table(spark, sf_dir, "events", spread=False).schema
    # a file or a folder of part files; batches are cut by bytes, not by files
    return (spark.readStream.schema(schema).options(**T.rate_options(max_bytes=str(64 << 30)))
            .parquet(f"{sf_dir.rstrip('/')}/events.parquet*"))


def stream_ingest(spark, sf_dir):
    """S1 + T1/T3/T4/T5/T7: the streaming job drained with availableNow; the good
    rows read back.  Equal to ``capture_session``."""
    good, dead, ckpt = (scratch_path(spark, n) for n in ("good", "dead", "ckpt"))
    q = T.run(X.envelope_from_events(_event_stream(spark, sf_dir)), STANDARD_SPECS,
              good, dead, ckpt, watermark=None)
    T.drain(q)
    return to_text(spark.read.parquet(good).drop("batch_id", "event_date"))


# The two deliveries of the restart query overlap by one day.
RESTART_SPLIT = ("2024-01-16", "2024-01-15")


def stream_restart(spark, sf_dir):
    """T5: two deliveries (split in time, overlapping by a day) landed one after the other;
    the stream stops after the first and restarts from its checkpoint for the second.
    Nothing is lost and the replayed day is not stored twice."""
    env = _env(spark, sf_dir)
    landing, good, dead, ckpt = (scratch_path(spark, n) for n in ("landing", "good", "dead", "ckpt"))
    first_before, second_from = RESTART_SPLIT
    early = F.col("Timestamp").isNull() | (F.col("Timestamp") < F.lit(first_before).cast("timestamp"))
    env.filter(early).write.parquet(landing + "/d1")
    src = S.read_event_stream(spark, landing, options={"recursiveFileLookup": "true"})
    T.drain(T.run(src, None, good, dead, ckpt))
    env.filter(F.col("Timestamp") >= F.lit(second_from).cast("timestamp")).write.parquet(landing + "/d2")
    T.drain(T.run(src, None, good, dead, ckpt))                         # restart, same checkpoint
    return to_text(spark.read.parquet(good).drop("batch_id", "event_date"))


def stream_keep_late(spark, sf_dir):
    """T6, late rows kept: the newer half of the events lands first, then the older half
    (late, overlapping by a day).  Each batch is deduplicated against the stored days it
    touches instead of a watermark, so every event is stored exactly once."""
    env = _env(spark, sf_dir)
    landing, good, dead, ckpt = (scratch_path(spark, n) for n in ("landing", "good", "dead", "ckpt"))
    newer_from, older_before = RESTART_SPLIT[1], RESTART_SPLIT[0]
    env.filter(F.col("Timestamp") >= F.lit(newer_from).cast("timestamp")).write.parquet(landing + "/d1")
    src = S.read_event_stream(spark, landing, options={"recursiveFileLookup": "true"})
    T.drain(T.run(src, None, good, dead, ckpt, watermark=None, keep_late=True,
                  state_partitions=_slots(spark)))
    early = F.col("Timestamp").isNull() | (F.col("Timestamp") < F.lit(older_before).cast("timestamp"))
    env.filter(early).write.parquet(landing + "/d2")
    T.drain(T.run(src, None, good, dead, ckpt, watermark=None, keep_late=True,
                  state_partitions=_slots(spark)))
    return to_text(spark.read.parquet(good).drop("batch_id", "event_date"))


def stream_dedup(spark, sf_dir):
    """Replays removed by the streaming job, which deduplicates each batch against the stored
    days: no watermark, so nothing is lost whatever the data's span and order."""
    src = _event_stream(spark, sf_dir)
    dup = X.envelope_from_events(src).unionByName(
        X.envelope_from_events(src.filter(F.col("event_id") % 10 == 0)))
    path, dead, ckpt = (scratch_path(spark, n) for n in ("stream-dedup", "dead", "ckpt"))
    T.drain(T.run(dup, None, path, dead, ckpt))
    back = spark.read.parquet(path)
    return back.select("UUID", _us().alias("Timestamp_us"), F.to_json("Fields").alias("Fields"))


def stream_state_dedup(spark, sf_dir):
    """T6 in keyed state: the envelope lands in files that are in no order of time, a tenth of it twice; each
    first arrival is stored, and no batch reads the target."""
    env = X.env_dup(_events(spark, sf_dir))
    landing, good, dead, ckpt = (scratch_path(spark, n) for n in ("landing", "good", "dead", "ckpt"))
    env.repartition(6).write.parquet(landing)
    src = S.read_event_stream(spark, landing, options=T.rate_options(max_files=2))
    from eventlake.streaming import state
    T.drain(state.run_state_dedup(src, None, good, dead, ckpt, horizon="60 days", buckets=1,
                                  state_partitions=_slots(spark)))
    return spark.read.parquet(good).select("UUID", _us().alias("Timestamp_us"), F.to_json("Fields").alias("Fields"))


def alert_transitions(spark, sf_dir):
    """A3, alerts that fire once: where each kind's slow events an hour cross the threshold and where they
    recover, judged when the watermark passes an hour's end."""
    from eventlake.streaming import state
    changes = state.alert_transitions(X.envelope_from_events(_event_stream(spark, sf_dir)), min_slow=3)
    root, ckpt = scratch_path(spark, "alert-changes"), scratch_path(spark, "ckpt")
    T.drain(state.run_alerts(changes, root, ckpt, state_partitions=_slots(spark)))
    return spark.read.schema(changes.schema).parquet(root).select(
        "Name", (F.col("window_ms") * 1000).alias("window_start_us"), "state", "n_slow")


def _stream_agg(spark, sf_dir, build, keys, label):
    """Streaming A2/A3/A8: an update-mode aggregate drained with availableNow, then the
    latest version of every group read back (equals the batch result, in whatever order the
    files come: there is no watermark here; an endless stream sets one to bound its state)."""
    env = X.envelope_from_events(_event_stream(spark, sf_dir))
    agg = build(env)
    flat = agg.select(F.col("window.start").alias("window_start"),
                      *[c for c in agg.columns if c != "window"])
    root, ckpt = scratch_path(spark, label), scratch_path(spark, "ckpt")
    T.drain(T.run_aggregate(flat, root, ckpt, state_partitions=_slots(spark)))
    out = T.latest_versions(spark, root, ["window_start", *keys])
    return out.select(F.unix_micros("window_start").alias("window_start_us"),
                      *[c for c in out.columns if c != "window_start"])


def hourly_stats_stream(spark, sf_dir):
    """A2 on a stream."""
    return _stream_agg(spark, sf_dir, A.windowed_stats, ["Name"], "hourly-stream")


def aggregate_two_checkpoints(spark, sf_dir):
    """T5 for aggregate logs: two streams with checkpoints of their own, over one half of the events each, write
    their windows to one log; both are in it, and their newest versions are merged."""
    root = scratch_path(spark, "two-checkpoints")
    for half in (0, 1):
        src = _event_stream(spark, sf_dir)
        agg = A.windowed_stats(X.envelope_from_events(src.filter(F.col("event_id") % 2 == half)))
        flat = agg.select(F.col("window.start").alias("window_start"), "Name", "n_events", "sum_duration", "max_duration")
        T.drain(T.run_aggregate(flat, root, scratch_path(spark, "ckpt"), state_partitions=_slots(spark)))
    out = T.latest_versions(spark, root, ["window_start", "Name"],
                            across={"n_events": "sum", "sum_duration": "sum", "max_duration": "max"})
    return out.select(F.unix_micros("window_start").alias("window_start_us"), *[c for c in out.columns if c != "window_start"])


def alert_windows_stream(spark, sf_dir):
    """A3 on a stream."""
    return _stream_agg(spark, sf_dir, lambda e: A.alerts(e, min_slow=3), ["Name"], "alerts-stream")


def failure_bursts_stream(spark, sf_dir):
    """A8 on a stream."""
    return _stream_agg(spark, sf_dir, lambda e: A.failure_bursts(e, min_failures=3, every="1 day"),
                       ["username"], "bursts-stream")


# --- verification --------------------------------------------------------------------------------

def distinct_events(spark, sf_dir):
    """V1 over the envelope with replayed events."""
    return to_text(V.distinct_events(X.env_dup(_events(spark, sf_dir))))


def event_hash(spark, sf_dir):
    """V2."""
    return _env(spark, sf_dir).select("UUID", V.event_hash().alias("event_hash"))


def event_digest(spark, sf_dir):
    """V2 over the dirty envelope, where ids are NULL in some rows."""
    return X.env_dirty(_events(spark, sf_dir)).select("XEventStartOffsetInBytes", V.event_digest().alias("event_digest"))


def count_events(spark, sf_dir):
    """V3: captured rows per kind against the count expected from the source table."""
    ev = _events(spark, sf_dir)
    expected = (ev.filter(F.col("event_type").isin("error", "click")
                          & (F.round(F.col("value") * X.DURATION_SCALE).cast("bigint") >= 5000000))
                .groupBy(F.col("event_type").alias("Name")).agg(F.count(F.lit(1)).alias("expected")))
    captured = C.capture(X.envelope_from_events(ev), STANDARD_SPECS)
    return V.count_gate(captured, expected)


def reconcile_missing(spark, sf_dir):
    """V3 that names the rows: a sink that lost some events, holds some that the source never sent and some
    twice is compared with the source through lookup tables per kind and hour."""
    from eventlake.operators.reconcile import reconcile
    source = _env(spark, sf_dir)
    eid = X.source_id()
    sink = source.filter(eid % 97 != 5)
    strange = source.filter(eid % 211 == 7).withColumn("UUID", E.uuid_text(F.md5(F.concat(F.lit("x"), "UUID"))))
    found = reconcile(source, sink.unionByName(strange).unionByName(sink.filter(eid % 307 == 9)))
    return found.select("Name", "UUID", _us().alias("Timestamp_us"), "side", "copies")


def all_match_regex(spark, sf_dir):
    """V4: every statement text matches the pattern."""
    env = _env(spark, sf_dir)
    return V.all_match(env, field("Fields", "statement"), STATEMENT_PATTERN)


# --- analytics -----------------------------------------------------------------------------------

def slow_queries(spark, sf_dir):
    """A1."""
    out = A.slow_queries(_env(spark, sf_dir))
    return out.select("UUID", "Name", _us().alias("Timestamp_us"), "duration", "query_hash",
                      "client_app_name", "database_name", "username")


def _window_us(df):
    return df.select(F.unix_micros(F.col("window.start")).alias("window_start_us"),
                     *[c for c in df.columns if c != "window"])


def hourly_stats(spark, sf_dir):
    """A2."""
    return _window_us(A.windowed_stats(_env(spark, sf_dir)))


def alert_windows(spark, sf_dir):
    """A3."""
    return _window_us(A.alerts(_env(spark, sf_dir), min_slow=3))


def query_hash_stats(spark, sf_dir):
    """A4 over the captured session (flagship)."""
    return A.query_hash_stats(C.capture(_env(spark, sf_dir), STANDARD_SPECS))


def query_hash_regression(spark, sf_dir):
    """A5."""
    out = A.regressions(_env(spark, sf_dir), min_ratio=1.5)
    return out.select("query_hash", _day_text("day").alias("day"), _day_text("prev_day").alias("prev_day"),
                      "mean_duration", "prev_mean_duration", "ratio")


def workload_by_hour(spark, sf_dir):
    """A6."""
    return A.workload(_env(spark, sf_dir))


def audit_log(spark, sf_dir):
    """A7."""
    out = A.audit_log(_env(spark, sf_dir))
    return out.select("UUID", "Name", _us().alias("Timestamp_us"), _day_text("event_date").alias("event_date"),
                      *A.AUDIT_COLUMNS)


def audit_table(spark, sf_dir):
    """A7 as a table: the audit log appended to its day partitions (K2), some days of it read back."""
    path = scratch_path(spark, "audit")
    K.write_daily(A.audit_log(_env(spark, sf_dir)), path)
    back = spark.read.parquet(path).filter(F.col("event_date").between("2024-01-10", "2024-01-12"))
    return back.select("UUID", "Name", _us().alias("Timestamp_us"), _day_text("event_date").alias("event_date"), *A.AUDIT_COLUMNS)


def failure_bursts(spark, sf_dir):
    """A8."""
    return _window_us(A.failure_bursts(_env(spark, sf_dir), min_failures=3, every="1 day"))


def capacity_daily(spark, sf_dir):
    """A9."""
    out = A.capacity_daily(_env(spark, sf_dir))
    return out.withColumn("day", _day_text("day"))


def capacity_daily_approx(spark, sf_dir):
    """A9 with the mergeable sketch instead of radix selection (one aggregation, no
    materialised counts); exact while a group holds fewer rows than the accuracy."""
    out = A.capacity_daily(_env(spark, sf_dir), exact=False)
    return out.withColumn("day", _day_text("day"))


def capacity_rollup(spark, sf_dir):
    """A9 by stored sketches: each day's are stored, merged to the whole span per database, and their percentiles
    held against their exact ranks: within the stated error or not."""
    from eventlake.operators import sketches as Q
    env = _env(spark, sf_dir)
    path = scratch_path(spark, "capacity-sketches")
    Q.capacity_sketches(env).write.partitionBy("day").parquet(path)
    merged = Q.with_percentiles(Q.rollup(spark.read.parquet(path), ["database_name"]))
    checked = Q.rank_errors(env, merged, ["database_name"])
    return checked.select("database_name", "n_events", "sum_duration", "total_bytes",
                          *[(F.col(f"{p}_error") <= Q.rank_error()).alias(f"{p}_within") for p in ("p50", "p95", "p99")])


QUERIES: dict[str, Query] = {
    "envelope_project": envelope_project,
    "field_get": field_get,
    "filter_name": filter_name,
    "filter_predicate": filter_predicate,
    "filter_predicate_dirty": filter_predicate_dirty,
    "project_actions": project_actions,
    "project_optional_fields": project_optional_fields,
    "capture_session": capture_session,
    "drop_null_events": drop_null_events,
    "fields_json": fields_json,
    "event_json": event_json,
    "typed_values": typed_values,
    "ts_epoch_seconds": ts_epoch_seconds,
    "ts_micros": ts_micros,
    "ts_iso": ts_iso,
    "ts_utc": ts_utc,
    "uuid_canonical": uuid_canonical,
    "encoded_bytes": encoded_bytes,
    "bytes_base64": bytes_base64,
    "parse_payload": parse_payload,
    "sink_sorted": sink_sorted,
    "sorted_merge": sorted_merge,
    "sink_daily": sink_daily,
    "sink_ingest": sink_ingest,
    "ingest_twice": ingest_twice,
    "ingest_captured_dirty": ingest_captured_dirty,
    "dead_letter_replay": dead_letter_replay,
    "sink_table": sink_table,
    "sink_options": sink_options,
    "kafka_payload": kafka_payload,
    "kafka_roundtrip": kafka_roundtrip,
    "kafka_dirty": kafka_dirty,
    "day_partition": day_partition,
    "dedup_key": dedup_key,
    "constraint_split": constraint_split,
    "ordered_by_uuid": ordered_by_uuid,
    "stream_ingest": stream_ingest,
    "stream_dedup": stream_dedup,
    "stream_dead_letter": stream_dead_letter,
    "stream_restart": stream_restart,
    "stream_keep_late": stream_keep_late,
    "stream_state_dedup": stream_state_dedup,
    "alert_transitions": alert_transitions,
    "hourly_stats_stream": hourly_stats_stream,
    "alert_windows_stream": alert_windows_stream,
    "aggregate_two_checkpoints": aggregate_two_checkpoints,
    "failure_bursts_stream": failure_bursts_stream,
    "distinct_events": distinct_events,
    "event_hash": event_hash,
    "event_digest": event_digest,
    "count_events": count_events,
    "reconcile_missing": reconcile_missing,
    "all_match_regex": all_match_regex,
    "slow_queries": slow_queries,
    "hourly_stats": hourly_stats,
    "alert_windows": alert_windows,
    "query_hash_stats": query_hash_stats,
    "query_hash_regression": query_hash_regression,
    "workload_by_hour": workload_by_hour,
    "audit_log": audit_log,
    "audit_table": audit_table,
    "failure_bursts": failure_bursts,
    "capacity_daily": capacity_daily,
    "capacity_daily_approx": capacity_daily_approx,
    "capacity_rollup": capacity_rollup,
}
