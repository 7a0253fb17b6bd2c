"""DuckDB oracles: for each registered query, the same result written as plain SQL
over the given tables (``events`` is registered as a view by the checker).

The envelope is rebuilt here independently: payload columns stay typed and are
rendered to JSON with ``json_object`` in alphabetical key order (the canonical
form Spark's ``to_json(variant)`` produces).
"""

from __future__ import annotations

# The envelope of the given `events` table, written for DuckDB.
ENV_CTE = r"""
env AS (
  SELECT event_id, ts, user_id, value, props,
         regexp_replace(md5(CAST(event_id AS VARCHAR)),
                        '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') AS UUID,
         event_type AS Name,
         epoch_us(ts) AS ts_us,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ts_iso,
         event_id * 1024 AS XEventStartOffsetInBytes,
         event_id * 1024 + 64 + strlen(event_type) + strlen(props) AS XEventEndOffsetInBytes,
         CAST(64 + strlen(event_type) + strlen(props) AS BIGINT) AS XEventSizeInBytes,
         'app' || (user_id % 7) AS client_app_name,
         'host' || (user_id % 11) AS client_hostname,
         'db' || (user_id % 3) AS database_name,
         user_id % 20 AS query_hash,
         'u' || user_id AS username,
         CAST(round(value * 100000) AS BIGINT) AS duration,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         'stmt ' || event_type || ' ' || json_extract_string(props, '$.k') AS statement
  FROM events
),
envj AS (
  SELECT *,
         CAST(json_object('client_app_name', client_app_name, 'client_hostname', client_hostname,
                          'database_name', database_name, 'query_hash', query_hash,
                          'username', username) AS VARCHAR) AS actions_json,
         CAST(json_object('duration', duration, 'k', k, 'note', NULL,
                          'statement', statement) AS VARCHAR) AS fields_json
  FROM env
)
"""

CAPTURED = "Name IN ('error', 'click') AND duration >= 5000000"
CAPTURED_ACTIONS = "CAST(json_object('query_hash', query_hash, 'username', username) AS VARCHAR)"
CAPTURED_FIELDS = "CAST(json_object('duration', duration, 'k', k, 'note', NULL) AS VARCHAR)"
EVENT_JSON = ("CAST(json_object('UUID', UUID, 'Name', Name, 'Timestamp', ts_iso, "
              "'XEventStartOffsetInBytes', XEventStartOffsetInBytes, "
              "'XEventEndOffsetInBytes', XEventEndOffsetInBytes, "
              "'XEventSizeInBytes', XEventSizeInBytes, "
              "'Actions', json(actions_json), 'Fields', json(fields_json)) AS VARCHAR)")
TEXT_ENVELOPE = ("SELECT UUID, Name, ts_iso AS Timestamp, XEventStartOffsetInBytes, "
                 "XEventEndOffsetInBytes, XEventSizeInBytes, actions_json AS Actions, "
                 "fields_json AS Fields FROM envj")
CAPTURE_TEXT = (f"SELECT UUID, Name, ts_iso AS Timestamp, XEventStartOffsetInBytes, "
                f"XEventEndOffsetInBytes, XEventSizeInBytes, {CAPTURED_ACTIONS} AS Actions, "
                f"{CAPTURED_FIELDS} AS Fields FROM env WHERE {CAPTURED}")
DEDUP = "SELECT UUID, ts_us AS Timestamp_us, fields_json AS Fields FROM envj"
STATEMENT_PATTERN = r"^stmt (click|error|purchase|signup|view) [0-9]+$"


def _q(body: str) -> str:
    return f"WITH {ENV_CTE}\n{body}"


BODIES: dict[str, str] = {
    "envelope_project": TEXT_ENVELOPE,
    "field_get": ("SELECT UUID, duration, k, statement, CAST(NULL AS VARCHAR) AS note, "
                  "CAST(NULL AS BIGINT) AS missing, query_hash, username FROM env"),
    "filter_name": "SELECT UUID, Name, ts_us AS Timestamp_us FROM env WHERE Name IN ('error', 'click')",
    "filter_predicate": "SELECT UUID, Name, duration FROM env WHERE duration >= 5000000",
    "project_actions": f"SELECT UUID, {CAPTURED_ACTIONS} AS Actions FROM env",
    "project_optional_fields": f"SELECT UUID, {CAPTURED_FIELDS} AS Fields FROM env",
    "capture_session": CAPTURE_TEXT,
    "drop_null_events": ("SELECT UUID, CASE WHEN event_id % 101 = 0 THEN repeat('x', 256) ELSE Name END AS Name "
                         "FROM env WHERE event_id % 97 <> 0"),
    "fields_json": "SELECT UUID, actions_json, fields_json FROM envj",
    "event_json": f"SELECT UUID, {EVENT_JSON} AS event_json FROM envj",
    "typed_values": r"""SELECT event_id, CAST(json_object(
            't_binary', base64(unhex(substr(md5(Name), 1, 8))),
            't_bool', event_id % 2 = 0,
            't_byte', CAST(user_id % 128 AS TINYINT),
            't_decimal', CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR),
            't_double', value,
            't_float', CAST((event_id % 64) + 0.5 AS FLOAT),
            't_guid', regexp_replace(md5(props), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5'),
            't_int', CAST(event_id AS INTEGER),
            't_long', event_id * 1000000007,
            't_null', NULL,
            't_short', CAST(-(user_id % 32768) AS SMALLINT),
            't_string', 'say "hi"' || chr(10) || Name || ' ü€',
            't_timestamp', ts_iso,
            't_uint', 4294967295 - event_id,
            't_ulong', CAST(18446744073709551615 AS HUGEINT) - event_id,
            't_ushort', CAST(user_id * 400 % 65536 AS INTEGER)) AS VARCHAR) AS payload_json
        FROM env""",
    "ts_epoch_seconds": ("SELECT UUID, ts_us // 1000000 AS epoch_seconds, "
                         "epoch_us(date_trunc('second', ts)) AS second_us FROM env"),
    "ts_micros": "SELECT UUID, ts_us - 946684800000000 AS micros_2000 FROM env",
    "ts_iso": "SELECT UUID, ts_iso FROM env",
    "ts_utc": ("SELECT UUID, strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+03:00' AS ts_text, "
               "ts_us AS Timestamp_us FROM env"),
    "uuid_canonical": ("SELECT UUID, UUID AS from_braced, UUID AS from_bare, "
                       "upper(replace(UUID, '-', '')) AS bytes_hex FROM env"),
    "encoded_bytes": ("SELECT Name, epoch_us(date_trunc('hour', ts)) AS hour_us, count(*) AS n_events, "
                      "CAST(sum(strlen(Name)) AS BIGINT) AS name_bytes, "
                      "CAST(sum(84 + strlen(Name) + strlen(actions_json) + strlen(fields_json)) AS BIGINT) "
                      "AS relational_bytes, "
                      "CAST(sum(59 + strlen(Name) + strlen(actions_json) + strlen(fields_json)) AS BIGINT) "
                      "AS sorted_bytes FROM envj GROUP BY Name, date_trunc('hour', ts)"),
    "bytes_base64": "SELECT UUID, base64(unhex(replace(UUID, '-', ''))) AS uuid_base64 FROM env",
    "parse_payload": ("SELECT UUID, CASE WHEN event_id % 19 = 0 THEN NULL "
                      "WHEN event_id % 17 = 0 OR event_id % 13 = 0 THEN '{}' ELSE fields_json END AS fields_json, "
                      "event_id % 19 = 0 AS dead_letter FROM envj"),
    "sink_sorted": CAPTURE_TEXT,
    "sink_daily": ("SELECT UUID, Name, ts_us AS Timestamp_us, strftime(ts, '%Y-%m-%d') AS event_date FROM env"),
    "sink_ingest": ("SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE UUID END AS UUID, "
                    "CASE WHEN event_id % 97 <> 0 AND event_id % 101 = 0 THEN repeat('x', 256) ELSE Name END AS Name, "
                    "ts_us AS Timestamp_us, "
                    "CASE WHEN event_id % 97 = 0 THEN 'UUID is null' "
                    "WHEN event_id % 101 = 0 THEN 'Name longer than 255' END AS reject_reason FROM env"),
    "kafka_payload": f"SELECT true AS key_is_null, {EVENT_JSON} AS value FROM envj",
    "kafka_roundtrip": TEXT_ENVELOPE,
    "day_partition": ("SELECT DISTINCT strftime(d, '%Y-%m-%d') AS event_date, "
                      "'xe_data_y' || year(d) || 'm' || month(d) || 'd' || day(d) AS partition_name, "
                      "strftime(d, '%Y-%m-%d') AS range_start, "
                      "strftime(d + INTERVAL 1 DAY, '%Y-%m-%d') AS range_end "
                      "FROM (SELECT CAST(ts AS DATE) AS d FROM env)"),
    "dedup_key": DEDUP,
    "constraint_split": ("SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE UUID END AS UUID, "
                         "CAST(CASE WHEN event_id % 97 <> 0 AND event_id % 101 = 0 THEN 256 ELSE length(Name) END "
                         "AS INTEGER) AS name_chars, ts_us AS Timestamp_us, "
                         "CASE WHEN event_id % 97 = 0 THEN 'UUID is null' "
                         "WHEN event_id % 101 = 0 THEN 'Name longer than 255' END AS reject_reason FROM env"),
    "ordered_by_uuid": f"SELECT UUID, Name, ts_us AS Timestamp_us FROM env WHERE {CAPTURED}",
    "stream_ingest": CAPTURE_TEXT,
    "stream_dedup": DEDUP,
    "distinct_events": TEXT_ENVELOPE,
    "event_hash": ("SELECT UUID, md5(concat_ws('|', UUID, Name, CAST(ts_us AS VARCHAR), "
                   "CAST(XEventStartOffsetInBytes AS VARCHAR), CAST(XEventEndOffsetInBytes AS VARCHAR), "
                   "CAST(XEventSizeInBytes AS VARCHAR), actions_json, fields_json)) AS event_hash FROM envj"),
    "count_events": (f"""SELECT coalesce(a.Name, x.Name) AS Name, coalesce(a.arrived, 0) AS arrived,
               coalesce(x.expected, 0) AS expected,
               coalesce(a.arrived, 0) = coalesce(x.expected, 0) AS ok
        FROM (SELECT Name, count(*) AS arrived FROM env WHERE {CAPTURED} GROUP BY Name) a
        FULL OUTER JOIN (SELECT event_type AS Name, count(*) AS expected FROM events
                         WHERE event_type IN ('error', 'click')
                           AND CAST(round(value * 100000) AS BIGINT) >= 5000000
                         GROUP BY event_type) x ON a.Name = x.Name"""),
    "all_match_regex": (f"SELECT count(*) AS n_rows, "
                        f"CAST(sum(CASE WHEN regexp_matches(statement, '{STATEMENT_PATTERN}') THEN 1 ELSE 0 END) "
                        f"AS BIGINT) AS n_matching, "
                        f"coalesce(bool_and(coalesce(regexp_matches(statement, '{STATEMENT_PATTERN}'), false)), true) "
                        f"AS all_match FROM env"),
    "slow_queries": ("SELECT UUID, Name, ts_us AS Timestamp_us, duration, query_hash, client_app_name, "
                     "database_name, username FROM env WHERE duration >= 5000000"),
    "hourly_stats": ("SELECT epoch_us(date_trunc('hour', ts)) AS window_start_us, Name, count(*) AS n_events, "
                     "CAST(sum(duration) AS BIGINT) AS sum_duration, max(duration) AS max_duration "
                     "FROM env GROUP BY date_trunc('hour', ts), Name"),
    "alert_windows": ("SELECT epoch_us(date_trunc('hour', ts)) AS window_start_us, Name, count(*) AS n_slow, "
                      "max(duration) AS max_duration FROM env WHERE duration >= 5000000 "
                      "GROUP BY date_trunc('hour', ts), Name HAVING count(*) >= 3"),
    "query_hash_stats": (f"SELECT query_hash, count(*) AS executions, CAST(sum(duration) AS BIGINT) AS sum_duration, "
                         f"min(duration) AS min_duration, max(duration) AS max_duration, "
                         f"CAST(sum(duration) AS DOUBLE) / count(duration) AS avg_duration "
                         f"FROM env WHERE {CAPTURED} GROUP BY query_hash"),
    "query_hash_regression": """
        daily AS (SELECT query_hash, CAST(ts AS DATE) AS day,
                         CAST(sum(duration) AS DOUBLE) / count(duration) AS mean_duration
                  FROM env GROUP BY query_hash, CAST(ts AS DATE)),
        lagged AS (SELECT *, lag(day) OVER w AS prev_day, lag(mean_duration) OVER w AS prev_mean_duration
                   FROM daily WINDOW w AS (PARTITION BY query_hash ORDER BY day))
        SELECT query_hash, strftime(day, '%Y-%m-%d') AS day, strftime(prev_day, '%Y-%m-%d') AS prev_day,
               mean_duration, prev_mean_duration, mean_duration / prev_mean_duration AS ratio
        FROM lagged WHERE mean_duration / prev_mean_duration >= 1.5""",
    "workload_by_hour": ("SELECT client_app_name, CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS n_events, "
                         "count(DISTINCT query_hash) AS n_query_hashes FROM env "
                         "GROUP BY client_app_name, hour(ts)"),
    "audit_log": ("SELECT UUID, Name, ts_us AS Timestamp_us, strftime(ts, '%Y-%m-%d') AS event_date, "
                  "username, client_hostname, database_name, client_app_name FROM env "
                  "WHERE Name IN ('signup', 'purchase')"),
    "failure_bursts": ("SELECT username, epoch_us(date_trunc('day', ts)) AS window_start_us, count(*) AS n_failures "
                       "FROM env WHERE Name = 'error' GROUP BY username, date_trunc('day', ts) "
                       "HAVING count(*) >= 3"),
    "capacity_daily": """
        b AS (SELECT CAST(ts AS DATE) AS day, database_name, duration,
                     84 + strlen(Name) + strlen(actions_json) + strlen(fields_json) AS row_bytes FROM envj),
        r AS (SELECT *, row_number() OVER (PARTITION BY day, database_name ORDER BY duration) AS rn,
                     count(*) OVER (PARTITION BY day, database_name) AS n FROM b)
        SELECT strftime(day, '%Y-%m-%d') AS day, database_name, count(*) AS n_events,
               CAST(sum(duration) AS BIGINT) AS sum_duration,
               min(duration) FILTER (WHERE rn >= ceil(CAST(0.5 AS DOUBLE) * n)) AS p50_duration,
               min(duration) FILTER (WHERE rn >= ceil(CAST(0.95 AS DOUBLE) * n)) AS p95_duration,
               min(duration) FILTER (WHERE rn >= ceil(CAST(0.99 AS DOUBLE) * n)) AS p99_duration,
               CAST(sum(row_bytes) AS BIGINT) AS total_bytes
        FROM r GROUP BY day, database_name""",
}

BODIES["capacity_daily_approx"] = BODIES["capacity_daily"]
BODIES["stream_state_dedup"] = DEDUP
# windows are judged once the watermark, 30 seconds behind the newest event in milliseconds, passes their end
BODIES["alert_transitions"] = """
        w AS (SELECT Name, epoch_us(date_trunc('hour', ts)) AS h, count(*) FILTER (WHERE duration >= 5000000) AS n
              FROM env GROUP BY Name, date_trunc('hour', ts)),
        mark AS (SELECT max(ts_us) // 1000 * 1000 - 30000000 AS wm FROM env),
        high AS (SELECT Name, h, n, lag(h) OVER k AS prev, lead(h) OVER k AS next FROM w, mark
                 WHERE n >= 3 AND h + 3600000000 <= wm WINDOW k AS (PARTITION BY Name ORDER BY h))
        SELECT Name, h AS window_start_us, 'raised' AS state, n AS n_slow FROM high
        WHERE prev IS NULL OR h - prev > 3600000000
        UNION ALL
        SELECT high.Name, high.h + 3600000000, 'cleared', coalesce(w.n, 0) FROM high
        JOIN mark ON high.h + 7200000000 <= wm LEFT JOIN w ON w.Name = high.Name AND w.h = high.h + 3600000000
        WHERE next IS NULL OR next - high.h > 3600000000"""
BODIES["capacity_rollup"] = (
    "SELECT database_name, count(*) AS n_events, CAST(sum(duration) AS BIGINT) AS sum_duration, "
    "CAST(sum(84 + strlen(Name) + strlen(actions_json) + strlen(fields_json)) AS BIGINT) AS total_bytes, "
    "true AS p50_within, true AS p95_within, true AS p99_within FROM envj GROUP BY database_name")
BODIES["reconcile_missing"] = r"""
        SELECT Name, UUID, ts_us AS Timestamp_us, 'lost' AS side, CAST(1 AS BIGINT) AS copies FROM env WHERE event_id % 97 = 5
        UNION ALL
        SELECT Name, regexp_replace(md5('x' || UUID), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5'), ts_us, 'extra', 1
        FROM env WHERE event_id % 211 = 7
        UNION ALL
        SELECT Name, UUID, ts_us, 'extra', 1 FROM env WHERE event_id % 307 = 9 AND event_id % 97 <> 5"""
BODIES["filter_predicate_dirty"] = (
    "SELECT UUID, Name, CASE WHEN event_id % 83 <> 0 AND event_id % 79 = 0 THEN '5000000.5' ELSE CAST(duration AS VARCHAR) END "
    "AS duration FROM env WHERE query_hash IN (1, 2, 3) AND event_id % 89 <> 0 AND CASE WHEN event_id % 83 = 0 THEN duration > 5000000 "
    "WHEN event_id % 79 = 0 THEN true WHEN event_id % 73 = 0 THEN false ELSE duration > 5000000 END")
BODIES["dead_letter_replay"] = (
    "SELECT UUID, CASE WHEN event_id % 97 <> 0 AND event_id % 101 = 0 THEN repeat('x', 255) ELSE Name END AS Name, "
    "ts_us AS Timestamp_us, event_id % 97 = 0 OR event_id % 101 = 0 AS repaired FROM env")
# the seven faults of the landed lines, by the first that the constraints name
FAULTS = """
        faulty AS (SELECT *, CASE WHEN event_id % 67 = 0 THEN 'corrupt record' WHEN event_id % 97 = 0 THEN 'UUID is null'
                 WHEN event_id % 83 = 0 THEN 'Name longer than 255' WHEN event_id % 89 = 0 THEN 'Name is null'
                 WHEN event_id % 79 = 0 THEN 'Timestamp is null or malformed' WHEN event_id % 73 = 0 THEN 'Actions malformed'
                 WHEN event_id % 71 = 0 THEN 'Fields malformed' END AS reject_reason FROM env),
        lines AS (SELECT CASE WHEN event_id % 67 = 0 OR event_id % 97 = 0 THEN NULL ELSE UUID END AS UUID,
                 CASE WHEN event_id % 67 = 0 THEN NULL WHEN event_id % 83 = 0 THEN repeat('x', 256)
                      WHEN event_id % 89 = 0 THEN NULL ELSE Name END AS Name,
                 CASE WHEN event_id % 67 <> 0 AND event_id % 79 <> 0 THEN ts_us END AS Timestamp_us, reject_reason, duration FROM faulty)
"""
BODIES["stream_dead_letter"] = FAULTS + "        SELECT UUID, Name, Timestamp_us, reject_reason FROM lines"
BODIES["ingest_captured_dirty"] = FAULTS + """
        SELECT UUID, Name, Timestamp_us, reject_reason FROM lines
        WHERE reject_reason = 'corrupt record'
           OR reject_reason IS NOT NULL AND (Name IS NULL OR Name IN ('error', 'click') OR length(Name) = 256)
           OR reject_reason IS NULL AND Name IN ('error', 'click') AND duration >= 5000000"""
BODIES["aggregate_two_checkpoints"] = BODIES["hourly_stats"]
BODIES["audit_table"] = BODIES["audit_log"] + " AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"
BODIES["event_digest"] = (
    "SELECT XEventStartOffsetInBytes, md5(" + EVENT_JSON
    .replace("'UUID', UUID", "'UUID', CASE WHEN event_id % 97 = 0 THEN NULL ELSE UUID END")
    .replace("'Name', Name", "'Name', CASE WHEN event_id % 97 <> 0 AND event_id % 101 = 0 THEN repeat('x', 256) ELSE Name END")
    + ") AS event_digest FROM envj")
BODIES["kafka_dirty"] = f""",
        m AS (SELECT UUID, {EVENT_JSON} AS t FROM envj),
        n AS (SELECT *, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) AS own FROM m),
        v AS (SELECT UUID, CASE WHEN own % 31 = 0 THEN 'not json ' || md5(t) WHEN own % 29 = 0 THEN '[1, 2]'
                     WHEN own % 23 = 0 THEN '' WHEN own % 19 = 0 THEN substr(t, 1, 40) END AS bad FROM n)
        SELECT CASE WHEN bad IS NULL THEN UUID END AS UUID, bad AS corrupt,
               CASE WHEN bad IS NOT NULL THEN 'corrupt record' END AS reject_reason FROM v"""[1:]
BODIES["sorted_merge"] = CAPTURE_TEXT
BODIES["ingest_twice"] = BODIES["sink_ingest"]
BODIES["stream_restart"] = TEXT_ENVELOPE
BODIES["stream_keep_late"] = TEXT_ENVELOPE
BODIES["sink_table"] = BODIES["sink_daily"]
BODIES["sink_options"] = "SELECT UUID, Name, ts_us AS Timestamp_us FROM env"
BODIES["hourly_stats_stream"] = BODIES["hourly_stats"]
BODIES["alert_windows_stream"] = BODIES["alert_windows"]
BODIES["failure_bursts_stream"] = BODIES["failure_bursts"]

# bodies that add CTEs of their own continue the WITH list
_CONTINUES = {"kafka_dirty", "stream_dead_letter", "ingest_captured_dirty", "alert_transitions", "query_hash_regression", "capacity_daily", "capacity_daily_approx"}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in BODIES.items():
        if name in _CONTINUES:
            out[name] = f"WITH {ENV_CTE},\n{body}"
        else:
            out[name] = _q(body)
    return out
