"""DuckDB SQL equal to each registered query (views over the driver tables are pre-registered).

The CTEs below restate the fixture derivations of ``sources.fixtures`` in SQL:
R (readings, compressed time), RU (readings, original time), W (window events,
original time), WC (window events, compressed time).
"""

from __future__ import annotations

from sensorlake.sources.fixtures import BASE_MICROS, COMPRESSION

_COMPRESSED = f"make_timestamp({BASE_MICROS} + (epoch_us(ts) - {BASE_MICROS}) // {COMPRESSION})"


def _readings_cte(name: str, ts_expr: str) -> str:
    return f"""{name} AS (
  SELECT *,
         epoch_us(event_timestamp) // 1000000 AS timestamp_epoch,
         COALESCE(temperature_celsius > 40 OR temperature_celsius < -20
                  OR temperature_fahrenheit > 104 OR temperature_fahrenheit < -4, false) AS is_anomaly,
         CASE WHEN temperature_celsius > 40 THEN 'HIGH_TEMP'
              WHEN temperature_celsius < -20 THEN 'LOW_TEMP' ELSE 'NORMAL' END AS anomaly_type
  FROM (SELECT event_id AS reading_id,
               {ts_expr} AS event_timestamp,
               'device_' || CAST(user_id % 10 AS VARCHAR) AS device_id,
               value - 30 AS temperature_celsius,
               (value - 30) * 9 / 5 + 32 + CASE WHEN event_type = 'view' THEN 10 ELSE 0 END
                 AS temperature_fahrenheit,
               props
        FROM events))"""


def _window_cte(name: str, ts_expr: str) -> str:
    return f"""{name} AS (
  SELECT event_id, {ts_expr} AS event_timestamp,
         CAST(user_id AS INTEGER) AS object_code,
         'window_' || CAST(user_id AS VARCHAR) AS object_name,
         CASE WHEN event_type = 'signup' THEN 'opened' ELSE 'closed' END AS event_type
  FROM events WHERE event_type IN ('signup', 'error'))"""


R = _readings_cte("R", _COMPRESSED)
RU = _readings_cte("RU", "ts")
W = _window_cte("W", "ts")
WC = _window_cte("WC", _COMPRESSED)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _bucket(col: str, width_us: int, ends: bool = False) -> str:
    extra = f" + {width_us}" if ends else ""
    return f"make_timestamp((epoch_us({col}) // {width_us}) * {width_us}{extra})"


def _temp_agg(width_us: int, label: str) -> str:
    ws = _bucket("event_timestamp", width_us)
    we = _bucket("event_timestamp", width_us, ends=True)
    return f"""SELECT device_id, {ws} AS window_start, {we} AS window_end,
       '{label}' AS window_duration,
       round(avg(temperature_celsius), 8) AS avg_temp_celsius,
       round(avg(temperature_fahrenheit), 8) AS avg_temp_fahrenheit,
       max(temperature_celsius) AS max_temp_celsius,
       min(temperature_celsius) AS min_temp_celsius,
       count(*) AS reading_count,
       CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count
FROM R GROUP BY ALL"""


def _event_agg(src: str, width_us: int, label: str) -> str:
    ws = _bucket("event_timestamp", width_us)
    we = _bucket("event_timestamp", width_us, ends=True)
    return f"""SELECT object_code, object_name, event_type, {ws} AS window_start,
       {we} AS window_end,
       '{label}' AS aggregation_period, count(*) AS event_count
FROM {src} GROUP BY ALL"""


def _emitted(body: str, src: str, delay: str) -> str:
    """Append-mode output: windows whose end is at or before the final watermark."""
    return f"SELECT * FROM ({body}) a WHERE window_end <= (SELECT max(event_timestamp) FROM {src}) - INTERVAL '{delay}'"


_MIN = 60_000_000
_HOUR = 3_600_000_000
_DAY = 86_400_000_000

_PAIRS = """SELECT o.object_code, o.object_name, o.event_id AS open_id, o.event_timestamp AS opened_at,
       c.event_timestamp AS closed_at
FROM WC o JOIN WC c ON o.object_code = c.object_code AND c.event_timestamp > o.event_timestamp
WHERE o.event_type = 'opened' AND c.event_type = 'closed'"""

_FIRST_CLOSE = f"""SELECT object_code, object_name, opened_at, min(closed_at) AS closed_at
FROM ({_PAIRS}) p GROUP BY object_code, object_name, open_id, opened_at"""

_PATTERN = """CASE WHEN m < 5 THEN 'BRIEF_OPENING' WHEN m < 30 THEN 'SHORT_OPENING'
            WHEN m < 120 THEN 'MEDIUM_OPENING' ELSE 'LONG_OPENING' END"""

_DURATIONS = f"""SELECT *, {_PATTERN} AS usage_pattern, m > 300 AS is_unusual FROM (
  SELECT *, duration_seconds / 60 AS duration_minutes, duration_seconds / 60 AS m FROM (
    SELECT *, epoch_us(closed_at) // 1000000 - epoch_us(opened_at) // 1000000 AS duration_seconds
    FROM ({{src}}) s) s2) s3"""


def _durations(src: str) -> str:
    return (f"SELECT object_code, object_name, opened_at, closed_at, duration_seconds, duration_minutes, "
            f"usage_pattern, is_unusual FROM ({_DURATIONS.format(src=src)}) d")


_READING_COLS = ("reading_id, device_id, event_timestamp, timestamp_epoch, temperature_celsius, "
                 "temperature_fahrenheit, is_anomaly, anomaly_type")

_FANOUT = f"""SELECT object_code, object_name, 'opened' AS event_type,
       date_trunc('second', opened_at) AS event_timestamp FROM ({_FIRST_CLOSE}) f
UNION ALL
SELECT object_code, object_name, 'closed',
       date_trunc('second', CAST(CAST(opened_at AS DATE) AS TIMESTAMP) + (closed_at - date_trunc('day', closed_at)))
FROM ({_FIRST_CLOSE}) g"""

_OFFSETS = """rec AS (SELECT 'iot-temperature' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset", event_id
  FROM events WHERE event_id % 97 <> 0),
twice AS (SELECT * FROM rec UNION ALL SELECT * FROM rec WHERE event_id % 89 = 0),
counted AS (SELECT topic, "partition", "offset", count(*) AS copies,
  lag("offset") OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS before FROM twice GROUP BY topic, "partition", "offset")"""

_LAST_QUARTER = "BETWEEN TIMESTAMP '2024-01-01 09:00:00' AND TIMESTAMP '2024-01-01 12:00:00'"

ORACLE: dict[str, str] = {
    "readings_classified": _with(R) + f"SELECT {_READING_COLS} FROM R",
    "anomaly_alerts": _with(R) + """SELECT reading_id, device_id, event_timestamp, temperature_celsius,
       temperature_fahrenheit, anomaly_type FROM R WHERE is_anomaly""",
    "temp_agg_1min": _with(R) + _temp_agg(_MIN, "1_minute"),
    "temp_agg_5min": _with(R) + _temp_agg(5 * _MIN, "5_minute"),
    "temp_agg_1min_stream": _with(R) + _emitted(_temp_agg(_MIN, "1_minute"), "R", "2 minutes"),
    "temp_agg_5min_stream": _with(R) + _emitted(_temp_agg(5 * _MIN, "5_minute"), "R", "10 minutes"),
    "window_agg_hourly": _with(W) + _event_agg("W", _HOUR, "hourly"),
    "window_agg_daily": _with(W) + _event_agg("W", _DAY, "daily"),
    "window_agg_hourly_stream": _with(W) + _emitted(_event_agg("W", _HOUR, "hourly"), "W", "1 hour"),
    "window_agg_daily_stream": _with(W) + _emitted(_event_agg("W", _DAY, "daily"), "W", "1 day"),
    "window_cycles_first_close": _with(WC) + _durations(_FIRST_CLOSE),
    "window_pair_counts": _with(WC) + f"""SELECT object_code, object_name, usage_pattern,
       count(*) AS pair_count, count(*) FILTER (WHERE is_unusual) AS unusual_count
FROM ({_durations(_PAIRS)}) d GROUP BY ALL""",
    "window_cycles_stream": _with(WC) + f"""SELECT * FROM ({_durations(_FIRST_CLOSE)}) d
WHERE closed_at < make_timestamp((epoch_us((SELECT max(event_timestamp) FROM WC)) // 1000) * 1000)
                  - INTERVAL '10 minutes'""",
    "window_usage_patterns": _with(WC) + f"""SELECT object_code, object_name, usage_pattern,
       count(*) AS cycles, count(*) FILTER (WHERE is_unusual) AS unusual_cycles,
       round(avg(duration_minutes), 6) AS avg_duration_minutes
FROM ({_durations(_FIRST_CLOSE)}) d GROUP BY ALL""",
    "window_cycles_stream_tables": _with(WC) + f"""SELECT * FROM ({_durations(_FIRST_CLOSE)}) d
WHERE closed_at < (SELECT max(event_timestamp) FROM WC) - INTERVAL '10 minutes'""",
    "latest_reading_per_device": _with(R) + """SELECT device_id, temperature_celsius, temperature_fahrenheit,
       event_timestamp, is_anomaly, anomaly_type
FROM R QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY event_timestamp DESC, reading_id DESC) = 1
ORDER BY device_id""",
    "temperature_stats_24h": _with(RU) + f"""SELECT device_id, count(*) AS reading_count,
       round(avg(temperature_celsius), 8) AS avg_temp_celsius,
       min(temperature_celsius) AS min_temp_celsius, max(temperature_celsius) AS max_temp_celsius,
       round(stddev_samp(temperature_celsius), 6) AS stddev_temp_celsius,
       count(CASE WHEN is_anomaly THEN 1 END) AS anomaly_count
FROM RU WHERE event_timestamp > (SELECT max(event_timestamp) FROM RU) - INTERVAL '24 hours'
GROUP BY device_id ORDER BY avg_temp_celsius DESC""",
    "window_activity_7d": _with(W) + """SELECT object_code, object_name, count(*) AS total_events,
       count(CASE WHEN event_type = 'opened' THEN 1 END) AS open_events,
       count(CASE WHEN event_type = 'closed' THEN 1 END) AS close_events,
       date_trunc('day', event_timestamp) AS activity_date
FROM W WHERE event_timestamp > (SELECT max(event_timestamp) FROM W) - INTERVAL '7 days'
GROUP BY object_code, object_name, date_trunc('day', event_timestamp)
ORDER BY activity_date DESC, object_code""",
    "readings_last_hour": _with(R) + """SELECT event_timestamp AS time, temperature_celsius, device_id
FROM R WHERE event_timestamp >= (SELECT max(event_timestamp) FROM R) - INTERVAL '1 hour'
ORDER BY event_timestamp""",
    "anomaly_count_last_hour": _with(R) + """SELECT count(*) AS anomalies_last_hour FROM R
WHERE is_anomaly AND event_timestamp >= (SELECT max(event_timestamp) FROM R) - INTERVAL '1 hour'""",
    "agg_1min_last_2h": _with(R) + f"""SELECT window_start AS time, avg_temp_celsius, device_id
FROM ({_temp_agg(_MIN, '1_minute')}) a
WHERE window_start >= (SELECT max(event_timestamp) FROM R) - INTERVAL '2 hours' ORDER BY window_start""",
    "activity_by_object_24h": _with(W) + """SELECT object_name, count(*) AS event_count FROM W
WHERE event_timestamp >= (SELECT max(event_timestamp) FROM W) - INTERVAL '24 hours'
GROUP BY object_name ORDER BY event_count DESC""",
    "events_by_hour_type_24h": _with(W) + """SELECT date_trunc('hour', event_timestamp) AS time, event_type,
       count(*) AS count FROM W
WHERE event_timestamp >= (SELECT max(event_timestamp) FROM W) - INTERVAL '24 hours'
GROUP BY date_trunc('hour', event_timestamp), event_type ORDER BY time""",
    "newest_5_readings": _with(R) + """SELECT reading_id, device_id, temperature_celsius, event_timestamp, is_anomaly
FROM R ORDER BY event_timestamp DESC, reading_id DESC LIMIT 5""",
    "table_status": _with(R, W) + f"""SELECT table_name, row_count,
       CASE WHEN row_count > 0 THEN 'ok' ELSE 'empty' END AS status FROM (
  SELECT 'temperature_readings' AS table_name, count(*) AS row_count FROM R
  UNION ALL SELECT 'window_events', count(*) FROM W
  UNION ALL SELECT 'temperature_aggregations_1min', count(*) FROM ({_temp_agg(_MIN, '1_minute')}) a
  UNION ALL SELECT 'temperature_aggregations_5min', count(*) FROM ({_temp_agg(5 * _MIN, '5_minute')}) b) t""",
    "readings_codec": _with(R) + """SELECT device_id AS message_key, device_id, event_timestamp, timestamp_epoch,
       temperature_celsius, temperature_fahrenheit, 'temperature_reading' AS message_type,
       event_timestamp AS producer_timestamp, 'valid' AS quality_status FROM R""",
    "window_events_codec": _with(W) + """SELECT CAST(object_code AS VARCHAR) || '_' || event_type AS message_key,
       object_code, object_name, event_type, event_timestamp, 'window_event' AS message_type,
       'valid' AS quality_status FROM W""",
    "clock_parse": _with(W) + """SELECT event_id,
       CASE WHEN event_id % 2 = 0 THEN date_trunc('second', event_timestamp)
            ELSE date_trunc('minute', event_timestamp) END AS parsed_at FROM W""",
    "openings_fanout": _with(WC) + _FANOUT,
    "openings_csv_events": _with(WC) + _FANOUT,
    "readings_csv_scan": _with(R) + """SELECT device_id, date_trunc('second', event_timestamp) AS event_timestamp,
       timestamp_epoch, temperature_celsius, temperature_fahrenheit FROM R""",
    "quality_quarantine": _with(R) + """SELECT reading_id AS offset,
       CASE WHEN k BETWEEN 0 AND 4 THEN 'quarantine' ELSE 'valid' END AS quality_status,
       CASE k WHEN 0 THEN 'malformed_payload' WHEN 1 THEN 'malformed_payload'
              WHEN 2 THEN 'missing_event_timestamp' WHEN 3 THEN 'value_too_long'
              WHEN 4 THEN 'missing_required_field' END AS quarantine_reason,
       CASE k WHEN 0 THEN 'not json' WHEN 1 THEN '{"test": "connection"}' END AS malformed_payload
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM R) x""",
    "replay_sample": _with(R) + """SELECT reading_id, device_id, event_timestamp, temperature_celsius FROM R
ORDER BY md5(CAST(reading_id AS VARCHAR) || '/0'), reading_id LIMIT 100""",
    "replay_dedup": _with(R) + f"SELECT {_READING_COLS} FROM R",
    "retention_kept": _with(RU) + """SELECT reading_id, device_id, event_timestamp, temperature_celsius FROM RU
WHERE NOT COALESCE(event_timestamp < (SELECT max(event_timestamp) FROM RU) - INTERVAL '7 days', false)""",
    "retention_metric": _with(RU) + """SELECT 'data_cleanup_temp_readings' AS metric_name,
       CAST(count(*) FILTER (WHERE event_timestamp < m - INTERVAL '7 days') AS DOUBLE) AS metric_value,
       'rows_deleted' AS metric_unit, '{"days_to_keep":7}' AS tags, any_value(m) AS timestamp
FROM RU, (SELECT max(event_timestamp) AS m FROM RU) mx""",
    "retention_run": _with(RU) + """SELECT 'data_cleanup_temp_readings' AS metric_name,
       CAST(count(*) FILTER (WHERE event_timestamp < m - INTERVAL '7 days') AS DOUBLE) AS metric_value,
       'rows_deleted' AS metric_unit, '{"days_to_keep":7}' AS tags, any_value(m) AS timestamp,
       count(*) - count(*) FILTER (WHERE event_timestamp < m - INTERVAL '7 days') AS rows_kept
FROM RU, (SELECT max(event_timestamp) AS m FROM RU) mx""",
    "archive_roundtrip": _with(R) + f"SELECT {_READING_COLS} FROM R",
    "batch_audit": _with(R) + """SELECT 'temperature_readings' AS target, CAST(0 AS BIGINT) AS batch_id,
       count(*) AS row_count FROM R""",
    "csv_load_counts": _with(R, W) + """SELECT 'rows_loaded' AS metric_name, 'rows' AS metric_unit, TIMESTAMP '2024-01-01 00:00:00' AS timestamp, *
FROM (SELECT CAST(count(*) AS DOUBLE) AS metric_value, '{"source":"readings"}' AS tags FROM R
      UNION ALL SELECT CAST(count(*) AS DOUBLE), '{"source":"openings"}' FROM W WHERE event_type = 'opened') t""",
    "wire_messages": f"""WITH x AS (SELECT *, {_COMPRESSED} AS t FROM events)
SELECT event_id AS "offset", CASE WHEN t IS NULL OR (event_type NOT IN ('signup', 'error') AND value IS NULL) THEN 'quarantine' ELSE 'valid' END AS quality_status,
       t AS event_timestamp, t AS producer_timestamp,
       CASE WHEN event_type NOT IN ('signup', 'error') AND t IS NOT NULL THEN epoch_us(t) // 1000000 ELSE 0 END AS timestamp_epoch,
       CASE WHEN event_type NOT IN ('signup', 'error') THEN CAST(user_id AS VARCHAR) END AS device_id,
       CASE WHEN event_type NOT IN ('signup', 'error') THEN value - 30 END AS temperature_celsius,
       CASE WHEN event_type IN ('signup', 'error') THEN CAST(user_id AS INTEGER) ELSE 0 END AS object_code,
       CASE event_type WHEN 'signup' THEN 'opened' WHEN 'error' THEN 'closed' END AS event_type FROM x""",
    "window_cycles_uneven_partitions": _with(WC) + f"SELECT *, CAST(0 AS BIGINT) AS late_events FROM ({_durations(_FIRST_CLOSE)}) d",
    "temp_agg_1min_amended": _with(R) + _temp_agg(_MIN, "1_minute"),
    "window_agg_hourly_amended": _with(W) + _event_agg("W", _HOUR, "hourly"),
    "bus_offset_gaps": _with(_OFFSETS) + """SELECT topic, "partition", 'gap' AS kind, before + 1 AS first_offset, "offset" - 1 AS last_offset,
       "offset" - before - 1 AS records FROM counted WHERE "offset" - before > 1
UNION ALL SELECT topic, "partition", 'repeat', "offset", "offset", copies - 1 FROM counted WHERE copies > 1""",
    "bus_offset_summary": _with(_OFFSETS) + """SELECT topic, "partition", min("offset") AS start_offset, max("offset") + 1 AS end_offset,
       count(*) AS present, max("offset") + 1 - min("offset") - count(*) AS lost, CAST(sum(copies - 1) AS BIGINT) AS repeated
FROM counted GROUP BY topic, "partition" """,
    "replay_beyond_watermark": _with(R) + f"SELECT {_READING_COLS} FROM R",
    "fan_out_reconciliation": _with(R) + """SELECT target, batch_id, n AS expected_rows,
       CASE WHEN target = 'temperature_readings' AND batch_id = 1 THEN n - 1 WHEN target = 'alerts' AND batch_id = 2 THEN n + 1 ELSE n END
         AS stored_rows,
       CASE WHEN target = 'temperature_readings' AND batch_id = 1 THEN 'rows_lost'
            WHEN target = 'alerts' AND batch_id = 2 THEN 'rows_doubled'
            WHEN target = 'temperature_readings' AND batch_id = 3 THEN 'rows_changed' ELSE 'ok' END AS status
FROM (SELECT 'temperature_readings' AS target, reading_id % 4 AS batch_id, count(*) AS n FROM R GROUP BY ALL
      UNION ALL SELECT 'alerts', reading_id % 4, count(*) FROM R WHERE is_anomaly GROUP BY ALL) t""",
    "access_paths": _with(R, WC) + f"""SELECT *, true AS few_files FROM (
  SELECT 'readings' AS table_name, 'is_anomaly+anomaly_type' AS path, count(*) AS row_count FROM R WHERE is_anomaly AND anomaly_type = 'NORMAL'
  UNION ALL SELECT 'readings', 'anomaly_type+event_timestamp', count(*) FROM R
    WHERE anomaly_type = 'HIGH_TEMP' AND event_timestamp {_LAST_QUARTER}
  UNION ALL SELECT 'readings', 'device_id+event_timestamp', count(*) FROM R WHERE device_id = 'device_3' AND event_timestamp {_LAST_QUARTER}
  UNION ALL SELECT 'window_events', 'event_type+event_timestamp', count(*) FROM WC
    WHERE event_type = 'opened' AND event_timestamp {_LAST_QUARTER}
  UNION ALL SELECT 'cycles', 'is_unusual+opened_at', count(*) FROM ({_durations(_FIRST_CLOSE)}) d
    WHERE duration_minutes > 60 AND opened_at {_LAST_QUARTER}) t""",
}
# the same results by other means
for _name, _like in {"temperature_stats_24h_rollup": "temperature_stats_24h", "latest_reading_kept": "latest_reading_per_device",
                     "replay_sample_stream": "replay_sample", "window_cycles_stream_timers": "window_cycles_stream"}.items():
    ORACLE[_name] = ORACLE[_like]
