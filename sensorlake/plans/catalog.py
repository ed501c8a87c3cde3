"""Registered queries over the driver tables, each with an equivalent DuckDB SQL oracle.

Every query reads ``events`` (through the fixture derivations of
``sources.fixtures``) and runs over the whole table. Results are presented for
comparison: timestamps as TIMESTAMP_NTZ (UTC wall clock), averages and standard
deviations rounded in both engines, since their last bits depend on the order of summing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

from sensorlake.functions import codec
from sensorlake.functions.classify import detect_anomalies, detect_window_patterns
from sensorlake.functions.timefmt import format_clock, format_day, parse_day_clock, whole_second_duration
from sensorlake.operators import aggregates as agg
from sensorlake.operators import moments, offsets, pairing, quality, reconcile, retention, sampling, status, views
from sensorlake.sinks import audit, layout, parquet
from sensorlake.schemas import READING_MESSAGE_TYPE, READINGS_TOPIC, SYSTEM_METRICS
from sensorlake.session import child_folders, configure, scratch_path
from sensorlake.sources import bus, files, fixtures as fx
from sensorlake.streaming import merge_table, publish
from sensorlake.streaming.frontiers import PartitionClock
from sensorlake.streaming.identity import IdentityTable
from sensorlake.streaming.kept import LatestTable, RunningSample
from sensorlake.streaming.pairing import stream_first_close_pairs
from sensorlake.streaming.pairing_tables import finish_pairing, pair_writer, start_table_state_pairing
from sensorlake.streaming.pairing_timers import timed_first_close_pairs
from sensorlake.streaming.runner import materialize, with_rocksdb_state

QueryFn = Callable[[SparkSession, str], DataFrame]

RETENTION_DAYS = 7          # registered retention run (library default: 30)
SAMPLE_SIZE = 100           # replay sample size


# --------------------------------------------------------------------------- helpers

def present(df: DataFrame, rounded: dict[str, int] | None = None) -> DataFrame:
    """Timestamps -> TIMESTAMP_NTZ; listed double columns rounded to so many decimals."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif f.name in (rounded or {}) and isinstance(f.dataType, DoubleType):
            c = F.round(c, rounded[f.name])
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return fx.events(spark, sf_dir)


def _trailing(spark, sf_dir, span: dt.timedelta, compress: bool, only=None) -> tuple[DataFrame, dt.datetime | None]:
    """Events of the trailing range and the instant it ends at, the newest event's time.

    The newest time comes from a scan of that one column; the range is then a
    literal on the stored column, so it reaches the Parquet scan (a table that is
    written by day would be pruned by folder, too). It is a little wider than the
    range itself, which the view applies on event times. No events: no bound.
    """
    ev = _events(spark, sf_dir)
    ev = ev if only is None else ev.filter(only)
    newest = ev.agg(F.max("ts")).first()[0]
    if newest is None:
        return ev, None
    start = newest - span * (fx.COMPRESSION if compress else 1) - dt.timedelta(seconds=fx.COMPRESSION)
    recent = ev.filter(F.col("ts").isNull() | (F.col("ts") >= F.expr(f"TIMESTAMP_NTZ '{start}'")))
    return recent, fx.instant(newest, compress)


def _recent_readings(spark, sf_dir, span: dt.timedelta, compress=True) -> tuple[DataFrame, dt.datetime | None]:
    ev, as_of = _trailing(spark, sf_dir, span, compress)
    return detect_anomalies(fx.readings(ev, compress)), as_of


def _recent_window_events(spark, sf_dir, span: dt.timedelta) -> tuple[DataFrame, dt.datetime | None]:
    ev, as_of = _trailing(spark, sf_dir, span, False, fx.IS_WINDOW_EVENT)
    return fx.window_events(ev), as_of


HOUR, DAY = dt.timedelta(hours=1), dt.timedelta(days=1)


def _readings(spark, sf_dir, compress=True) -> DataFrame:
    return detect_anomalies(fx.readings(_events(spark, sf_dir), compress))


def _window_events(spark, sf_dir, compress=False) -> DataFrame:
    return fx.window_events(_events(spark, sf_dir), compress)


READING_COLS = ["reading_id", "device_id", "event_timestamp", "timestamp_epoch",
                "temperature_celsius", "temperature_fahrenheit", "is_anomaly", "anomaly_type"]
AGG_ROUNDED = {"avg_temp_celsius": 8, "avg_temp_fahrenheit": 8}


# --------------------------------------------------------------------------- batch queries

def readings_classified(spark, sf_dir):
    """R-1, R-2: every reading with its anomaly flag and type."""
    return present(_readings(spark, sf_dir).select(*READING_COLS))


def anomaly_alerts(spark, sf_dir):
    """D-2, B-10: anomalous readings only."""
    r = _readings(spark, sf_dir)
    return present(r.filter(F.col("is_anomaly")).select(
        "reading_id", "device_id", "event_timestamp", "temperature_celsius",
        "temperature_fahrenheit", "anomaly_type"))


def temp_agg_1min(spark, sf_dir):
    """G-1, C-5, C-6: 1-minute tumbling aggregates per device (batch)."""
    return present(agg.temperature_window_agg(_readings(spark, sf_dir), agg.READINGS_1MIN, streaming=False),
                   AGG_ROUNDED)


def temp_agg_5min(spark, sf_dir):
    """G-2: 5-minute tumbling aggregates per device (batch)."""
    return present(agg.temperature_window_agg(_readings(spark, sf_dir), agg.READINGS_5MIN, streaming=False),
                   AGG_ROUNDED)


def window_agg_hourly(spark, sf_dir):
    """G-3: hourly event counts per object and event type (batch)."""
    return present(agg.window_event_agg(_window_events(spark, sf_dir), agg.EVENTS_HOURLY, streaming=False))


def window_agg_daily(spark, sf_dir):
    """G-4: daily (UTC-aligned) event counts per object and event type (batch)."""
    return present(agg.window_event_agg(_window_events(spark, sf_dir), agg.EVENTS_DAILY, streaming=False))


def latest_reading_per_device(spark, sf_dir):
    """N-1, L-4: newest reading per device."""
    return present(views.latest_per_device(_readings(spark, sf_dir)).orderBy("device_id"))


def temperature_stats_24h(spark, sf_dir):
    """G-5, D-4, GF-5, GF-6, L-3: per-device statistics over the strict last 24 hours."""
    stats = views.temperature_stats(*_recent_readings(spark, sf_dir, DAY, compress=False))
    return present(stats.orderBy(F.desc("avg_temp_celsius")), AGG_ROUNDED | {"stddev_temp_celsius": 6})


def window_activity_7d(spark, sf_dir):
    """G-6, D-4, F-7, L-5: per-object daily activity over the strict last 7 days."""
    act = views.window_activity(*_recent_window_events(spark, sf_dir, 7 * DAY))
    return present(act.orderBy(F.desc("activity_date"), "object_code"))


def readings_last_hour(spark, sf_dir):
    """D-3, L-1: readings of the inclusive last hour, by time."""
    return present(views.recent_readings(*_recent_readings(spark, sf_dir, HOUR)))


def anomaly_count_last_hour(spark, sf_dir):
    """G-7: number of anomalies in the inclusive last hour."""
    return views.anomaly_count(*_recent_readings(spark, sf_dir, HOUR))


def agg_1min_last_2h(spark, sf_dir):
    """D-3, L-2: 1-minute aggregates starting in the last 2 hours."""
    r, as_of = _recent_readings(spark, sf_dir, 2 * HOUR)
    as_of = views.resolve_as_of(r, as_of)
    r = r.filter(F.col("event_timestamp") >= as_of - F.expr("INTERVAL 2 HOURS"))    # whole windows, as they start no earlier
    one_min = agg.temperature_window_agg(r, agg.READINGS_1MIN, streaming=False)
    return present(views.recent_aggregates(one_min, as_of), AGG_ROUNDED)


def activity_by_object_24h(spark, sf_dir):
    """G-8: event count per object name over the last 24 hours."""
    return views.activity_by_object(*_recent_window_events(spark, sf_dir, DAY))


def events_by_hour_type_24h(spark, sf_dir):
    """G-9, F-7: event count per hour and event type over the last 24 hours."""
    return present(views.events_by_hour_and_type(*_recent_window_events(spark, sf_dir, DAY)))


def newest_5_readings(spark, sf_dir):
    """L-6: the five newest readings (a top-k)."""
    return present(views.newest_readings(_readings(spark, sf_dir), 5))


def table_status(spark, sf_dir):
    """G-10, M-5: row count and status of the monitored tables."""
    r = _readings(spark, sf_dir)
    return status.table_status({
        "temperature_readings": r,
        "window_events": _window_events(spark, sf_dir),
        "temperature_aggregations_1min": agg.temperature_window_agg(r, agg.READINGS_1MIN, streaming=False),
        "temperature_aggregations_5min": agg.temperature_window_agg(r, agg.READINGS_5MIN, streaming=False),
    })


def retention_kept(spark, sf_dir):
    """M-3, D-5, F-9: rows kept by a 7-day retention run."""
    r, as_of = _recent_readings(spark, sf_dir, RETENTION_DAYS * DAY, compress=False)
    kept = retention.kept_rows(r, as_of, RETENTION_DAYS)
    return present(kept.select("reading_id", "device_id", "event_timestamp", "temperature_celsius"))


def retention_metric(spark, sf_dir):
    """M-3, G-11, F-10, M-4: the metric row of that retention run."""
    r = _readings(spark, sf_dir, compress=False)
    return present(retention.cleanup_metric(r, None, RETENTION_DAYS))


def retention_run(spark, sf_dir):
    """M-3, G-11, M-4: that retention run on a stored table by date: rows deleted and kept per its stored metric and files."""
    r = _readings(spark, sf_dir, compress=False).select(*READING_COLS)
    root = scratch_path(spark, "retention")
    parquet.write_batch(r, 0, f"{root}/readings", sort_cols=["device_id", "event_timestamp"])
    newest = _events(spark, sf_dir).agg(F.max("ts")).first()[0]
    if newest is not None:
        retention.apply_retention(spark, f"{root}/readings", f"{root}/metrics", fx.instant(newest, False), RETENTION_DAYS)
    kept = parquet.read_archive(spark, f"{root}/readings").agg(F.count(F.lit(1)).alias("rows_kept"))
    stored = spark.read.schema(SYSTEM_METRICS).parquet(f"{root}/metrics")
    return present(stored.select("metric_name", "metric_value", "metric_unit", "tags", "timestamp").crossJoin(kept))


def replay_sample(spark, sf_dir):
    """L-9: seeded sample of 100 readings for replay."""
    r = _readings(spark, sf_dir).select("reading_id", "device_id", "event_timestamp", "temperature_celsius")
    return present(sampling.replay_sample(r, SAMPLE_SIZE, "reading_id"))


def replay_dedup(spark, sf_dir):
    """S-11: replayed copies removed."""
    r = _readings(spark, sf_dir).select(*READING_COLS)
    replayed = r.unionByName(r.filter(F.col("is_anomaly")))  # a replay re-sends anomalous rows
    return present(sampling.drop_replayed(replayed, ["reading_id"]))


def window_cycles_first_close(spark, sf_dir):
    """J-3, F-4..F-6, R-3, R-4: each opening paired with its first later closing."""
    return present(pairing.first_close_pairs(_window_events(spark, sf_dir, compress=True)))


def window_usage_patterns(spark, sf_dir):
    """R-3, R-4 over J-3: cycles, unusual cycles and average minutes per pattern."""
    cycles = pairing.first_close_pairs(_window_events(spark, sf_dir, compress=True))
    return present(pairing.usage_pattern_summary(cycles), {"avg_duration_minutes": 6})


def window_pair_counts(spark, sf_dir):
    """J-1 (re-aimed), R-3, R-4: exact all-pairs counts per object and usage pattern."""
    return pairing.pair_pattern_counts(_window_events(spark, sf_dir, compress=True))


def clock_parse(spark, sf_dir):
    """F-11, F-12, F-18: 12-hour clock text (with and without seconds) parsed back."""
    w = _window_events(spark, sf_dir)
    with_seconds = F.col("event_id") % 2 == 0
    texts = w.select("event_id", format_day(F.col("event_timestamp")).alias("day"),
                     format_clock(F.col("event_timestamp"), with_seconds).alias("clock"))
    return present(texts.select("event_id", parse_day_clock(F.col("day"), F.col("clock")).alias("parsed_at")))


def openings_fanout(spark, sf_dir):
    """C-9, R-5, F-11: opening rows fanned out to opened/closed events."""
    pairs = pairing.first_close_pairs(_window_events(spark, sf_dir, compress=True))
    openings = pairs.select(
        format_day(F.col("opened_at")).alias("DayPST"),
        format_clock(F.col("opened_at")).alias("StartTimePST"),
        format_clock(F.col("closed_at")).alias("EndTimePST"),
        F.col("object_code").alias("ObjectCode"),
        F.col("object_name").alias("ObjectName"),
    )
    ev = codec.openings_to_events(openings)
    return present(ev.select("object_code", "object_name", "event_type", "event_timestamp"))


def readings_codec(spark, sf_dir):
    """C-1..C-4, C-10..C-13, F-1, F-2, F-14, A-6, Q-*: readings encoded to records and decoded back."""
    r = _readings(spark, sf_dir)
    rec = codec.encode_readings(r, producer_time=F.col("event_timestamp"))
    dec = quality.label_readings(codec.decode_readings(rec))
    return present(dec.select("message_key", "device_id", "event_timestamp", "timestamp_epoch",
                              "temperature_celsius", "temperature_fahrenheit", "message_type",
                              "producer_timestamp", "quality_status"))


def window_events_codec(spark, sf_dir):
    """C-2, C-12, W1: window events encoded with `timestamp` and decoded back."""
    w = _window_events(spark, sf_dir)
    rec = codec.encode_window_events(w, producer_time=F.col("event_timestamp"))
    dec = quality.label_window_events(codec.decode_window_events(rec))
    return present(dec.select("message_key", "object_code", "object_name", "event_type",
                              "event_timestamp", "message_type", "quality_status"))


def _corrupted_reading_records(spark, sf_dir) -> DataFrame:
    """Reading records with faults injected by the event's ``props.k`` value:
    0 not JSON, 1 a connection probe, 2 an unparseable time, 3 an over-long
    device id, 4 a missing Celsius field; every other record is intact."""
    ev = _events(spark, sf_dir)
    k = F.get_json_object(F.col("props"), "$.k").try_cast("int")
    rd = fx.readings(ev.select("*", k.alias("_k")), keep=("_k",))
    iso = F.date_format(F.col("event_timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    payload = F.struct(
        F.when(F.col("_k") == 2, F.lit("NaT")).otherwise(iso).alias("event_timestamp"),
        F.unix_timestamp("event_timestamp").alias("timestamp_epoch"),
        F.when(F.col("_k") == 3, F.repeat(F.lit("x"), 51)).otherwise(F.col("device_id")).alias("device_id"),
        F.col("temperature_fahrenheit").alias("temperature_fahrenheit"),
        F.when(F.col("_k") != 4, F.col("temperature_celsius")).alias("temperature_celsius"),
        F.lit(READING_MESSAGE_TYPE).alias("message_type"),
        iso.alias("producer_timestamp"),
    )
    value = (F.when(F.col("_k") == 0, F.lit("not json"))
             .when(F.col("_k") == 1, F.lit('{"test": "connection"}'))
             .otherwise(F.to_json(payload)))
    return rd.select(F.col("device_id").cast("binary").alias("key"), value.cast("binary").alias("value"),
                     F.lit(READINGS_TOPIC).alias("topic"), F.lit(0).alias("partition"),
                     F.col("reading_id").alias("offset"), F.col("event_timestamp").alias("timestamp"))


def quality_quarantine(spark, sf_dir):
    """Q-1..Q-3, T2: records with injected faults labelled valid or quarantined."""
    rec = _corrupted_reading_records(spark, sf_dir)
    labelled = quality.label_readings(codec.decode_readings(rec))
    return labelled.select("offset", "quality_status", "quarantine_reason",
                           F.when(F.col("quarantine_reason") == quality.MALFORMED, F.col("raw_value").cast("string"))
                           .alias("malformed_payload"))


def archive_roundtrip(spark, sf_dir):
    """Write readings as two micro-batches, replay the second, read the archive back."""
    r = _readings(spark, sf_dir).select(*READING_COLS)
    path = scratch_path(spark, "archive")
    split_at = F.timestamp_micros(F.lit(fx.BASE_MICROS + 6 * 3600 * 1_000_000))
    early = F.coalesce(F.col("event_timestamp") < split_at, F.lit(False))   # rows without time go to the second
    first, second = r.filter(early), r.filter(~early)
    sort = ["device_id", "event_timestamp"]
    parquet.write_batch(first, 0, path, sort_cols=sort)
    parquet.write_batch(second, 1, path, sort_cols=sort)
    parquet.write_batch(second, 1, path, sort_cols=sort)   # replay after a failure: no duplicates
    back = parquet.read_archive(spark, path)
    return present(back.select(*READING_COLS))


def batch_audit(spark, sf_dir):
    """B-15: row count of a written batch, observed during the write."""
    r = _readings(spark, sf_dir).select(*READING_COLS)
    path = scratch_path(spark, "audited")
    rec = audit.observed_write(r, 0, "temperature_readings", parquet.batch_writer(path))
    return audit.audit_frame(spark, [rec])


def readings_csv_scan(spark, sf_dir):
    """Readings written as the producer's CSV input (in time order), then scanned back."""
    r = _readings(spark, sf_dir)
    csv_rows = codec.in_publish_order(r, ["event_timestamp", "reading_id"]).select(
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp_utc"),
        "device_id",
        F.col("temperature_fahrenheit").alias("temp_f"),
        F.col("temperature_celsius").alias("temp_c"),
    )
    path = scratch_path(spark, "readings-csv")
    csv_rows.write.option("header", True).csv(path)
    back = files.readings_csv(spark, path)
    return present(back.select("device_id", "event_timestamp", "timestamp_epoch",
                               "temperature_celsius", "temperature_fahrenheit"))


def openings_csv_events(spark, sf_dir):
    """Openings CSV (12-hour clock, one row per first-close cycle) -> opened/closed events in time order."""
    pairs = pairing.first_close_pairs(_window_events(spark, sf_dir, compress=True))
    rows = pairs.select(
        format_day(F.col("opened_at")).alias("DayPST"),
        format_clock(F.col("opened_at")).alias("StartTimePST"),
        format_clock(F.col("closed_at")).alias("EndTimePST"),
        F.col("object_code").alias("ObjectCode"),
        F.col("object_name").alias("ObjectName"),
    )
    path = scratch_path(spark, "openings-csv")
    rows.write.option("header", True).csv(path)
    ev = codec.openings_to_events(files.openings_csv(spark, path))
    ordered = codec.in_publish_order(ev, ["event_timestamp", "object_code", "event_type"])
    return present(ordered.select("object_code", "object_name", "event_type", "event_timestamp"))


def csv_load_counts(spark, sf_dir):
    """G-12: rows loaded from the two CSV inputs, as metric rows."""
    root = scratch_path(spark, "load-counts")
    _readings(spark, sf_dir).select("device_id").write.option("header", True).csv(f"{root}/readings")
    fx.window_events(_events(spark, sf_dir)).filter("event_type = 'opened'").select("object_code").write.option("header", True).csv(f"{root}/openings")
    at = F.timestamp_micros(F.lit(fx.BASE_MICROS))
    return present(publish.loaded_rows(spark, f"{root}/readings", f"{root}/openings", at))


def wire_messages(spark, sf_dir):
    """C-1, C-2, F-1, F-2, Q-1: messages as a producer outside of this library writes them (ISO times without a
    fraction where there is none, spaces after separators, a second time field), decoded."""
    ev = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", fx.event_time(F.col("ts"), True).alias("t"))
    iso = F.concat(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss"),
                   F.when(F.date_format("t", "SSSSSS") == "000000", "").otherwise(F.concat(F.lit("."), F.date_format("t", "SSSSSS"))))
    window = F.col("event_type").isin("signup", "error")
    kind = F.when(F.col("event_type") == "signup", "opened").otherwise("closed")
    number = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    time = F.coalesce(F.concat(F.lit('"'), iso, F.lit('"')), F.lit("null"))
    reading = F.concat(F.lit('{"event_timestamp": '), time, F.lit(', "timestamp": '), time, F.lit(', "timestamp_epoch": '), number(F.unix_timestamp("t")),
                       F.lit(', "device_id": "'), F.col("user_id").cast("string"), F.lit('", "temperature_fahrenheit": '), number(F.col("value")),
                       F.lit(', "temperature_celsius": '), number(F.col("value") - 30), F.lit(', "message_type": "temperature_reading", "producer_timestamp": '),
                       time, F.lit("}"))
    event = F.concat(F.lit('{"timestamp": '), time, F.lit(', "object_code": '), number(F.col("user_id")), F.lit(', "object_name": "w'),
                     F.col("user_id").cast("string"), F.lit('", "event_type": "'), kind, F.lit('", "message_type": "window_event", "producer_timestamp": '),
                     time, F.lit("}"))
    rec = ev.select(F.col("user_id").cast("string").cast("binary").alias("key"), F.when(window, event).otherwise(reading).cast("binary").alias("value"),
                    F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("t").alias("timestamp"), window.alias("w"))
    r = quality.label_readings(codec.decode_readings(rec.filter("not w")))
    e = quality.label_window_events(codec.decode_window_events(rec.filter("w")))
    none = lambda kind: F.lit(None).cast(kind)
    return present(r.select("offset", "quality_status", "event_timestamp", "producer_timestamp", F.coalesce("timestamp_epoch", F.lit(0)).alias("timestamp_epoch"),
                            "device_id", "temperature_celsius", F.lit(0).alias("object_code"), none("string").alias("event_type"))
                   .union(e.select("offset", "quality_status", "event_timestamp", "producer_timestamp", F.lit(0).cast("long"), none("string"), none("double"),
                                   F.coalesce("object_code", F.lit(0)), "event_type")))


# --------------------------------------------------------------------------- streaming queries

def _event_stream(spark, sf_dir) -> DataFrame:
    configure(spark)
    schema = fx.events(spark, sf_dir).schema
    return bus.table_file_stream(spark, sf_dir, "events.parquet", schema)


def _run_stream(spark, sf_dir, df, name) -> DataFrame:
    return materialize(spark, df, name)


def temp_agg_1min_stream(spark, sf_dir):
    """G-1, S-1..S-3: the 1-minute aggregate as an append-mode stream."""
    s = detect_anomalies(fx.readings(_event_stream(spark, sf_dir)))
    return present(_run_stream(spark, sf_dir, agg.temperature_window_agg(s, agg.READINGS_1MIN), "agg1"), AGG_ROUNDED)


def temp_agg_5min_stream(spark, sf_dir):
    """G-2, S-1..S-3: the 5-minute aggregate as an append-mode stream."""
    s = detect_anomalies(fx.readings(_event_stream(spark, sf_dir)))
    return present(_run_stream(spark, sf_dir, agg.temperature_window_agg(s, agg.READINGS_5MIN), "agg5"), AGG_ROUNDED)


def window_agg_hourly_stream(spark, sf_dir):
    """G-3, S-1..S-3: hourly counts as an append-mode stream."""
    s = fx.window_events(_event_stream(spark, sf_dir))
    return present(_run_stream(spark, sf_dir, agg.window_event_agg(s, agg.EVENTS_HOURLY), "hourly"))


def window_agg_daily_stream(spark, sf_dir):
    """G-4, S-1..S-3: daily counts as an append-mode stream."""
    s = fx.window_events(_event_stream(spark, sf_dir))
    return present(_run_stream(spark, sf_dir, agg.window_event_agg(s, agg.EVENTS_DAILY), "daily"))


PAIRING_DELAY = "10 minutes"   # watermark delay of the streaming pairing (compressed time)
PAIRING_DELAY_SECONDS = 600


def window_cycles_stream(spark, sf_dir):
    """J-3 on a stream (state store): pairs final before the last watermark."""
    s = fx.window_events(_event_stream(spark, sf_dir), compress=True)
    pairs = _run_stream(spark, sf_dir, stream_first_close_pairs(s, PAIRING_DELAY), "cycles")
    pairs = pairs.withColumn("duration_seconds", whole_second_duration(F.col("opened_at"), F.col("closed_at")))
    pairs = pairs.withColumn("duration_minutes", F.col("duration_seconds") / 60)
    return present(detect_window_patterns(pairs))


def window_cycles_stream_tables(spark, sf_dir):
    """Streaming first-close pairing with table-backed state (skew-proof micro-batches)."""
    s = fx.window_events(_event_stream(spark, sf_dir), compress=True)
    root = scratch_path(spark, "cycles-tables")
    q = start_table_state_pairing(s, f"{root}/pairs", f"{root}/state", f"{root}/ckpt",
                                  delay_seconds=PAIRING_DELAY_SECONDS, trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"pairing stream failed: {q.exception()}")
    return present(spark.read.parquet(f"{root}/pairs").drop("batch_id"))


# --------------------------------------------------------------------------- tables kept batch by batch

BATCHES = 4                 # micro-batches that the fixtures are dealt into
FOUR_HOURS = 4 * 3_600_000_000     # of bus time in a batch of the uneven partitions


def _dealt(spark, df: DataFrame, number, name: str) -> list[DataFrame]:
    """The rows dealt into micro-batches by ``number``, written once; batch i as a ``foreachBatch`` writer would get it."""
    path = scratch_path(spark, f"{name}-batches")
    df.withColumn("_batch", number).write.partitionBy("_batch").parquet(path)
    found = sorted(int(n.partition("=")[2]) for n in child_folders(spark, path) if n.startswith("_batch="))
    return [spark.read.schema(df.schema).parquet(f"{path}/_batch={k}") for k in found]


def _shuffled(id_col: str):
    """Batches that have nothing to do with time: rows come hours late, or early, in every one."""
    return F.pmod(F.xxhash64(id_col), F.lit(BATCHES))


def window_cycles_uneven_partitions(spark, sf_dir):
    """S-12, J-3: openings and closings travel in two bus partitions, the openings' one two hours behind; pairs of all
    batches and how many events were called late."""
    w = _window_events(spark, sf_dir, compress=True)
    behind = F.when(F.col("event_type") == "opened", F.lit(2 * 3_600_000_000)).otherwise(F.lit(0))
    arrival = F.floor((F.coalesce(F.unix_micros("event_timestamp"), F.lit(fx.BASE_MICROS)) - fx.BASE_MICROS + behind)
                      / F.lit(FOUR_HOURS)).cast("int")
    ev = (w.withColumn("topic", F.lit("iot-window-events")).withColumn("partition", (F.col("event_type") == "closed").cast("int"))
          .withColumn("kafka_timestamp", F.timestamp_micros(F.lit(fx.BASE_MICROS) + (arrival + 1) * F.lit(FOUR_HOURS))))
    bus_batch = F.floor((F.unix_micros("kafka_timestamp") - fx.BASE_MICROS) / F.lit(FOUR_HOURS)).cast("int")
    root = scratch_path(spark, "uneven")
    clock = PartitionClock(idle_seconds=5 * 3600, partitions=2)
    write = pair_writer(f"{root}/pairs", f"{root}/state", PAIRING_DELAY_SECONDS, clock)
    for i, batch in enumerate(_dealt(spark, ev, bus_batch, "uneven")):
        write(batch, i)
    finish_pairing(ev.schema, spark, f"{root}/pairs", f"{root}/state")
    if not child_folders(spark, f"{root}/pairs"):                   # no event at all
        write(ev.limit(0), 0)
    late = [f"{root}/pairs_late/{n}" for n in child_folders(spark, f"{root}/pairs_late")]
    n_late = spark.read.parquet(*late).count() if late else 0
    return present(spark.read.parquet(f"{root}/pairs").drop("batch_id").withColumn("late_events", F.lit(n_late).cast("long")))


def temp_agg_1min_amended(spark, sf_dir):
    """S-4, G-1: 1-minute aggregates from batches in any order of time, one run again, some compacted: no cut-off."""
    r = _readings(spark, sf_dir)
    table = merge_table.temperature_table(scratch_path(spark, "amended"))
    batches = _dealt(spark, r, _shuffled("reading_id"), "amended")
    for i, batch in enumerate(batches):
        table.write(merge_table.temperature_parts(batch), i)
        if i == 1:
            table.write(merge_table.temperature_parts(batch), i)    # run again
        if i == 2:
            table.compact(spark, 1)
    return present(merge_table.temperature_view(table.read(spark)), AGG_ROUNDED)


def window_agg_hourly_amended(spark, sf_dir):
    """S-4, G-3: hourly event counts from batches in any order of time, compacted twice."""
    table = merge_table.event_table(scratch_path(spark, "amended-hourly"))
    for i, batch in enumerate(_dealt(spark, _window_events(spark, sf_dir), _shuffled("event_id"), "amended-hourly")):
        table.write(merge_table.event_parts(batch), i)
        if i >= 2:
            table.compact(spark, i - 1)
    return present(merge_table.event_view(table.read(spark)))


def _planted_records(spark, sf_dir) -> DataFrame:
    """Bus records of the events, three partitions: every 97th is lost, every 89th comes twice."""
    ev = _events(spark, sf_dir)
    rec = ev.select(F.lit(READINGS_TOPIC).alias("topic"), (F.col("event_id") % 3).cast("int").alias("partition"),
                    F.call_function("div", F.col("event_id"), F.lit(3)).alias("offset"), "event_id")
    rec = rec.filter("event_id % 97 != 0")
    return rec.unionByName(rec.filter("event_id % 89 = 0")).drop("event_id")


def bus_offset_gaps(spark, sf_dir):
    """A-5, A-9: lost and repeated offsets, exactly."""
    return offsets.offset_report(_planted_records(spark, sf_dir))


def bus_offset_summary(spark, sf_dir):
    """A-9, GF-7: start and end of every topic partition, what is there, lost and repeated."""
    return offsets.offset_summary(_planted_records(spark, sf_dir)).drop("unplaced")


def temperature_stats_24h_rollup(spark, sf_dir):
    """G-5, GF-6: the 24-hour statistics from moments by hour and minute, raw rows at the two edges only."""
    r = _readings(spark, sf_dir, compress=False)
    root = scratch_path(spark, "moments")
    moments.minute_moments(r).write.parquet(f"{root}/minutes")
    minutes = spark.read.parquet(f"{root}/minutes")
    moments.hour_moments(minutes).write.parquet(f"{root}/hours")
    newest = _events(spark, sf_dir).agg(F.max("ts")).first()[0]
    as_of = fx.instant(newest, False) if newest is not None else dt.datetime(1970, 1, 1)
    stats = moments.temperature_stats(r, minutes, spark.read.parquet(f"{root}/hours"), as_of, DAY)
    return present(stats.orderBy(F.desc("avg_temp_celsius")), AGG_ROUNDED | {"stddev_temp_celsius": 6})


def replay_beyond_watermark(spark, sf_dir):
    """S-11: every batch sends rows of all earlier ones again; each reading is stored once."""
    r = _readings(spark, sf_dir).select(*READING_COLS)
    at = F.floor((F.unix_micros("event_timestamp") - fx.BASE_MICROS) / F.lit(12 * 3_600_000_000 // BATCHES))
    own = F.greatest(F.least(F.coalesce(at, F.lit(0)), F.lit(BATCHES - 1)), F.lit(0)).cast("int")
    again = r.withColumn("_own", own).filter("reading_id % 5 < 3").withColumn(
        "_batch", F.explode(F.sequence(F.col("_own"), F.lit(BATCHES - 1))))
    sent = r.withColumn("_batch", own).unionByName(again.drop("_own"))
    known = IdentityTable(scratch_path(spark, "identities"), ("reading_id", "device_id", "event_timestamp"), blocks=16)
    path = scratch_path(spark, "first-sent")
    for i, batch in enumerate(_dealt(spark, sent, F.col("_batch"), "replays")):
        stored = f"{path}/batch_id={i}"
        known.new_rows(batch.drop("_batch"), i).write.parquet(stored)
        known.remember(spark.read.parquet(stored), i)
        if i == 2:
            known.compact_filters(spark, 1)
    return present(spark.read.parquet(path).select(*READING_COLS))


def latest_reading_kept(spark, sf_dir):
    """N-1: the newest reading per device, kept as a table from batch to batch, one of them run again."""
    r = _readings(spark, sf_dir)
    cols = ["device_id", "temperature_celsius", "temperature_fahrenheit", "event_timestamp", "is_anomaly", "anomaly_type"]
    rows = r.select(*cols, "reading_id")
    table = LatestTable(scratch_path(spark, "latest"), rows.schema, ["device_id"], ["event_timestamp", "reading_id"], buckets=16)
    for i, batch in enumerate(_dealt(spark, rows, _shuffled("reading_id"), "latest")):
        table.apply(batch, i)
        if i == 2:
            table.apply(batch, i)
    return present(table.read(spark).select(*cols).orderBy("device_id"))


def replay_sample_stream(spark, sf_dir):
    """L-9 on a stream: a bottom-k sample as running state."""
    rows = _readings(spark, sf_dir).select("reading_id", "device_id", "event_timestamp", "temperature_celsius")
    sample = RunningSample(scratch_path(spark, "sample"), rows.schema, SAMPLE_SIZE, "reading_id")
    for i, batch in enumerate(_dealt(spark, rows, _shuffled("reading_id"), "sample")):
        sample.apply(batch, i)
    return present(sample.read(spark))


def fan_out_reconciliation(spark, sf_dir):
    """B-15, B-17: four batches fanned out to two tables; a row lost, one doubled and two values swapped on the way are named."""
    r = _readings(spark, sf_dir).select(*READING_COLS)
    root = scratch_path(spark, "fan-out")
    expected = []
    for i, batch in enumerate(_dealt(spark, r, (F.col("reading_id") % BATCHES).cast("int"), "fan-out")):
        alerts = batch.filter("is_anomaly")
        expected += [reconcile.fingerprint(batch, "temperature_readings", i), reconcile.fingerprint(alerts, "alerts", i)]
        first, last = batch.agg(F.min("reading_id"), F.max("reading_id")).first()
        swapped = F.when(F.col("reading_id") == first, last).when(F.col("reading_id") == last, first).otherwise(F.col("reading_id"))
        if i == 1:
            batch = batch.filter(F.col("reading_id") != first)
        if i == 2:
            alerts = alerts.unionByName(alerts.orderBy("reading_id").limit(1))
        if i == 3:
            batch = batch.withColumn("reading_id", swapped)
        parquet.write_batch(batch, i, f"{root}/temperature_readings")
        parquet.write_batch(alerts, i, f"{root}/alerts")
    stored = [reconcile.stored_fingerprints(parquet.read_archive(spark, f"{root}/{t}"), t) for t in ("temperature_readings", "alerts")]
    return reconcile.compare(reduce(DataFrame.unionByName, expected), reduce(DataFrame.unionByName, stored))


def access_paths(spark, sf_dir):
    """M-6: filters by flag and type, device, event type and unusual flag over interleaved files: rows found, and whether
    under a quarter of the files were opened."""
    r = _readings(spark, sf_dir).select(*READING_COLS)
    w = _window_events(spark, sf_dir, compress=True)
    cycles = pairing.first_close_pairs(w).withColumn("is_unusual", F.col("duration_minutes") > 60)    # rarer beyond an hour here
    end = fx.instant(dt.datetime(2024, 1, 31), True)
    quarter = (end - dt.timedelta(hours=3), end)
    root = scratch_path(spark, "paths")
    tables = {"readings": (r, ["anomaly_type", "event_timestamp", "device_id", "is_anomaly"]),
              "window_events": (w, ["event_type", "event_timestamp"]), "cycles": (cycles, ["is_unusual", "opened_at"])}
    paths = [("readings", {"is_anomaly": (True, True), "anomaly_type": ("NORMAL", "NORMAL")}),
             ("readings", {"anomaly_type": ("HIGH_TEMP", "HIGH_TEMP"), "event_timestamp": quarter}),
             ("readings", {"device_id": ("device_3", "device_3"), "event_timestamp": quarter}),
             ("window_events", {"event_type": ("opened", "opened"), "event_timestamp": quarter}),
             ("cycles", {"is_unusual": (True, True), "opened_at": quarter})]
    for name, (df, columns) in tables.items():
        layout.write_interleaved(df, f"{root}/{name}", columns, at_least=64)
    found = []
    for name, where in paths:
        opened, there = layout.files_where(spark, f"{root}/{name}", where)
        rows = layout.read_where(spark, f"{root}/{name}", where, tables[name][0].schema)
        found.append(rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit("+".join(where)).alias("path"), "row_count",
            F.lit(4 * len(opened) < there or not there).alias("few_files")))
    return reduce(DataFrame.unionByName, found)


def window_cycles_stream_timers(spark, sf_dir):
    """J-3 on a stream with keyed timers and state in parts: pairs final before the last watermark."""
    s = fx.window_events(_event_stream(spark, sf_dir), compress=True)
    with with_rocksdb_state(spark):
        pairs = _run_stream(spark, sf_dir, timed_first_close_pairs(s, PAIRING_DELAY), "cycles-timers")
    pairs = pairs.withColumn("duration_seconds", whole_second_duration(F.col("opened_at"), F.col("closed_at")))
    pairs = pairs.withColumn("duration_minutes", F.col("duration_seconds") / 60)
    return present(detect_window_patterns(pairs))


QUERIES: dict[str, QueryFn] = {
    "readings_classified": readings_classified,
    "anomaly_alerts": anomaly_alerts,
    "temp_agg_1min": temp_agg_1min,
    "temp_agg_5min": temp_agg_5min,
    "temp_agg_1min_stream": temp_agg_1min_stream,
    "temp_agg_5min_stream": temp_agg_5min_stream,
    "window_agg_hourly": window_agg_hourly,
    "window_agg_daily": window_agg_daily,
    "window_agg_hourly_stream": window_agg_hourly_stream,
    "window_agg_daily_stream": window_agg_daily_stream,
    "window_cycles_first_close": window_cycles_first_close,
    "window_pair_counts": window_pair_counts,
    "window_usage_patterns": window_usage_patterns,
    "window_cycles_stream": window_cycles_stream,
    "window_cycles_stream_tables": window_cycles_stream_tables,
    "latest_reading_per_device": latest_reading_per_device,
    "temperature_stats_24h": temperature_stats_24h,
    "window_activity_7d": window_activity_7d,
    "readings_last_hour": readings_last_hour,
    "anomaly_count_last_hour": anomaly_count_last_hour,
    "agg_1min_last_2h": agg_1min_last_2h,
    "activity_by_object_24h": activity_by_object_24h,
    "events_by_hour_type_24h": events_by_hour_type_24h,
    "newest_5_readings": newest_5_readings,
    "table_status": table_status,
    "readings_codec": readings_codec,
    "window_events_codec": window_events_codec,
    "clock_parse": clock_parse,
    "openings_fanout": openings_fanout,
    "openings_csv_events": openings_csv_events,
    "readings_csv_scan": readings_csv_scan,
    "quality_quarantine": quality_quarantine,
    "replay_sample": replay_sample,
    "replay_dedup": replay_dedup,
    "retention_kept": retention_kept,
    "retention_metric": retention_metric,
    "retention_run": retention_run,
    "archive_roundtrip": archive_roundtrip,
    "batch_audit": batch_audit,
    "csv_load_counts": csv_load_counts,
    "wire_messages": wire_messages,
    "window_cycles_uneven_partitions": window_cycles_uneven_partitions,
    "temp_agg_1min_amended": temp_agg_1min_amended,
    "window_agg_hourly_amended": window_agg_hourly_amended,
    "bus_offset_gaps": bus_offset_gaps,
    "bus_offset_summary": bus_offset_summary,
    "temperature_stats_24h_rollup": temperature_stats_24h_rollup,
    "replay_beyond_watermark": replay_beyond_watermark,
    "latest_reading_kept": latest_reading_kept,
    "window_cycles_stream_timers": window_cycles_stream_timers,
    "replay_sample_stream": replay_sample_stream,
    "fan_out_reconciliation": fan_out_reconciliation,
    "access_paths": access_paths,
}
