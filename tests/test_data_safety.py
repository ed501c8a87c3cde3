"""What must not get lost: rows of a retention run that stops, readings of one instant, offsets, rows of a fan-out."""
import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from sensorlake.operators import offsets, reconcile, retention
from sensorlake.schemas import RECORD, TABLES
from sensorlake.session import scratch_path
from sensorlake.sinks import layout, parquet, relational
from sensorlake.sources import bus
from sensorlake.streaming import jobs
from tests.conftest import ts

UTC = dt.timezone.utc
AS_OF = dt.datetime(2024, 1, 31, 12, tzinfo=UTC)


# ------------------------------------------------------------------- retention

class Stopped(Exception):
    pass


def stop_at(monkeypatch, step, after):
    """Raise at the n-th write, move or deletion of a retention run: before it is done, or right after."""
    left = [step]

    def wrap(real):
        def run(*args, **kwargs):
            left[0] -= 1
            if left[0] == 0 and not after:
                raise Stopped
            out = real(*args, **kwargs)
            if left[0] == 0:
                raise Stopped
            return out
        return run
    for name in ("move_folder", "delete_path"):
        monkeypatch.setattr(retention, name, wrap(getattr(retention, name)))
    monkeypatch.setattr(DataFrameWriter, "parquet", wrap(DataFrameWriter.parquet))
    return left


@pytest.mark.parametrize("after", [False, True])
def test_a_retention_run_that_stops_anywhere_loses_nothing(spark, monkeypatch, after):
    ages = [0, 1, 10, 29, 29.9, 30, 30.2, 30.3, 31, 45]
    rows = [(i, AS_OF - dt.timedelta(days=d)) for i, d in enumerate(ages)] + [(99, None)]
    kept = {i for i, d in enumerate(ages) if d <= 30} | {99}
    expired = len(rows) - len(kept)
    step = 0
    while True:
        step += 1
        src, metrics = scratch_path(spark, "stop-src"), scratch_path(spark, "stop-metrics")
        df = spark.createDataFrame(rows, "id long, event_timestamp timestamp")
        parquet.write_batch(df, 3, src)
        with monkeypatch.context() as m:
            left = stop_at(m, step, after)
            try:
                retention.apply_retention(spark, src, metrics, AS_OF, 30)
            except Stopped:
                pass
        if left[0] > 0:
            break                                   # it has fewer steps than that
        late = spark.createDataFrame([(500, AS_OF - dt.timedelta(days=29.95))], df.schema)
        parquet.write_batch(late, 7, src)           # a writer goes on meanwhile
        retention.apply_retention(spark, src, metrics, AS_OF, 30)
        assert {r.id for r in spark.read.parquet(src).collect()} == kept | {500}, step
        stored = [r.metric_value for r in spark.read.parquet(metrics).collect()]
        assert sum(stored) == expired, (step, stored)
        assert "_retention" not in os.listdir(src.replace("file:", ""))
    assert step > 8


def test_another_cut_off_first_finishes_the_one_that_stopped(spark, monkeypatch):
    src, metrics = scratch_path(spark, "two-src"), scratch_path(spark, "two-metrics")
    rows = [(i, AS_OF - dt.timedelta(days=i + 0.5)) for i in range(40)]
    parquet.write_batch(spark.createDataFrame(rows, "id long, event_timestamp timestamp"), 0, src)
    with monkeypatch.context() as m:
        stop_at(m, 4, False)
        with pytest.raises(Stopped):
            retention.apply_retention(spark, src, metrics, AS_OF, 30)
    assert retention.apply_retention(spark, src, metrics, AS_OF + dt.timedelta(days=1), 30) == 1
    assert sorted(r.metric_value for r in spark.read.parquet(metrics).collect()) == [1.0, 10.0]
    assert {r.id for r in spark.read.parquet(src).collect()} == set(range(29))


def test_retention_of_an_empty_table(spark):
    src, metrics = scratch_path(spark, "empty-src"), scratch_path(spark, "empty-metrics")
    spark.createDataFrame([], "id long").write.parquet(src)
    assert retention.apply_retention(spark, src, metrics, AS_OF, 30) == 0
    assert [r.metric_value for r in spark.read.parquet(metrics).collect()] == [0.0]


# ------------------------------------------------------------------- relational copy

def reading_record(offset, celsius, second=1, device="d", partition=0):
    value = json.dumps({"event_timestamp": f"2024-01-01T00:00:{second:02d}.000000", "timestamp_epoch": 1704067200 + second, "device_id": device,
                        "temperature_fahrenheit": 70.0, "temperature_celsius": celsius, "message_type": "temperature_reading",
                        "producer_timestamp": "2024-01-01T00:00:00.000000"})
    return device.encode(), value.encode(), "iot-temperature", partition, offset, dt.datetime(2024, 1, 1, 12, tzinfo=UTC)


def window_record(offset, code, kind, minute):
    value = json.dumps({"timestamp": f"2024-01-01T00:{minute:02d}:00.000000", "object_code": code, "object_name": f"w{code}", "event_type": kind,
                        "message_type": "window_event", "producer_timestamp": "2024-01-01T00:00:00.000000"})
    return f"{code}_{kind}".encode(), value.encode(), "iot-window-events", 0, offset, dt.datetime(2024, 1, 1, 12, tzinfo=UTC)


class Store:
    """Stands in for the database behind ``relational.append_new``: the same key and anti-join, tables in memory."""

    def __init__(self, spark):
        self.spark, self.tables = spark, {}

    def __call__(self, batch, url, table, keys, time_col, properties=None):
        schema, _, _ = TABLES[table]
        columns = [c for c in schema.fieldNames() if c in batch.columns]
        existing = self.spark.createDataFrame(self.tables.get(table, []), batch.select(*columns).schema)
        new = relational.new_rows(batch.select(*columns), existing, keys).collect()
        self.tables.setdefault(table, []).extend(new)
        return len(new)


def test_two_readings_of_one_instant_both_arrive(spark):
    _, keys, _ = TABLES["temperature_readings"]
    schema = "device_id string, event_timestamp timestamp, temperature_celsius double, topic string, partition int, offset long, processing_timestamp timestamp"
    row = lambda offset, c, p="2024-01-01 00:00:09": ("d", ts("2024-01-01 00:00:00"), c, "t", 0, offset, ts(p))
    nowhere = ("d", ts("2024-01-01 00:00:00"), 3.0, None, None, None)
    batch = spark.createDataFrame([row(0, 1.0), row(1, 1.0), row(1, 1.0), (*nowhere, ts("2024-01-01 00:00:09"))], schema)
    there = spark.createDataFrame([row(0, 1.0, "2024-01-01 00:00:01"), (*nowhere, ts("2024-01-01 00:00:01"))], schema)
    assert [r.offset for r in relational.new_rows(batch, there, keys).collect()] == [1]
    assert sorted(r.offset if r.offset is not None else -1 for r in relational.new_rows(batch, there.limit(0), keys).collect()) == [-1, 0, 1]


@pytest.mark.parametrize("pairing", ["timers", "state_store"])
def test_the_window_job_pairs_in_the_state_store(spark, pairing):
    root = scratch_path(spark, f"job-{pairing}").replace("file:", "")
    events = [window_record(0, 1, "opened", 0), window_record(1, 1, "closed", 10), window_record(2, 2, "opened", 1), window_record(3, 2, "closed", 20),
              window_record(4, 1, "opened", 55)]
    spark.createDataFrame(events, RECORD).coalesce(1).write.parquet(f"{root}/w")
    qs = jobs.start_window_events(spark, bus.record_file_stream(spark, f"{root}/w"), f"{root}/t", f"{root}/c", jobs.Triggers.available_now(), "1 minute", pairing)
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None
    got = spark.read.parquet(f"{root}/t/window_durations").collect()
    assert sorted((r.object_code, r.duration_minutes, r.usage_pattern) for r in got) == [(1, 10.0, "SHORT_OPENING"), (2, 19.0, "SHORT_OPENING")]


def test_every_stored_table_has_its_relational_copy(spark, monkeypatch):
    root, store = scratch_path(spark, "copies").replace("file:", ""), Store(spark)
    monkeypatch.setattr(relational, "append_new", store)
    spark.createDataFrame([reading_record(0, 20.0), reading_record(1, 21.0), reading_record(2, 99.0, device="e"), (b"k", b"no", "iot-temperature", 0, 3, None),
                           reading_record(9, 20.0, second=59)], RECORD).coalesce(1).write.parquet(f"{root}/r")
    events = [window_record(0, 1, "opened", 0), window_record(1, 1, "closed", 10), window_record(2, 2, "opened", 1), window_record(3, 2, "closed", 50),
              window_record(4, 1, "opened", 55)]
    spark.createDataFrame(events, RECORD).coalesce(1).write.parquet(f"{root}/w")
    for run in range(2):                    # a second run with fresh checkpoints sends every batch again
        qs = jobs.start_readings(spark, bus.record_file_stream(spark, f"{root}/r"), f"{root}/t{run}", f"{root}/c{run}",
                                 jobs.Triggers.available_now(), jobs.Database("jdbc:none:"))
        qs += jobs.start_window_events(spark, bus.record_file_stream(spark, f"{root}/w"), f"{root}/t{run}", f"{root}/c{run}",
                                       jobs.Triggers.available_now(), "1 minute", database=jobs.Database("jdbc:none:"))
        for q in qs:
            q.awaitTermination()
            assert q.exception() is None
        sizes = {t: len(rows) for t, rows in store.tables.items()}
        assert sizes["temperature_readings"] == 4 and sizes["window_events"] == 5
        assert sorted((r.object_code, r.duration_minutes) for r in store.tables["window_durations"]) == [(1, 10.0), (2, 49.0)]
        metrics = {(r.metric_name, r.tags): r.metric_value for r in store.tables["system_metrics"]}
        assert metrics == {("rows_stored", '{"batch_id":0,"table":"temperature_readings"}'): 4.0,
                           ("rows_quarantined", '{"batch_id":0,"table":"temperature_readings"}'): 1.0,
                           ("rows_stored", '{"batch_id":0,"table":"window_events"}'): 5.0,
                           ("rows_quarantined", '{"batch_id":0,"table":"window_events"}'): 0.0}
    t = f"{root}/t0"
    for name in ("temperature_readings", "window_events"):
        report = {r.target: r for r in jobs.reconcile_tables(spark, t, name).collect()}
        assert {r.status for r in report.values()} == {"ok"} and report[name].stored_rows == sizes[name]
    parquet.write_batch(spark.read.parquet(f"{t}/alerts").drop("event_date", "batch_id").limit(0), 0, f"{t}/alerts")
    stored = spark.read.parquet(f"{t}/temperature_readings").drop("event_date", "batch_id").cache()
    stored.count()
    parquet.write_batch(stored.withColumn("temperature_celsius", F.when(F.col("offset") == 0, 21.0).when(F.col("offset") == 1, 20.0)
                                          .otherwise(F.col("temperature_celsius"))), 0, f"{t}/temperature_readings")
    report = {r.target: r.status for r in jobs.reconcile_tables(spark, t, "temperature_readings").collect()}
    assert report["temperature_readings"] == "rows_changed" and report["quarantine_temperature_readings"] == "ok"


# ------------------------------------------------------------------- fan-out fingerprints

def test_fingerprints_name_what_differs(spark):
    schema = "batch_id long, id long, v double, s string, processing_timestamp timestamp"
    at = ts("2024-01-01 00:00:00")
    row = lambda b, i, v=1.0, s="x": (b, i, v, s, at)
    sent = {0: [row(0, 1), row(0, 2)], 1: [row(1, 1), row(1, 1), row(1, 3)], 2: [row(2, 1, None, None)], 3: [row(3, 1, 1.0), row(3, 2, 2.0)], 4: [row(4, 5)], 5: []}
    kept = [row(0, 2), row(0, 1), row(1, 1), row(1, 3), row(1, 3), row(2, 1, None, None), row(3, 1, 2.0), row(3, 2, 1.0), row(9, 1)]
    expected = [reconcile.fingerprint(spark.createDataFrame(rows, schema), "t", b) for b, rows in sent.items()]
    expected += expected[:1]                # batch 0 was run again
    whole = expected[0]
    for e in expected[1:]:
        whole = whole.unionByName(e)
    table = spark.createDataFrame(kept, schema).withColumn("processing_timestamp", F.current_timestamp()).repartition(3)
    got = {r.batch_id: (r.status, r.expected_rows, r.stored_rows) for r in reconcile.compare(whole, reconcile.stored_fingerprints(table, "t")).collect()}
    assert got == {0: ("ok", 2, 2), 1: ("rows_changed", 3, 3), 2: ("ok", 1, 1), 3: ("rows_changed", 2, 2), 4: ("batch_missing", 1, 0),
                   9: ("batch_unexpected", 0, 1)}


# ------------------------------------------------------------------- offsets

def plain_offsets(rows):
    out, held = [], {}
    for topic, part, at in rows:
        if None not in (topic, part, at):
            held.setdefault((topic, part), []).append(at)
    for (topic, part), found in held.items():
        distinct = sorted(set(found))
        out += [(topic, part, "gap", a + 1, b - 1, b - a - 1) for a, b in zip(distinct, distinct[1:]) if b - a > 1]
        out += [(topic, part, "repeat", o, o, found.count(o) - 1) for o in distinct if found.count(o) > 1]
    return sorted(out), held


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_holes_and_repeats_are_found_wherever_tasks_begin(spark, monkeypatch, parts):
    monkeypatch.setattr(offsets, "partitions_for_size", lambda *_: parts)
    draw = random.Random(parts)
    rows = [("hot", 0, o) for o in range(100, 1100) if draw.random() > 0.02] + [("hot", 0, draw.randrange(100, 1100)) for _ in range(30)]
    rows += [("hot", 1, o) for o in (5, 5, 5, 9, 1 << 40)] + [("b", 0, 7), ("b", 2, 0), ("b", 2, 1)] + [(None, 0, 1), ("b", None, 1), ("b", 0, None)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "topic string, partition int, offset long").repartition(4)
    made = []
    exp, held = plain_offsets(rows)
    assert sorted(map(tuple, offsets.offset_report(df, made).collect())) == exp
    summary = {(r.topic, r.partition): r for r in offsets.offset_summary(df, made).collect()}
    assert summary[None, None].unplaced == 3 and len(made) == 2
    for key, found in held.items():
        r, distinct = summary[key], set(found)
        assert (r.start_offset, r.end_offset, r.present, r.repeated) == (min(found), max(found) + 1, len(distinct), len(found) - len(distinct))
        assert r.lost == max(found) + 1 - min(found) - len(distinct)
    assert offsets.offset_report(df.limit(0)).count() == 0 and offsets.offset_summary(df.limit(0)).count() == 0


# ------------------------------------------------------------------- layout

def test_interleaved_files_serve_every_path(spark):
    schema = "id int, flag boolean, kind string, t timestamp, v double"
    draw = random.Random(2)
    rows = [(i, draw.random() < 0.02, draw.choice(["kind_a", "kind_b", "kind_c", None]), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=draw.randrange(10 ** 6)),
             draw.choice([None, draw.gauss(0, 1)])) for i in range(4000)]
    df = spark.createDataFrame(rows, schema)
    path = scratch_path(spark, "layout")
    layout.write_interleaved(df, path, ["kind", "t", "flag"], at_least=64)
    mid, end = dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 11)
    for where in ({"flag": (True, True)}, {"kind": ("kind_b", "kind_b"), "t": (mid, end)}, {"kind": ("kind_a", "kind_b")}, {"t": (None, dt.datetime(2024, 1, 2))},
                  {"t": (dt.datetime(2025, 1, 1), None)}):
        got = {r.id for r in layout.read_where(spark, path, where, df.schema).collect()}
        names = df.columns
        exp = {r[0] for r in rows if all(r[names.index(c)] is not None and (lo is None or r[names.index(c)] >= lo) and (hi is None or r[names.index(c)] <= hi)
                                         for c, (lo, hi) in where.items())}
        opened, there = layout.files_where(spark, path, where)
        assert got == exp and there >= 32
        if len(where) == 2 or "flag" in where or not exp:
            assert len(opened) * 4 < there, where
    assert spark.read.parquet(path).count() == 4000
    empty = scratch_path(spark, "layout-none")
    layout.write_interleaved(df.limit(0), empty, ["kind", "v"])
    assert layout.read_where(spark, empty, {"v": (0.0, None)}, df.schema).count() == 0
    with pytest.raises(ValueError):
        layout.write_interleaved(df, empty, df.columns * 2)


# ------------------------------------------------------------------- the jobs' options

def test_jobs_drop_replays_amend_late_rows_and_audit_offsets(spark):
    """Two runs of both jobs over files that come later: the second brings replays with new offsets and very late readings."""
    root = scratch_path(spark, "options").replace("file:", "")
    first = [reading_record(0, 20.0), reading_record(1, 21.0), reading_record(2, 22.0, second=50), (b"k", b"no", "iot-temperature", 0, 3, dt.datetime(2024, 1, 1, 12, tzinfo=UTC)),
             (*reading_record(4, 5.0, device="e")[:5], dt.datetime(2024, 1, 1, 12, tzinfo=UTC))]
    far = json.loads(reading_record(5, 30.0)[1]) | {"event_timestamp": "2024-03-01T00:00:00.000000"}
    second = [(b"d", json.dumps(far).encode(), "iot-temperature", 0, 5, dt.datetime(2024, 3, 1, tzinfo=UTC)), reading_record(8, 20.0), reading_record(9, 20.0),
              reading_record(9, 23.0, second=30)]
    third = [reading_record(10, 24.0, second=31)]
    events = [window_record(0, 1, "opened", 0), window_record(1, 1, "closed", 10)], [window_record(5, 1, "opened", 0), window_record(6, 1, "opened", 1)], []
    for i, (r, w) in enumerate(zip((first, second, third), events)):
        spark.createDataFrame(r, RECORD).coalesce(1).write.parquet(f"{root}/r/{i}")
        spark.createDataFrame(w, RECORD).coalesce(1).write.parquet(f"{root}/w/{i}")
        qs = jobs.start_readings(spark, bus.record_file_stream(spark, f"{root}/r/*"), f"{root}/t", f"{root}/c", jobs.Triggers.available_now(),
                                 amend_late=True, drop_replays=True)
        qs += jobs.start_window_events(spark, bus.record_file_stream(spark, f"{root}/w/*"), f"{root}/t", f"{root}/c", jobs.Triggers.available_now(), "1 minute",
                                       amend_late=True, drop_replays=True)
        for q in qs:
            q.awaitTermination()
            assert q.exception() is None
    t = f"{root}/t"
    stored = spark.read.parquet(f"{t}/temperature_readings")
    assert sorted(x.temperature_celsius for x in stored.collect()) == [5.0, 20.0, 21.0, 22.0, 23.0, 24.0, 30.0]
    assert spark.read.parquet(f"{t}/window_events").count() == 3
    minutes = jobs.merge_table.temperature_table(f"{t}/temperature_aggregations_1min_parts").read(spark)
    assert {(r.device_id, str(r.window_start)): r.reading_count for r in minutes.collect()} == {
        ("d", "2024-01-01 00:00:00"): 7, ("e", "2024-01-01 00:00:00"): 1, ("d", "2024-03-01 00:00:00"): 1}     # all that came, replays and late ones
    hours = jobs.merge_table.event_table(f"{t}/window_aggregations_hourly_parts").read(spark)
    assert {(r.event_type, r.event_count) for r in hours.collect()} == {("opened", 3), ("closed", 1)}
    gaps = [(r.partition, r.kind, r.first_offset, r.last_offset) for r in jobs.offset_audit(spark, t, "temperature_readings").collect()]
    assert gaps == [(0, "gap", 6, 8)]           # 6 and 7 never came, 8 was a replay
    for name in ("temperature_readings", "window_events"):
        assert {r.status for r in jobs.reconcile_tables(spark, t, name).collect()} == {"ok"}

