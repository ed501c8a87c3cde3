"""Operators that keep tables from batch to batch: amended aggregates, frontiers, identities, newest rows, samples."""
import datetime as dt
import os
import random
import statistics
import time

import pytest
from pyspark.sql import functions as F

from sensorlake.functions.classify import detect_anomalies
from sensorlake.operators import aggregates as agg
from sensorlake.operators import moments, sampling, views
from sensorlake.operators.pairing import first_close_pairs
from sensorlake.session import child_folders, scratch_path
from sensorlake.sources import bus, fixtures as fx
from sensorlake.functions import codec
from sensorlake.streaming import merge_table
from sensorlake.streaming.frontiers import FRONTIER_SCHEMA, PartitionClock, advance
from sensorlake.streaming.identity import IdentityTable
from sensorlake.streaming.kept import LatestTable, RunningSample
from sensorlake.streaming.pairing import stream_first_close_pairs
from sensorlake.streaming.pairing_tables import finish_pairing, start_table_state_pairing
from sensorlake.streaming.pairing_timers import timed_first_close_pairs
from sensorlake.streaming.runner import start_to_parquet, with_rocksdb_state
from tests.conftest import SF_SMALL, ts

D = dt.datetime(2024, 1, 1)


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def one_file_each(spark, folder, frames):
    """One file a frame under ``folder``, with rising modification times, so that each is a micro-batch."""
    base = time.time() - 1000
    for i, df in enumerate(frames):
        df.coalesce(1).write.parquet(f"{folder}/{i:03d}")
        for f in os.listdir(f"{folder}/{i:03d}"):
            if f.endswith(".parquet"):
                os.utime(f"{folder}/{i:03d}/{f}", (base + i * 10, base + i * 10))


# ------------------------------------------------------------------- frontiers

def frontier(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, event_timestamp timestamp, kafka_timestamp timestamp")


def us(t):
    return int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


def test_the_clock_is_the_least_frontier_of_the_active_partitions(spark):
    t = lambda m: D + dt.timedelta(minutes=m)
    none = spark.createDataFrame([], FRONTIER_SCHEMA)
    clock = PartitionClock(idle_seconds=600)
    assert clock.now(none) is None
    one = advance(none, frontier(spark, [("a", 0, t(60), t(100)), ("a", 0, t(50), t(101)), ("a", 1, t(10), t(101))]))
    assert clock.now(one) == us(t(10))
    assert PartitionClock(600, partitions=3).now(one) is None                # a third one may still come
    later = advance(one, frontier(spark, [("a", 0, t(61), t(112))]))
    assert clock.now(later) == us(t(61))                                     # partition 1 sent nothing for 11 minutes
    assert PartitionClock(660, partitions=3).now(later) == us(t(10))         # the third had its time, partition 1 has a little left
    quiet = advance(one, frontier(spark, [("b", 0, None, t(101))]))
    assert clock.now(quiet) is None                                          # alive, but without a time yet
    assert clock.now(advance(quiet, frontier(spark, [("b", 0, t(5), t(102))]))) == us(t(5))
    assert clock.now(advance(none, frontier(spark, [("a", 0, t(3), None)]))) == us(t(3))


def test_a_partition_two_hours_behind_gives_the_batch_pairs_and_nothing_late(spark):
    """Record files of two partitions, openings two hours behind closings; and with one clock for all, events are late."""
    root = scratch_path(spark, "uneven").replace("file:", "")
    w = fx.window_events(fx.events(spark, SF_SMALL), compress=True)
    rec = fx.window_event_records(w).withColumn("partition", F.col("key").cast("string").endswith("_closed").cast("int"))
    sent = F.unix_micros("timestamp") + F.when(F.col("partition") == 0, 7_200_000_000).otherwise(0) - fx.BASE_MICROS
    rec = rec.withColumn("_batch", F.floor(sent / (4 * 3_600_000_000)))
    rec = rec.withColumn("timestamp", F.timestamp_micros(F.lit(fx.BASE_MICROS) + (F.col("_batch") + 1) * (4 * 3_600_000_000)))
    one_file_each(spark, f"{root}/in", [rec.filter(F.col("_batch") == i).select("key", "value", "topic", "partition", "offset", "timestamp")
                                        for i in range(4)])
    late = {}
    for name, clock in (("own", PartitionClock(5 * 3600, 2)), ("one", None)):
        ev = codec.decode_window_events(bus.record_file_stream(spark, f"{root}/in/*", 1))
        q = start_table_state_pairing(ev, f"{root}/{name}", f"{root}/{name}_state", f"{root}/{name}_ckpt", 600, {"availableNow": True}, clock)
        q.awaitTermination()
        assert q.exception() is None
        finish_pairing(ev.schema, spark, f"{root}/{name}", f"{root}/{name}_state")
        finish_pairing(ev.schema, spark, f"{root}/{name}", f"{root}/{name}_state")      # once more: nothing left to settle
        folders = [f"{root}/{name}_late/{b}" for b in child_folders(spark, f"{root}/{name}_late")]
        late[name] = spark.read.parquet(*folders).count() if folders else 0
    columns = ["object_code", "object_name", "opened_at", "closed_at", "duration_seconds", "usage_pattern"]
    expect = first_close_pairs(w).select(*columns)
    assert late["own"] == 0 and late["one"] > 0
    assert same(spark.read.parquet(f"{root}/own").select(*columns), expect)


# ------------------------------------------------------------------- amended aggregates

def readings(spark, rows):
    return detect_anomalies(spark.createDataFrame(
        rows, "device_id string, event_timestamp timestamp, temperature_celsius double, temperature_fahrenheit double"))


def test_late_rows_amend_closed_windows(spark):
    root = scratch_path(spark, "amend").replace("file:", "")
    draw = random.Random(3)
    rows = [(f"d{draw.randrange(3)}", D + dt.timedelta(seconds=draw.randrange(3 * 86400)), float(draw.randrange(-20, 60)), 70.0)
            for _ in range(300)] + [("d0", None, 1.0, 70.0), (None, D, 1.0, 70.0)]
    whole = readings(spark, rows)
    one_file_each(spark, f"{root}/in", [readings(spark, rows[i::5]) for i in range(5)])
    table = merge_table.temperature_table(f"{root}/table")
    src = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    q = merge_table.start_amended(src, table, merge_table.temperature_parts, f"{root}/ckpt", {"availableNow": True}, compact_every=2)
    q.awaitTermination()
    assert q.exception() is None
    expect = agg.temperature_window_agg(whole, agg.READINGS_1MIN, streaming=False)
    view = lambda: merge_table.temperature_view(table.read(spark)).select(*expect.columns)
    rounded = lambda df: df.withColumns({c: F.round(c, 9) for c in ("avg_temp_celsius", "avg_temp_fahrenheit")})
    assert same(rounded(view()), rounded(expect))
    assert len(child_folders(spark, f"{root}/table/base")) == 2
    table.write(merge_table.temperature_parts(readings(spark, rows[4::5])), 4)       # the last batch again
    assert same(rounded(view()), rounded(expect))
    more = readings(spark, [("d0", D + dt.timedelta(seconds=1), 5.0, 70.0)])         # weeks late, as it were
    table.write(merge_table.temperature_parts(more), 9)
    assert same(rounded(view()), rounded(agg.temperature_window_agg(whole.union(more), agg.READINGS_1MIN, streaming=False)))


def test_a_compaction_that_stops_is_not_seen(spark, monkeypatch):
    root = scratch_path(spark, "compact").replace("file:", "")
    table = merge_table.event_table(root)
    ev = spark.createDataFrame([(1, "w", "opened", D + dt.timedelta(minutes=m)) for m in (0, 5, 70)],
                               "object_code int, object_name string, event_type string, event_timestamp timestamp")
    for b in range(3):
        table.write(merge_table.event_parts(ev), b)
    total = lambda: table.read(spark).agg(F.sum("event_count")).first()[0]
    assert total() == 9
    ev.limit(1).write.parquet(f"{root}/base/upto=1/event_date=2024-01-01")           # as a stopped job would leave it
    assert total() == 9
    real, calls = merge_table.delete_path, []

    def stop(spark_, path):
        calls.append(path)
        if "deltas" in path:
            raise RuntimeError("stopped")
        return real(spark_, path)
    assert table.compact(spark, 0) == 1 and total() == 9
    monkeypatch.setattr(merge_table, "delete_path", stop)
    with pytest.raises(RuntimeError):
        table.compact(spark, 1)
    assert total() == 9 and calls
    monkeypatch.setattr(merge_table, "delete_path", real)
    assert table.compact(spark, 2) == 1 and total() == 9
    assert table.compact(spark, 2) == 0 and total() == 9


# ------------------------------------------------------------------- moments

def test_moments_merge_without_cancelling(spark):
    draw = random.Random(8)
    rows = [("a", D + dt.timedelta(seconds=draw.randrange(7 * 3600), microseconds=draw.choice([0, 1, 999_999])), 1e9 + draw.random(), 70.0)
            for _ in range(800)] + [("b", D, 3.0, 70.0), ("c", D + dt.timedelta(hours=3), None, 70.0)]
    r = readings(spark, rows)
    minutes = moments.minute_moments(r).cache()
    hours = moments.hour_moments(minutes).cache()
    for as_of, span in ((D + dt.timedelta(hours=6, minutes=7, seconds=13), dt.timedelta(hours=4, seconds=5)), (D + dt.timedelta(hours=5), moments.HOUR * 5),
                        (D + dt.timedelta(minutes=90), dt.timedelta(seconds=20)), (D + dt.timedelta(days=9), moments.HOUR)):
        got = {x.device_id: x for x in moments.temperature_stats(r, minutes, hours, as_of, span).collect()}
        held = {}
        for device, at, c, _ in rows:
            if as_of - span < at <= as_of:
                held.setdefault(device, []).append(c)
        assert set(got) == set(held)
        for device, values in held.items():
            x, known = got[device], [v for v in values if v is not None]
            assert x.reading_count == len(values) and (x.min_temp_celsius, x.max_temp_celsius) == (min(known, default=None), max(known, default=None))
            if len(known) > 1:
                assert abs(x.avg_temp_celsius - statistics.fmean(known)) < 1e-5
                assert abs(x.stddev_temp_celsius / statistics.stdev(known) - 1) < 1e-6
            else:
                assert x.stddev_temp_celsius is None and x.avg_temp_celsius == (known[0] if known else None)


def test_moments_scan_raw_rows_of_the_edges_only(spark, capsys):
    path = scratch_path(spark, "moment-readings")
    rows = [("a", D + dt.timedelta(minutes=m), float(m % 50), 70.0) for m in range(3000)]
    readings(spark, rows).write.parquet(path)
    r = spark.read.parquet(path)
    minutes = moments.minute_moments(r).cache()
    as_of = D + dt.timedelta(hours=40, minutes=5, seconds=30)
    parts = moments.range_moments(r, minutes, moments.hour_moments(minutes).cache(), as_of - 24 * moments.HOUR, as_of)
    parts.explain("formatted")
    pushed = [x for x in capsys.readouterr().out.splitlines() if "PushedFilters" in x and "event_timestamp" in x]
    assert len(pushed) == 2 and "16:05:30" in pushed[0] and "16:06:00" in pushed[0] and "16:05:00" in pushed[1] and "16:05:30" in pushed[1]
    assert parts.filter("window_start = date_trunc('hour', window_start)").agg(F.sum("rows")).first()[0] > 23 * 60


# ------------------------------------------------------------------- identities

def test_replays_of_any_age_are_known(spark):
    table = IdentityTable(scratch_path(spark, "ids"), ("device_id", "event_timestamp", "v"), blocks=4)
    schema = "device_id string, event_timestamp timestamp, v int, sent int"
    day = lambda n, d="a", v=0, sent=0: (d, D + dt.timedelta(days=n), v, sent)
    batches = [[day(0), day(0, v=1), day(1), (None, None, None, 0)],
               [day(0, sent=1), day(0, "b"), day(20), day(20, sent=1), (None, None, None, 1)],       # replays, and a copy within the batch
               [day(0, sent=2), day(0, v=1, sent=2), day(1, sent=2), day(20, sent=2)],               # weeks later: nothing new
               [day(0, "c"), day(0, "b", sent=3)]]
    stored = []
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        fresh = table.new_rows(df, i)
        stored.append(sorted((str(r.device_id), str(r.event_timestamp), r.v) for r in fresh.collect()))
        table.remember(spark.createDataFrame(fresh.collect(), schema), i)
        again = table.new_rows(df, i)                           # the batch is run again: the same rows are new
        assert sorted((str(r.device_id), str(r.event_timestamp), r.v) for r in again.collect()) == stored[-1]
    assert [len(s) for s in stored] == [4, 2, 0, 1]


def test_a_bloom_hit_that_is_false_loses_no_row(spark):
    table = IdentityTable(scratch_path(spark, "ids-full"), ("k",), day="'d'", blocks=1)
    first = spark.range(60000).select(F.col("id").alias("k"))   # 4 bits each: the one block of 32,768 bits is full
    table.remember(first, 0)
    bits = spark.read.parquet(f"{table.path}/bloom").select(F.expr("bitmap_count(bits)")).first()[0]
    assert bits > 32700
    new = spark.range(50000, 70000).select(F.col("id").alias("k"))
    assert table.new_rows(new, 1).agg(F.count("k"), F.min("k")).first()[:] == (10000, 60000)
    table.remember(table.new_rows(new, 1), 1)
    table.compact_filters(spark, 1)
    assert len(child_folders(spark, f"{table.path}/bloom/day=d")) == 1
    assert table.new_rows(new, 2).count() == 0


# ------------------------------------------------------------------- kept rows

def test_newest_rows_are_kept_whatever_the_order_of_batches(spark):
    draw = random.Random(5)
    rows = [(draw.choice(["a", "b", "c", None]), D + dt.timedelta(seconds=draw.randrange(50)), i) for i in range(80)] + [("d", None, 81)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int")
    newest = {}
    for k, t, v in rows:
        if k not in newest or (t or D.min, v) > (newest[k][0] or D.min, newest[k][1]):
            newest[k] = (t, v)
    for order in ([0, 1, 2, 3], [3, 1, 0, 2]):
        table = LatestTable(scratch_path(spark, "newest"), df.schema, ["k"], ["t", "v"], buckets=4)
        assert table.read(spark).count() == 0
        for b, part in enumerate(order):
            batch = spark.createDataFrame(rows[part::4], df.schema)
            table.apply(batch, b)
            before = sorted(map(str, table.read(spark).collect()))
            table.apply(batch, b)
            assert sorted(map(str, table.read(spark).collect())) == before
        assert {r.k: (r.t, r.v) for r in table.read(spark).collect()} == newest
        assert len(child_folders(spark, f"{table.path}/manifest")) == 2
    table.apply(df.limit(0), 4)
    assert table.read(spark).count() == len(newest)


def test_the_running_sample_is_the_sample_of_everything(spark):
    ids = spark.range(500).select(F.col("id").alias("reading_id"), (F.col("id") * 2).alias("v"))
    sample = RunningSample(scratch_path(spark, "running"), ids.schema, 40, "reading_id", seed=7)
    for b in range(4):
        batch = ids.filter(F.col("reading_id") % 4 == 3 - b)
        sample.apply(batch, b)
        sample.apply(batch, b)
    assert sample.read(spark).collect() == sampling.replay_sample(ids, 40, "reading_id", 7).collect()


def test_the_kept_table_equals_the_view(spark):
    r = detect_anomalies(fx.readings(fx.events(spark, SF_SMALL)))
    view = views.latest_per_device(r)
    rows = r.select(*view.columns, "reading_id")
    table = LatestTable(scratch_path(spark, "kept-view"), rows.schema, ["device_id"], ["event_timestamp", "reading_id"], 8)
    for b in range(3):
        table.apply(rows.filter(F.col("reading_id") % 3 == b), b)
    assert same(table.read(spark).select(*view.columns), view)


# ------------------------------------------------------------------- keyed timers

def test_timers_ignore_arrival_order_and_write_what_is_new(spark):
    root = scratch_path(spark, "timers").replace("file:", "")
    w = fx.window_events(fx.events(spark, SF_SMALL), compress=True).cache()
    w = w.withColumn("object_code", F.col("object_code") % 3).withColumn("object_name", F.concat(F.lit("w"), F.col("event_id") % 2))
    bounds = w.select(F.unix_micros("event_timestamp").alias("u")).approxQuantile("u", [0.25, 0.5, 0.75], 0.0)
    u = F.unix_micros("event_timestamp") + F.when(F.col("event_id") % 7 == 0, 120_000_000).otherwise(0)       # some come a batch later
    number = sum(((u > b).cast("int") for b in bounds), F.lit(0))
    one_file_each(spark, f"{root}/in", [w.filter(number == i) for i in range(4)])
    src = spark.readStream.schema(w.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    with with_rocksdb_state(spark):
        q = start_to_parquet(timed_first_close_pairs(src, "10 minutes", slice_seconds=300), f"{root}/out", f"{root}/ckpt")
        q.awaitTermination()
    assert q.exception() is None
    newest = w.agg(F.max("event_timestamp")).first()[0]
    cut = F.lit(newest - dt.timedelta(minutes=10))
    columns = ["object_code", "object_name", "opened_at", "closed_at"]
    expect = first_close_pairs(w).filter(F.col("closed_at") < cut).select(*columns)
    assert expect.count() > 50
    assert same(spark.read.parquet(f"{root}/out").select(*columns).filter(F.col("closed_at") < cut), expect)


def test_state_written_follows_new_events_not_the_state(spark):
    """One object with 5,000 events waiting, then one event a batch."""
    schema = "object_code int, object_name string, event_type string, event_timestamp timestamp"
    rows = lambda a, b: spark.createDataFrame([(1, "w", "opened", D + dt.timedelta(seconds=i)) for i in range(a, b)], schema)
    root, written = scratch_path(spark, "state-bytes").replace("file:", ""), {}
    one_file_each(spark, f"{root}/in", [rows(0, 5000), rows(5000, 5001), rows(5001, 5002)])
    for name, pairs in (("timers", timed_first_close_pairs), ("arrays", stream_first_close_pairs)):
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
        with with_rocksdb_state(spark):
            q = start_to_parquet(pairs(src, "2 hours"), f"{root}/{name}", f"{root}/{name}_ckpt")
            q.awaitTermination()
        last = [p for p in q.recentProgress if p["numInputRows"] == 1][-1]
        written[name] = last["stateOperators"][0]["customMetrics"]["rocksdbTotalBytesWritten"]
    assert 0 < written["timers"] < 5000 < 50_000 < written["arrays"]


def test_calls_of_the_state_store_follow_parts_not_events(spark):
    """6,000 events of 1,000 objects, each in a time slice of its own: neighbours share a part and a timer."""
    schema = "object_code int, object_name string, event_type string, event_timestamp timestamp"
    root = scratch_path(spark, "state-calls").replace("file:", "")
    events = spark.range(6000).select((F.col("id") % 1000).cast("int").alias("object_code"), F.lit("w").alias("object_name"),
                                      F.when(F.floor(F.col("id") / 1000) % 2 == 0, "opened").otherwise("closed").alias("event_type"),
                                      F.timestamp_seconds(F.lit(1704067200) + 60 * F.col("id")).alias("event_timestamp"))
    late = spark.createDataFrame([(9, "w", "opened", D + dt.timedelta(days=60)), (9, "w", "closed", D)], schema)
    one_file_each(spark, f"{root}/in", [events, late])
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    with with_rocksdb_state(spark):
        q = start_to_parquet(timed_first_close_pairs(src, "10 minutes"), f"{root}/out", f"{root}/ckpt")
        q.awaitTermination()
    steps = [p["stateOperators"][0]["customMetrics"] for p in q.recentProgress if p["stateOperators"]]
    assert spark.read.parquet(f"{root}/out").count() == 3000
    assert 0 < sum(p["numRegisteredTimers"] for p in steps) < 1500 and sum(p["rocksdbPutCount"] for p in steps) < 10_000


def test_openings_wait_in_parts_until_a_closing(spark):
    """Openings of two objects over many batches fill parts; the first closing answers all of one object's, late or not in order."""
    schema = "object_code int, object_name string, event_type string, event_timestamp timestamp"
    root = scratch_path(spark, "waiting").replace("file:", "")
    at = lambda i: D + dt.timedelta(minutes=i)
    batches = [[(1 + k % 2, f"n{i}.{k}" if k % 5 else None, "opened", at(10 * i + k % 7)) for k in range(50)] for i in range(5)]
    batches += [[(1, "w", "closed", at(100))], [(2, "w", "opened", at(200))], [(1, "w", "closed", at(201)), (2, "w", "closed", at(200))],
                [(3, "w", "opened", at(500))]]
    one_file_each(spark, f"{root}/in", [spark.createDataFrame(b, schema) for b in batches])
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    with with_rocksdb_state(spark):
        q = start_to_parquet(timed_first_close_pairs(src, "1 minute", buckets=1), f"{root}/out", f"{root}/ckpt")
        q.awaitTermination()
    assert q.exception() is None
    opened = [r for b in batches[:5] for r in b]
    expect = sorted([(1, n or "", str(u), str(at(100))) for c, n, _, u in opened if c == 1] + [(2, n or "", str(u), str(at(200))) for c, n, _, u in opened if c == 2])
    assert sorted((r.object_code, r.object_name or "", str(r.opened_at), str(r.closed_at)) for r in spark.read.parquet(f"{root}/out").collect()) == expect


def test_a_closing_at_the_instant_of_an_opening_does_not_answer_it(spark):
    root = scratch_path(spark, "ties").replace("file:", "")
    rows = [(1, "w", "opened", ts("2024-01-01 00:00:00"), 1), (1, "w", "closed", ts("2024-01-01 00:00:00"), 2),
            (1, "w", "opened", ts("2024-01-01 00:00:00"), 3), (1, "w", "closed", ts("2024-01-01 00:00:01"), 4),
            (1, None, "opened", ts("2024-01-01 00:00:02"), 5), (None, "x", "opened", ts("2024-01-01 00:00:02"), 6),
            (1, "w", "broken", ts("2024-01-01 00:00:03"), 7), (1, "w", "closed", None, 8)]
    schema = "object_code int, object_name string, event_type string, event_timestamp timestamp, event_id long"
    later = [(9, "z", "opened", ts("2024-01-01 09:00:00"), 9)]
    one_file_each(spark, f"{root}/in", [spark.createDataFrame(rows, schema), spark.createDataFrame(later, schema),
                                        spark.createDataFrame([(1, "w", "closed", ts("2024-01-01 09:00:00"), 10)], schema),
                                        spark.createDataFrame([(9, "z", "closed", ts("2024-01-01 20:00:00"), 11)], schema)])
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    with with_rocksdb_state(spark):
        q = start_to_parquet(timed_first_close_pairs(src, "1 minute"), f"{root}/out", f"{root}/ckpt")
        q.awaitTermination()
    got = sorted((r.object_code, r.object_name or "", str(r.opened_at), str(r.closed_at)) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [(1, "", "2024-01-01 00:00:02", "2024-01-01 09:00:00"),
                   (1, "w", "2024-01-01 00:00:00", "2024-01-01 00:00:01"), (1, "w", "2024-01-01 00:00:00", "2024-01-01 00:00:01")]
