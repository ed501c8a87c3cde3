import datetime as dt

from pyspark.sql import functions as F

from sensorlake.functions import codec
from sensorlake.functions.timefmt import parse_day_clock
from sensorlake.operators import quality
from sensorlake.schemas import RECORD


def _records(spark, values, keys=None):
    keys = keys or [None] * len(values)
    rows = [(None if k is None else k.encode(), None if v is None else v.encode(), "t", 0, i,
             dt.datetime(2024, 1, 1)) for i, (k, v) in enumerate(zip(keys, values))]
    return spark.createDataFrame(rows, RECORD)


def test_decode_malformed_probe_null_and_extra_field(spark):
    vals = ["not json", '{"test": "connection"}', None,
            '{"event_timestamp": "2024-01-01T00:00:01", "timestamp": "2030-01-01T00:00:00", '
            '"device_id": "d1", "temperature_celsius": 1.5, "temperature_fahrenheit": 34.7, '
            '"timestamp_epoch": 1704067201}']
    out = quality.label_readings(codec.decode_readings(_records(spark, vals))).orderBy("offset").collect()
    assert [r.quarantine_reason for r in out] == ["malformed_payload"] * 3 + [None]
    assert out[3].event_timestamp == dt.datetime(2024, 1, 1, 0, 0, 1)
    assert out[3].device_id == "d1"


def test_bad_time_is_null_and_quarantined_under_ansi(spark):
    vals = ['{"event_timestamp": "NaT", "device_id": "d", "temperature_celsius": 1, '
            '"temperature_fahrenheit": 2, "timestamp_epoch": 1}',
            '{"event_timestamp": "", "device_id": "d", "temperature_celsius": 1, '
            '"temperature_fahrenheit": 2, "timestamp_epoch": 1}']
    out = quality.label_readings(codec.decode_readings(_records(spark, vals))).collect()
    assert [r.quarantine_reason for r in out] == ["missing_event_timestamp"] * 2


def test_length_rule(spark):
    long_id = "x" * 51
    vals = ['{"event_timestamp": "2024-01-01T00:00:00", "device_id": "%s", "temperature_celsius": 1, '
            '"temperature_fahrenheit": 2, "timestamp_epoch": 1}' % long_id]
    out = quality.label_readings(codec.decode_readings(_records(spark, vals))).collect()
    assert out[0].quarantine_reason == "value_too_long"


def test_window_event_time_from_timestamp_field(spark):
    vals = ['{"timestamp": "2024-01-01T10:00:00", "object_code": 7, "object_name": "w", '
            '"event_type": "opened", "message_type": "window_event"}']
    out = quality.label_window_events(codec.decode_window_events(_records(spark, vals, ["7_opened"]))).collect()
    assert out[0].event_timestamp == dt.datetime(2024, 1, 1, 10)
    assert out[0].quality_status == "valid" and out[0].message_key == "7_opened"


def test_encode_decode_round_trip(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 7, 179575), "device_3", -23.45, -10.21)],
                               "reading_id long, event_timestamp timestamp, device_id string, "
                               "temperature_celsius double, temperature_fahrenheit double")
    back = codec.decode_readings(codec.encode_readings(df)).collect()[0]
    assert back.event_timestamp == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    assert (back.device_id, back.temperature_celsius, back.temperature_fahrenheit) == ("device_3", -23.45, -10.21)
    assert back.message_key == "device_3" and back.message_type == "temperature_reading"


def test_empty_key_is_no_key(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "", 1.0, 2.0)],
                               "event_timestamp timestamp, device_id string, temperature_celsius double, "
                               "temperature_fahrenheit double")
    assert codec.encode_readings(df).collect()[0].key is None


def test_clock_parse_forms(spark):
    df = spark.createDataFrame([("2024-01-05", c) for c in ["3:04:05 PM", "3:04 PM", "03:04 PM", "25:00"]],
                               "d string, c string")
    got = [r.t for r in df.select(parse_day_clock(F.col("d"), F.col("c")).alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 5, 15, 4, 5), dt.datetime(2024, 1, 5, 15, 4),
                   dt.datetime(2024, 1, 5, 15, 4), None]


def test_openings_fan_out_and_midnight(spark):
    df = spark.createDataFrame([("2024-01-05", "11:30 PM", "12:30 AM", 9, "w9")],
                               "DayPST string, StartTimePST string, EndTimePST string, ObjectCode int, ObjectName string")
    parity = {r.event_type: r.event_timestamp for r in codec.openings_to_events(df).collect()}
    assert parity == {"opened": dt.datetime(2024, 1, 5, 23, 30), "closed": dt.datetime(2024, 1, 5, 0, 30)}
    rolled = {r.event_type: r.event_timestamp for r in codec.openings_to_events(df, roll_midnight=True).collect()}
    assert rolled["closed"] == dt.datetime(2024, 1, 6, 0, 30)


def test_bad_opening_day_quarantines_only_its_row(spark):
    df = spark.createDataFrame([("2024-01-05", "1:00 PM", "2:00 PM", 1, "w1"),
                                ("not a day", "1:00 PM", "2:00 PM", 2, "w2")],
                               "DayPST string, StartTimePST string, EndTimePST string, ObjectCode int, ObjectName string")
    ev = codec.openings_to_events(df).withColumn("message_key", F.lit(None).cast("string"))
    for c in ("message_type", "producer_timestamp"):
        ev = ev.withColumn(c, F.lit(None).cast("string"))
    labelled = {(r.object_code, r.event_type): r.quality_status for r in quality.label_window_events(ev).collect()}
    assert labelled == {(1, "opened"): "valid", (1, "closed"): "valid",
                        (2, "opened"): "quarantine", (2, "closed"): "quarantine"}


def test_openings_source_zone(spark):
    df = spark.createDataFrame([("2024-01-05", "1:00 PM", "2:00 PM", 1, "w1")],
                               "DayPST string, StartTimePST string, EndTimePST string, ObjectCode int, ObjectName string")
    got = {r.event_type: r.event_timestamp
           for r in codec.openings_to_events(df, source_tz="America/Los_Angeles").collect()}
    assert got["opened"] == dt.datetime(2024, 1, 5, 21, 0)      # 13:00 PST = 21:00 UTC


def test_readings_csv_bad_time_is_null(spark):
    from sensorlake.session import scratch_path
    from sensorlake.sources import files
    path = scratch_path(spark, "csv-bad")
    spark.createDataFrame([("2024-01-01 00:00:05", "7", 41.0, 5.0), ("NaT", "8", 40.0, 4.4)],
                          "timestamp_utc string, device_id string, temp_f double, temp_c double") \
        .coalesce(1).write.option("header", True).csv(path)
    rows = {r.device_id: r.event_timestamp for r in files.readings_csv(spark, path).collect()}
    assert rows == {"7": dt.datetime(2024, 1, 1, 0, 0, 5), "8": None}


def test_producer_records_round_trip_in_time_order(spark):
    from sensorlake.session import scratch_path
    from sensorlake.streaming import publish
    rpath, opath = scratch_path(spark, "prod-r"), scratch_path(spark, "prod-o")
    spark.createDataFrame([("2024-01-01 00:00:09", "2", 41.0, 5.0), ("2024-01-01 00:00:05", "1", 40.0, 4.4)],
                          "timestamp_utc string, device_id string, temp_f double, temp_c double") \
        .write.option("header", True).csv(rpath)
    spark.createDataFrame([("2024-01-05", "1:00:00 PM", "1:30 PM", 3, "w3"), ("bad", "1:00 PM", "2:00 PM", 4, "w4")],
                          "DayPST string, StartTimePST string, EndTimePST string, ObjectCode int, ObjectName string") \
        .write.option("header", True).csv(opath)
    rec = publish.readings_csv_to_records(spark, rpath)
    back = codec.decode_readings(rec.withColumn("timestamp", F.current_timestamp())).collect()
    assert [(r.message_key, r.event_timestamp.second) for r in back] == [("1", 5), ("2", 9)]
    wrec = publish.openings_csv_to_records(spark, opath)
    wback = codec.decode_window_events(wrec.withColumn("timestamp", F.current_timestamp())).collect()
    assert [(r.message_key, r.event_timestamp.minute) for r in wback] == [("3_opened", 0), ("3_closed", 30)]
