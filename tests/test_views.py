import datetime as dt

from sensorlake.functions.classify import detect_anomalies
from sensorlake.operators import retention, views

SCHEMA = ("reading_id long, device_id string, event_timestamp timestamp, "
          "temperature_celsius double, temperature_fahrenheit double")
T0 = dt.datetime(2024, 1, 2, 12, 0, 0)


def _readings(spark, rows):
    return detect_anomalies(spark.createDataFrame(rows, SCHEMA))


def test_latest_tie_breaks_by_id(spark):
    r = _readings(spark, [(1, "a", T0, 1.0, 2.0), (2, "a", T0, 5.0, 6.0), (3, "a", T0 - dt.timedelta(1), 9.0, 9.0)])
    row = views.latest_per_device(r).collect()[0]
    assert row.temperature_celsius == 5.0


def test_stddev_of_single_row_is_null(spark):
    r = _readings(spark, [(1, "a", T0, 1.0, 2.0)])
    assert views.temperature_stats(r, T0).collect()[0].stddev_temp_celsius is None


def test_range_boundaries_views_strict_panels_inclusive(spark):
    edge = T0 - dt.timedelta(hours=24)
    r = _readings(spark, [(1, "a", edge, 1.0, 2.0), (2, "a", T0, 1.0, 2.0)])
    assert views.temperature_stats(r, T0).collect()[0].reading_count == 1          # '>' excludes the edge
    assert views.since(r, T0, "24 HOURS").count() == 2                             # '>=' includes it


def test_retention_keeps_row_at_cutoff(spark):
    cut = T0 - dt.timedelta(days=30)
    r = _readings(spark, [(1, "a", cut, 1.0, 2.0), (2, "a", cut - dt.timedelta(seconds=1), 1.0, 2.0),
                          (3, "a", T0, 1.0, 2.0)])
    assert sorted(x.reading_id for x in retention.kept_rows(r, T0, 30).collect()) == [1, 3]
    m = retention.cleanup_metric(r, T0, 30).collect()[0]
    assert (m.metric_name, m.metric_value, m.metric_unit, m.tags) == (
        "data_cleanup_temp_readings", 1.0, "rows_deleted", '{"days_to_keep":30}')


def test_newest_is_a_bounded_top_k(spark):
    r = _readings(spark, [(i, "a", T0 + dt.timedelta(seconds=i), 1.0, 2.0) for i in range(20)])
    top = views.newest_readings(r, 5)
    assert [x.reading_id for x in top.collect()] == [19, 18, 17, 16, 15]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_named_views_answer_sql(spark):
    r = _readings(spark, [(1, "a", T0, 1.0, 2.0), (2, "b", T0, 50.0, 122.0)])
    ev = spark.createDataFrame([(1, "w1", "opened", T0)],
                               "object_code int, object_name string, event_type string, event_timestamp timestamp")
    views.register_views(r, ev, T0 + dt.timedelta(minutes=1))
    rows = spark.sql("SELECT device_id, anomaly_count FROM temperature_stats_24h ORDER BY device_id").collect()
    assert [(x.device_id, x.anomaly_count) for x in rows] == [("a", 0), ("b", 1)]
    assert spark.sql("SELECT * FROM window_activity_7d").first().open_events == 1


def test_metric_rows_shape(spark):
    from sensorlake.operators.metrics import metric_rows
    m = metric_rows(spark, [("views_created", 3, "count", {"type": "monitoring_views"})], T0).first()
    assert (m.metric_name, m.metric_value, m.tags) == ("views_created", 3.0, '{"type":"monitoring_views"}')


def test_literal_as_of_reaches_the_parquet_scan(spark):
    from sensorlake.session import scratch_path
    path = scratch_path(spark, "pushdown")
    _readings(spark, [(i, "a", T0 - dt.timedelta(hours=i), 1.0, 2.0) for i in range(48)]).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = views.temperature_stats(stored, T0)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(event_timestamp" in plan
    assert views.temperature_stats(stored, T0).first().reading_count == 24


def test_date_partitions_pruned_for_trailing_ranges(spark):
    from sensorlake.session import scratch_path
    from sensorlake.sinks import parquet
    path = scratch_path(spark, "pruned")
    r = _readings(spark, [(i, "a", T0 - dt.timedelta(hours=6 * i), 1.0, 2.0) for i in range(20)])
    parquet.write_batch(r, 0, path)
    stored = parquet.read_archive(spark, path)
    q = views.temperature_stats(stored, T0)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan
    assert q.first().reading_count == 4        # 0, 6, 12, 18 hours back; 24 h is excluded
