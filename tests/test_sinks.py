import datetime as dt

from pyspark.sql import functions as F

from sensorlake.sinks import audit, parquet
from sensorlake.session import scratch_path


def test_replayed_batch_adds_no_rows(spark):
    path = scratch_path(spark, "idem")
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 3)) for i in range(10)],
                               "id long, event_timestamp timestamp")
    parquet.write_batch(df, 0, path)
    parquet.write_batch(df.filter("id < 5"), 1, path)
    parquet.write_batch(df.filter("id < 5"), 1, path)   # retry of batch 1
    back = parquet.read_archive(spark, path)
    assert back.count() == 15
    assert back.filter(F.col("batch_id") == 1).count() == 5
    # date partition pruning is available to readers
    plan = back.filter(F.col("event_date") == dt.date(2024, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan


def test_audit_counts_the_written_rows_without_a_second_job(spark):
    path = scratch_path(spark, "audit")
    df = spark.range(123).select(F.col("id"), F.lit(dt.datetime(2024, 1, 1)).alias("event_timestamp"))
    rec = audit.observed_write(df, 7, "t", parquet.batch_writer(path))
    assert rec == {"target": "t", "batch_id": 7, "row_count": 123}


def test_legacy_batch_folders_are_readable(spark):
    path = scratch_path(spark, "legacy")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).write.parquet(f"{path}/batch_{i}")
    assert parquet.read_legacy_archive(spark, path).count() == 30


def test_retention_touches_expired_and_boundary_dates_only(spark):
    import os
    from sensorlake.operators import retention
    src, metrics = scratch_path(spark, "ret-src"), scratch_path(spark, "ret-metrics")
    as_of = dt.datetime(2024, 1, 31, 12, tzinfo=dt.timezone.utc)
    ages = [0, 1, 10, 29, 29.9, 30, 30.2, 31, 45]
    rows = [(i, as_of - dt.timedelta(days=d)) for i, d in enumerate(ages)] + [(99, None)]
    parquet.write_batch(spark.createDataFrame(rows, "id long, event_timestamp timestamp"), 3, src)
    root = src.replace("file:", "")

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root)
                for f in names if f.endswith(".parquet")}

    before = files()
    assert retention.apply_retention(spark, src, metrics, as_of, 30) == 3
    after = files()
    left = {r.id: r.batch_id for r in spark.read.parquet(src).collect()}
    assert left == {i: 3 for i, d in enumerate(ages) if d <= 30} | {99: 3}
    kept = {f for f in before if "event_date=2024-01-01" not in f and f in after}
    assert len(kept) == 5 and all(after[f] == before[f] for f in kept)
    assert [(r.metric_name, r.metric_value, r.tags) for r in spark.read.parquet(metrics).collect()] == [
        ("data_cleanup_temp_readings", 3.0, '{"days_to_keep":30}')]
    assert retention.apply_retention(spark, src, metrics, as_of, 30) == 0       # a second run finds nothing
    assert {r.id for r in spark.read.parquet(src).collect()} == set(left)


def test_compact_date_rewrites_one_day_sorted(spark):
    path, out = scratch_path(spark, "cmp-src"), scratch_path(spark, "cmp-dst")
    day = dt.date(2024, 1, 2)
    for b in range(6):
        rows = [(i + 100 * b, f"d{i % 3}", dt.datetime(2024, 1, 2, b, i)) for i in range(20)]
        parquet.write_batch(spark.createDataFrame(rows, "id long, device_id string, event_timestamp timestamp"), b, path)
    parquet.write_batch(spark.createDataFrame([(999, "d0", dt.datetime(2024, 1, 3))],
                                              "id long, device_id string, event_timestamp timestamp"), 6, path)
    n = parquet.compact_date(spark, path, day, out, ["device_id", "event_timestamp"], target_files=2)
    back = spark.read.parquet(out)
    assert n == 120 == back.count()
    assert back.select(F.input_file_name()).distinct().count() <= 2


def test_size_strings_and_scratch_deletion(spark):
    import os
    from sensorlake.session import delete_path, size_bytes
    assert size_bytes("64m") == 64 << 20 and size_bytes("128MB") == 128 << 20
    assert size_bytes("1g") == 1 << 30 and size_bytes("1048576") == 1048576
    path = scratch_path(spark, "del")
    spark.range(3).write.parquet(path)
    assert delete_path(spark, path)
    assert not os.path.exists(path.replace("file:", ""))
