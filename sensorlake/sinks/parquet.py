"""Idempotent Parquet sinks for micro-batches (B-8, B-9, B-18, A-10, M-6).

Layout: ``<path>/event_date=<d>/batch_id=<n>/part-*.parquet``. A batch is
written with dynamic partition overwrite, so replaying batch ``n`` after a
failure replaces exactly the files of batch ``n`` -- no duplicates, no loss.
Readers prune on ``event_date`` (partition filter) and on the event time
(Parquet min/max statistics; rows are sorted by key and time within files).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_batch(batch: DataFrame, batch_id: int, path: str,
                time_col: str = "event_timestamp",
                sort_cols: Sequence[str] = (), date_from: Column | None = None) -> None:
    """Write one micro-batch idempotently under ``batch_id=<n>`` partitions, by the date of ``date_from``
    (else of ``time_col``)."""
    out = (batch.withColumn("event_date", F.to_date(F.col(time_col) if date_from is None else date_from))
                .withColumn("batch_id", F.lit(int(batch_id)).cast("long")))
    if sort_cols:
        out = out.sortWithinPartitions(*sort_cols)
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "batch_id")
        .parquet(path))


def batch_writer(path: str, time_col: str = "event_timestamp",
                 sort_cols: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback. Errors propagate so the batch is retried on restart."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, time_col, sort_cols)
    return write


def read_archive(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read the archive back; partition columns ``event_date`` and ``batch_id`` are kept."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_legacy_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archive laid out as ``<path>/batch_<n>/`` (no ``key=value`` folders)."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def compact_date(spark: SparkSession, path: str, day, out_path: str, sort_cols: Sequence[str],
                 target_files: int | None = None) -> int:
    """Rewrite one closed ``event_date`` partition as a few large, range-sorted files.

    Micro-batch sinks leave many small files per day (one folder per batch).
    Once a day can no longer receive replays, its rows are range-partitioned
    on ``sort_cols`` (so files cover disjoint key/time ranges and row-group
    statistics prune well) and written to ``out_path``; the caller swaps the
    folder in. Nothing is read and overwritten at the same path. Returns the
    number of rows written.
    """
    from pyspark.sql import Observation

    src = spark.read.parquet(path).filter(F.col("event_date") == F.lit(day)).drop("batch_id")
    n = target_files or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    obs = Observation(f"compact_{day}")
    # observe after the range shuffle: its sampling job re-reads the input and must not count
    (src.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
        .observe(obs, F.count(F.lit(1)).alias("n"))
        .write.mode("errorifexists").parquet(out_path))
    return int(obs.get["n"])
