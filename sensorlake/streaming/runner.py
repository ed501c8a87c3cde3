"""Run streaming queries into Parquet tables (S-3, S-5, S-6).

Queries write to the built-in Parquet file sink (append mode, exactly-once via
the sink's metadata log) or through ``foreachBatch`` writers; state and
progress live under ``checkpointLocation`` in the shared checkpoint folder.
``availableNow`` processes everything present and stops -- the backfill and
test trigger; production jobs pass ``processingTime`` triggers instead.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sensorlake.session import scratch_path, use_rocksdb_state


@contextmanager
def partitions_for_new_queries(spark: SparkSession, n: int | None):
    """Shuffle/state partition count for queries started (and awaited) inside the block."""
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if n:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


@contextmanager
def with_rocksdb_state(spark: SparkSession):
    """RocksDB as the state store of queries started (and awaited) inside the block."""
    key = "spark.sql.streaming.stateStore.providerClass"
    previous = spark.conf.get(key)
    use_rocksdb_state(spark)
    try:
        yield
    finally:
        spark.conf.set(key, previous)


def start_to_parquet(df: DataFrame, path: str, checkpoint: str, name: str | None = None,
                     trigger: dict | None = None, partition_by: list[str] | None = None) -> StreamingQuery:
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def start_console(df: DataFrame, name: str, checkpoint: str, trigger: dict | None = None,
                  rows: int = 20) -> StreamingQuery:
    """Debug stream to the driver log (B-10 alerts, B-11 all events); never a data path."""
    return (df.writeStream.format("console").queryName(name).outputMode("append")
            .option("truncate", False).option("numRows", rows)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def run_available_now(df: DataFrame, name: str, state_partitions: int | None = None) -> str:
    """Process all available input of ``df`` into a fresh Parquet folder; return its path.

    ``state_partitions`` sets the shuffle/state partition count this query is
    created with (a stateful query keeps it for its lifetime); the session
    setting is restored after the run.
    """
    spark = df.sparkSession
    out = scratch_path(spark, f"{name}-out")
    with partitions_for_new_queries(spark, state_partitions):
        q = start_to_parquet(df, out, scratch_path(spark, f"{name}-ckpt"))
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return out


def materialize(spark: SparkSession, df: DataFrame, name: str, schema=None,
                state_partitions: int | None = None) -> DataFrame:
    """Run a streaming DataFrame to completion (``availableNow``) and read the table back."""
    out = run_available_now(df, name, state_partitions)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(out)


def await_all(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None,
              poll_seconds: float = 1.0) -> None:
    """Block until every query has stopped; the first failure stops the rest and is raised (S-8).

    Polls each query instead of ``streams.awaitAnyTermination``, which returns
    at once if any earlier query of the session has terminated.
    """
    import time

    deadline = None if timeout is None else time.monotonic() + timeout
    pending = list(queries)
    while pending:
        for q in pending:
            err = q.exception()
            if err is not None:
                for other in queries:
                    if other.isActive:
                        other.stop()
                raise RuntimeError(f"streaming query {q.name or q.id} failed: {err}")
        pending = [q for q in pending if q.isActive]
        if not pending or (deadline is not None and time.monotonic() >= deadline):
            return
        pending[0].awaitTermination(poll_seconds)
