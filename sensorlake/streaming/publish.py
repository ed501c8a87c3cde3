"""Producer side as Spark jobs: input files -> keyed JSON records in time order (B-12, L-7, L-8).

The data work of the replay producer -- parse the CSV inputs, build messages,
key them, fan openings out to opened/closed events and publish in event-time
order -- without its paced, endless single-machine loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions import codec
from sensorlake.operators.metrics import load_counts
from sensorlake.sinks import bus as bus_sink
from sensorlake.sources import files


def readings_csv_to_records(spark: SparkSession, path: str, producer_time: Column | None = None) -> DataFrame:
    """Readings CSV -> bus records keyed by device, range-partitioned and sorted by event time."""
    r = files.readings_csv(spark, path)
    rec = codec.encode_readings(r, producer_time=producer_time, keep=["event_timestamp"])
    return codec.in_publish_order(rec, ["event_timestamp"]).drop("event_timestamp")


def openings_csv_to_records(spark: SparkSession, path: str, producer_time: Column | None = None,
                            roll_midnight: bool = False, source_tz: str | None = None) -> DataFrame:
    """Openings CSV -> one opened and one closed record per row, merged in event-time order."""
    ev = codec.openings_to_events(files.openings_csv(spark, path), roll_midnight, source_tz)
    ev = ev.filter(F.col("event_timestamp").isNotNull())   # the others: see unparseable_openings
    rec = codec.encode_window_events(ev, producer_time=producer_time, keep=["event_timestamp"])
    return codec.in_publish_order(rec, ["event_timestamp"]).drop("event_timestamp")


def unparseable_openings(spark: SparkSession, path: str, roll_midnight: bool = False,
                         source_tz: str | None = None) -> DataFrame:
    """The events of the openings CSV that have no time to be published at, to be stored and looked into."""
    ev = codec.openings_to_events(files.openings_csv(spark, path), roll_midnight, source_tz)
    return ev.filter(F.col("event_timestamp").isNull())


def loaded_rows(spark: SparkSession, readings_path: str | None, openings_path: str | None, at: Column | None = None) -> DataFrame:
    """How many rows each input file holds, as metric rows (G-12)."""
    inputs = {"readings": readings_path and files.readings_csv(spark, readings_path),
              "openings": openings_path and files.openings_csv(spark, openings_path)}
    return load_counts({k: df for k, df in inputs.items() if df is not None}, F.current_timestamp() if at is None else at)


def publish_csv(spark: SparkSession, readings_path: str | None, openings_path: str | None,
                servers: str, rejects_path: str | None = None, metrics_path: str | None = None) -> None:
    """Publish both inputs to their topics (needs the Kafka connector on the classpath); openings
    without a time are stored under ``rejects_path``, the numbers of rows loaded appended to ``metrics_path``."""
    if metrics_path and (readings_path or openings_path):
        loaded_rows(spark, readings_path, openings_path).coalesce(1).write.mode("append").parquet(metrics_path)
    if openings_path and rejects_path:
        unparseable_openings(spark, openings_path).write.mode("overwrite").parquet(rejects_path)
    if readings_path:
        bus_sink.publish(readings_csv_to_records(spark, readings_path), servers)
    if openings_path:
        bus_sink.publish(openings_csv_to_records(spark, openings_path), servers)
