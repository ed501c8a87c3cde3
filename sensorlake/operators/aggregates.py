"""Tumbling event-time aggregates (G-1..G-4, S-1..S-3), one code path for batch and stream.

Each aggregate is ``groupBy(window(ts, width), keys).agg(...)``: Spark plans a
partial HashAggregate before the shuffle, so a hot device or object is combined
map-side and only one row per (window, key, map task) crosses the network.
On a stream the same plan gets a watermark; in append mode each window is
emitted once, after the watermark passes its end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tumbling:
    width: str          # window length, e.g. "1 minute"
    delay: str          # watermark delay (allowed lateness)
    label: str          # value of the tag column


# Window widths, watermark delays and tag values of the jobs.
READINGS_1MIN = Tumbling("1 minute", "2 minutes", "1_minute")
READINGS_5MIN = Tumbling("5 minutes", "10 minutes", "5_minute")
EVENTS_HOURLY = Tumbling("1 hour", "1 hour", "hourly")
EVENTS_DAILY = Tumbling("1 day", "1 day", "daily")


def _windowed(df: DataFrame, spec: Tumbling, streaming: bool | None) -> DataFrame:
    stream = df.isStreaming if streaming is None else streaming
    return df.withWatermark("event_timestamp", spec.delay) if stream else df


def _split_window(df: DataFrame) -> DataFrame:
    return (df.withColumn("window_start", F.col("window.start"))
              .withColumn("window_end", F.col("window.end"))
              .drop("window"))


def temperature_window_agg(readings: DataFrame, spec: Tumbling = READINGS_1MIN,
                           streaming: bool | None = None) -> DataFrame:
    """Per device and tumbling window: averages, extremes, count and anomalies.

    ``readings`` must carry ``is_anomaly`` (see ``detect_anomalies``). Rows
    without event time fall in no window.
    """
    src = _windowed(readings, spec, streaming)
    agg = src.groupBy(F.window("event_timestamp", spec.width), "device_id").agg(
        F.avg("temperature_celsius").alias("avg_temp_celsius"),
        F.avg("temperature_fahrenheit").alias("avg_temp_fahrenheit"),
        F.max("temperature_celsius").alias("max_temp_celsius"),
        F.min("temperature_celsius").alias("min_temp_celsius"),
        F.count(F.lit(1)).alias("reading_count"),
        F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).cast("long").alias("anomaly_count"),
    )
    return _split_window(agg.withColumn("window_duration", F.lit(spec.label)))


def window_event_agg(events: DataFrame, spec: Tumbling = EVENTS_HOURLY,
                     streaming: bool | None = None) -> DataFrame:
    """Event count per object, event type and tumbling window (epoch/UTC aligned)."""
    src = _windowed(events, spec, streaming)
    agg = src.groupBy(F.window("event_timestamp", spec.width),
                      "object_code", "object_name", "event_type").agg(
        F.count(F.lit(1)).alias("event_count"))
    return _split_window(agg.withColumn("aggregation_period", F.lit(spec.label)))
