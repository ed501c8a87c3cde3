"""Serving queries relative to an explicit ``as_of`` instant (N-1, G-5..G-9, D-3, D-4, L-*).

The original queries use ``NOW()``; here ``as_of`` is a parameter:
a Python ``datetime`` (UTC if it names no zone), a Column, or ``None`` for "the newest event time in the
input", which Spark evaluates once as a scalar subquery (a global partial
aggregate) inside the same plan. Strict ``>`` (views) and inclusive ``>=``
(dashboard panels) are kept apart on purpose.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.timefmt import utc_literal

AsOf = Column | _dt.datetime | None


def resolve_as_of(df: DataFrame, as_of: AsOf, col: str = "event_timestamp") -> Column:
    if as_of is None:
        return df.select(F.max(col)).scalar()
    if isinstance(as_of, Column):
        return as_of
    return utc_literal(as_of)


def since(df: DataFrame, as_of: AsOf, interval: str, col: str = "event_timestamp",
          inclusive: bool = True, date_col: str = "event_date") -> DataFrame:
    """Rows with ``col >= as_of - interval`` (or ``>`` when not inclusive).

    On tables partitioned by ``date_col`` (the archive layout) the same bound
    is also applied to the date, so whole date folders are pruned before any
    file is opened; Spark does not derive one filter from the other.
    """
    start = resolve_as_of(df, as_of, col) - F.expr(f"INTERVAL {interval}")
    cond = F.col(col) >= start if inclusive else F.col(col) > start
    if date_col in df.columns:
        cond = cond & (F.col(date_col) >= F.to_date(start))
    return df.filter(cond)


def latest_per_device(readings: DataFrame) -> DataFrame:
    """Newest reading per device (N-1); ties on time broken by ``reading_id``.

    ``max_by`` is an ordinary aggregate: partial per map task, so a device
    holding a third of all rows costs one small state per task, not one task.
    """
    cols = ["temperature_celsius", "temperature_fahrenheit", "event_timestamp",
            "is_anomaly", "anomaly_type"]
    order = F.struct("event_timestamp", "reading_id")
    return (readings.groupBy("device_id")
            .agg(F.max_by(F.struct(*cols), order).alias("latest"))
            .select("device_id", *[F.col(f"latest.{c}").alias(c) for c in cols]))


def temperature_stats(readings: DataFrame, as_of: AsOf = None, interval: str = "24 HOURS") -> DataFrame:
    """Per-device statistics over the strict trailing range (G-5)."""
    recent = since(readings, as_of, interval, inclusive=False)
    return recent.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.avg("temperature_celsius").alias("avg_temp_celsius"),
        F.min("temperature_celsius").alias("min_temp_celsius"),
        F.max("temperature_celsius").alias("max_temp_celsius"),
        F.stddev_samp("temperature_celsius").alias("stddev_temp_celsius"),
        F.count(F.when(F.col("is_anomaly"), 1)).alias("anomaly_count"),
    )


def window_activity(events: DataFrame, as_of: AsOf = None, interval: str = "7 DAYS") -> DataFrame:
    """Total / open / close counts per object and day over the strict trailing range (G-6)."""
    recent = since(events, as_of, interval, inclusive=False)
    return recent.groupBy("object_code", "object_name",
                          F.date_trunc("day", "event_timestamp").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count(F.when(F.col("event_type") == "opened", 1)).alias("open_events"),
        F.count(F.when(F.col("event_type") == "closed", 1)).alias("close_events"),
    ).select("object_code", "object_name", "total_events", "open_events", "close_events", "activity_date")


def recent_readings(readings: DataFrame, as_of: AsOf = None, interval: str = "1 HOUR") -> DataFrame:
    """Dashboard series: readings in the inclusive trailing range, by time (D-3, L-1)."""
    return (since(readings, as_of, interval)
            .select(F.col("event_timestamp").alias("time"), "temperature_celsius", "device_id")
            .orderBy("time"))


def anomaly_count(readings: DataFrame, as_of: AsOf = None, interval: str = "1 HOUR") -> DataFrame:
    """Number of anomalous readings in the inclusive trailing range (G-7)."""
    return (since(readings, as_of, interval).filter(F.col("is_anomaly"))
            .agg(F.count(F.lit(1)).alias("anomalies_last_hour")))


def recent_aggregates(aggs: DataFrame, as_of: Column, interval: str = "2 HOURS") -> DataFrame:
    """1-minute aggregates whose window starts in the trailing range (D-3, L-2)."""
    start = as_of - F.expr(f"INTERVAL {interval}")
    return (aggs.filter(F.col("window_start") >= start)
            .select(F.col("window_start").alias("time"), "avg_temp_celsius", "device_id")
            .orderBy("time"))


def activity_by_object(events: DataFrame, as_of: AsOf = None, interval: str = "24 HOURS") -> DataFrame:
    """Event count per object name, busiest first (G-8)."""
    return (since(events, as_of, interval).groupBy("object_name")
            .agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(F.desc("event_count")))


def events_by_hour_and_type(events: DataFrame, as_of: AsOf = None, interval: str = "24 HOURS") -> DataFrame:
    """Event count per hour and event type (G-9, F-7)."""
    return (since(events, as_of, interval)
            .groupBy(F.date_trunc("hour", "event_timestamp").alias("time"), "event_type")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("time"))


def newest_readings(readings: DataFrame, n: int = 5) -> DataFrame:
    """Top-n newest readings (L-6): a bounded top-k, planned as TakeOrderedAndProject."""
    return (readings.orderBy(F.desc("event_timestamp"), F.desc("reading_id")).limit(n)
            .select("reading_id", "device_id", "temperature_celsius", "event_timestamp", "is_anomaly"))


# Names of the serving views.
VIEW_NAMES = ("latest_temperature_readings", "temperature_stats_24h", "window_activity_7d")


def register_views(readings: DataFrame, events: DataFrame, as_of: AsOf = None) -> None:
    """Named views for SQL users (M-2): ``SELECT * FROM temperature_stats_24h``."""
    latest_per_device(readings).createOrReplaceTempView(VIEW_NAMES[0])
    temperature_stats(readings, as_of).createOrReplaceTempView(VIEW_NAMES[1])
    window_activity(events, as_of).createOrReplaceTempView(VIEW_NAMES[2])
