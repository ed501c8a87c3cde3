"""Derive the sensor shapes from the driver's ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` becomes

* readings (R): one temperature reading per event;
* window events (W): ``signup`` -> ``opened``, ``error`` -> ``closed``.

Optional time compression by 60 packs 30 days into 12 hours so minute windows
hold several rows. Every function takes a DataFrame (batch or streaming) and
returns one, so the same derivation feeds batch queries and file streams.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.schemas import READING_MESSAGE_TYPE, WINDOW_MESSAGE_TYPE

# Fixture time origin (2024-01-01T00:00:00Z in microseconds) and
# compression factor.
BASE_MICROS = 1704067200000000
COMPRESSION = 60
#: Which events are window events.
IS_WINDOW_EVENT = "event_type in ('signup', 'error')"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_time(ts: Column, compress: bool) -> Column:
    """``ts`` (TIMESTAMP_NTZ, UTC wall clock) as a TIMESTAMP, optionally compressed."""
    lts = ts.cast("timestamp")
    if not compress:
        return lts
    offset = F.unix_micros(lts) - F.lit(BASE_MICROS)
    # exact integer floor division (no double rounding)
    compressed = F.call_function("div", offset - F.pmod(offset, F.lit(COMPRESSION)), F.lit(COMPRESSION))
    return F.timestamp_micros(F.lit(BASE_MICROS) + compressed)


def instant(ts: dt.datetime, compress: bool) -> dt.datetime:
    """``event_time`` of one value of ``ts``, in Python."""
    epoch = dt.datetime(1970, 1, 1)
    us = (ts - epoch) // dt.timedelta(microseconds=1)
    us = BASE_MICROS + (us - BASE_MICROS) // COMPRESSION if compress else us
    return (epoch + dt.timedelta(microseconds=us)).replace(tzinfo=dt.timezone.utc)


def readings(ev: DataFrame, compress: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Readings fixture: one row per event, ``reading_id`` is a tie-break id.

    ``keep`` names extra ``events`` columns to carry along unchanged.
    """
    celsius = F.col("value") - 30
    fahrenheit = celsius * 9 / 5 + 32 + F.when(F.col("event_type") == "view", 10).otherwise(0)
    return ev.select(
        F.col("event_id").alias("reading_id"),
        event_time(F.col("ts"), compress).alias("event_timestamp"),
        F.concat(F.lit("device_"), (F.col("user_id") % 10).cast("string")).alias("device_id"),
        celsius.alias("temperature_celsius"),
        fahrenheit.alias("temperature_fahrenheit"),
        F.lit(READING_MESSAGE_TYPE).alias("message_type"),
        *keep,
    ).withColumn("timestamp_epoch", F.unix_timestamp("event_timestamp"))


def window_events(ev: DataFrame, compress: bool = False) -> DataFrame:
    """Window open/close events; rows of other event types are not events."""
    return ev.filter(IS_WINDOW_EVENT).select(
        F.col("event_id"),
        event_time(F.col("ts"), compress).alias("event_timestamp"),
        F.col("user_id").cast("int").alias("object_code"),
        F.concat(F.lit("window_"), F.col("user_id").cast("string")).alias("object_name"),
        F.when(F.col("event_type") == "signup", "opened").otherwise("closed").alias("event_type"),
        F.lit(WINDOW_MESSAGE_TYPE).alias("message_type"),
    )


def reading_records(readings_df: DataFrame, partitions: int = 3) -> DataFrame:
    """Readings in the record shape, keyed by device; partition = device number mod ``partitions``, the
    reading's id as offset. The producer time is the event time, so records are reproducible."""
    from sensorlake.functions.codec import encode_readings

    rec = encode_readings(readings_df, producer_time=F.col("event_timestamp"), keep=["reading_id"])
    device_no = F.substring(F.col("key").cast("string"), 8, 12).cast("int")
    return rec.withColumn("partition", F.pmod(device_no, F.lit(partitions))).withColumnRenamed("reading_id", "offset")


def window_event_records(events_df: DataFrame, partitions: int = 3) -> DataFrame:
    """Window events in the record shape, keyed ``<code>_<type>``; partition = code mod ``partitions``,
    the event's id as offset."""
    from sensorlake.functions.codec import encode_window_events

    rec = encode_window_events(events_df, producer_time=F.col("event_timestamp"),
                               keep=["event_id", "object_code"])
    return (rec.withColumn("partition", F.pmod(F.col("object_code"), F.lit(partitions))).drop("object_code")
            .withColumnRenamed("event_id", "offset"))
