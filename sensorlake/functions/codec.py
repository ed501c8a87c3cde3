"""Wire encoding and decoding of sensor messages (C-1..C-13, A-6).

Encoding builds the bus record shape ``key, value`` from typed rows; decoding
turns records back into typed rows with the declared payload schema. Both are
plain projections, so they run inside whole-stage codegen, batch or stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.classify import event_time_for
from sensorlake.functions.timefmt import epoch_seconds, parse_day_clock, parse_iso, to_iso
from sensorlake.schemas import (
    READING_MESSAGE_TYPE,
    READING_PAYLOAD,
    READINGS_TOPIC,
    WINDOW_EVENT_PAYLOAD,
    WINDOW_EVENTS_TOPIC,
    WINDOW_MESSAGE_TYPE,
)


def _key(text: Column) -> Column:
    """Message key as bytes; an empty key is no key (C-12)."""
    return F.nullif(text, F.lit("")).cast("binary")


def encode_readings(readings: DataFrame, producer_time: Column | None = None,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Typed readings -> records keyed by device (C-10..C-13, F-14)."""
    produced = producer_time if producer_time is not None else F.current_timestamp()
    iso = to_iso(F.col("event_timestamp"))
    payload = F.struct(
        iso.alias("event_timestamp"),
        iso.alias("timestamp"),
        epoch_seconds(F.col("event_timestamp")).alias("timestamp_epoch"),
        F.col("device_id").cast("string").alias("device_id"),
        F.col("temperature_fahrenheit").cast("double").alias("temperature_fahrenheit"),
        F.col("temperature_celsius").cast("double").alias("temperature_celsius"),
        F.lit(READING_MESSAGE_TYPE).alias("message_type"),
        to_iso(produced).alias("producer_timestamp"),
    )
    return readings.select(
        _key(F.col("device_id").cast("string")).alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(READINGS_TOPIC).alias("topic"),
        F.col("event_timestamp").alias("timestamp"),
        *keep,
    )


def encode_window_events(events: DataFrame, producer_time: Column | None = None,
                         keep: Sequence[str] = ()) -> DataFrame:
    """Typed window events -> records keyed ``<code>_<event_type>``.

    The payload carries the event time as ``timestamp`` (as producers do).
    """
    produced = producer_time if producer_time is not None else F.current_timestamp()
    payload = F.struct(
        to_iso(F.col("event_timestamp")).alias("timestamp"),
        F.col("object_code").cast("int").alias("object_code"),
        F.col("object_name").alias("object_name"),
        F.col("event_type").alias("event_type"),
        F.lit(WINDOW_MESSAGE_TYPE).alias("message_type"),
        to_iso(produced).alias("producer_timestamp"),
    )
    return events.select(
        _key(F.concat_ws("_", F.col("object_code").cast("string"), F.col("event_type"))).alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(WINDOW_EVENTS_TOPIC).alias("topic"),
        F.col("event_timestamp").alias("timestamp"),
        *keep,
    )


def _decode(records: DataFrame, schema) -> DataFrame:
    return records.select(
        F.col("key").cast("string").alias("message_key"),
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("value").alias("raw_value"),
        F.col("timestamp").alias("kafka_timestamp"),
        *[c for c in ("topic", "partition", "offset") if c in records.columns],
    ).select("message_key", "kafka_timestamp", "raw_value",
             *[c for c in ("topic", "partition", "offset") if c in records.columns], "data.*")


def decode_readings(records: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """Records -> typed readings (A-6, C-1, C-3, C-4, F-1, F-2).

    Malformed JSON gives a row whose payload fields are all NULL; it is kept
    here, its bytes as ``raw_value``, and routed to quarantine by :mod:`sensorlake.operators.quality`.
    """
    processed = processing_time if processing_time is not None else F.current_timestamp()
    return (_decode(records, READING_PAYLOAD)
            .withColumn("event_timestamp", parse_iso(F.col("event_timestamp")))
            .withColumn("producer_timestamp", parse_iso(F.col("producer_timestamp")))
            .withColumn("processing_timestamp", processed))


def decode_window_events(records: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """Records -> typed window events; event time from ``event_timestamp`` or ``timestamp``."""
    processed = processing_time if processing_time is not None else F.current_timestamp()
    return (_decode(records, WINDOW_EVENT_PAYLOAD)
            .withColumn("event_timestamp",
                        parse_iso(F.coalesce(F.col("event_timestamp"), F.col("timestamp"))))
            .drop("timestamp")
            .withColumn("producer_timestamp", parse_iso(F.col("producer_timestamp")))
            .withColumn("processing_timestamp", processed))


def openings_to_events(openings: DataFrame, roll_midnight: bool = False,
                       source_tz: str | None = None) -> DataFrame:
    """One opening row -> an ``opened`` and a ``closed`` event (C-9, F-11, R-5).

    Start and end clock times are read against the same day. With
    ``roll_midnight`` an end before its start moves to the next day. The clock
    columns carry no zone; ``source_tz`` (e.g. ``"America/Los_Angeles"``)
    converts them to UTC, ``None`` keeps the wall-clock values. A bad day or
    clock gives NULL times for that row only (it is quarantined downstream).
    """
    start = parse_day_clock(F.col("DayPST"), F.col("StartTimePST"))
    end = parse_day_clock(F.col("DayPST"), F.col("EndTimePST"))
    if roll_midnight:
        end = F.when(end < start, end + F.expr("INTERVAL 1 DAY")).otherwise(end)
    if source_tz:
        start, end = F.to_utc_timestamp(start, source_tz), F.to_utc_timestamp(end, source_tz)
    parsed = openings.select(
        F.col("ObjectCode").cast("int").alias("object_code"),
        F.col("ObjectName").cast("string").alias("object_name"),
        start.alias("_start"), end.alias("_end"),
        *[c for c in openings.columns if c not in ("DayPST", "StartTimePST", "EndTimePST", "ObjectCode", "ObjectName")],
    )
    kinds = F.explode(F.array(F.lit("opened"), F.lit("closed"))).alias("event_type")
    return (parsed.select("*", kinds)
            .withColumn("event_timestamp", event_time_for(F.col("event_type"), F.col("_start"), F.col("_end")))
            .drop("_start", "_end"))


def in_publish_order(df: DataFrame, order_cols: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Time order for publishing or replay (L-7, L-8) without a single-task global sort.

    Range partitioning (sampled bounds) followed by a sort inside each
    partition: partition i holds earlier rows than partition i+1, so writing
    or publishing partitions in index order yields the global order.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
