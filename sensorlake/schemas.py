"""Declared schemas: wire payloads, input files, record shape and tables (M-1)."""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Topic names and message types used on the wire.
READINGS_TOPIC = "iot-temperature"
WINDOW_EVENTS_TOPIC = "iot-window-events"
READING_MESSAGE_TYPE = "temperature_reading"
WINDOW_MESSAGE_TYPE = "window_event"


def _fields(*spec):
    return StructType([StructField(n, t, True) for n, t in spec])


# JSON payload of a temperature reading. The wire also carries a duplicate
# ``timestamp`` field, which is ignored for readings.
READING_PAYLOAD = _fields(
    ("event_timestamp", StringType()),
    ("timestamp_epoch", LongType()),
    ("device_id", StringType()),
    ("temperature_fahrenheit", DoubleType()),
    ("temperature_celsius", DoubleType()),
    ("message_type", StringType()),
    ("producer_timestamp", StringType()),
)

# JSON payload of a window open/close event. Producers send ``timestamp``; the
# declared field is ``event_timestamp``. Both are decoded and coalesced.
WINDOW_EVENT_PAYLOAD = _fields(
    ("event_timestamp", StringType()),
    ("timestamp", StringType()),
    ("object_code", IntegerType()),
    ("object_name", StringType()),
    ("event_type", StringType()),
    ("message_type", StringType()),
    ("producer_timestamp", StringType()),
)

# Shape of a message-bus record (what the Kafka source yields).
RECORD = _fields(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
)

# Input CSV files (read with an explicit schema, no inference).
READINGS_CSV = _fields(
    ("timestamp_utc", StringType()),
    ("device_id", StringType()),
    ("temp_f", DoubleType()),
    ("temp_c", DoubleType()),
)
OPENINGS_CSV = _fields(
    ("DayPST", StringType()),
    ("StartTimePST", StringType()),
    ("EndTimePST", StringType()),
    ("ObjectCode", IntegerType()),
    ("ObjectName", StringType()),
)

# Where a record stood on the bus: the identity of a reading or event (a device may report twice in an instant).
BUS_POSITION = ("topic", "partition", "offset")
_POSITION = (("topic", StringType()), ("partition", IntegerType()), ("offset", LongType()))

# Tables written by the jobs (surrogate ids replaced by natural keys).
TEMPERATURE_READINGS = _fields(
    ("timestamp_epoch", LongType()),
    ("device_id", StringType()),
    ("temperature_fahrenheit", DoubleType()),
    ("temperature_celsius", DoubleType()),
    ("message_type", StringType()),
    ("producer_timestamp", TimestampType()),
    ("event_timestamp", TimestampType()),
    ("processing_timestamp", TimestampType()),
    ("is_anomaly", BooleanType()),
    ("anomaly_type", StringType()),
    ("kafka_timestamp", TimestampType()),
    ("message_key", StringType()),
    *_POSITION,
)

WINDOW_EVENTS = _fields(
    ("object_code", IntegerType()),
    ("object_name", StringType()),
    ("event_type", StringType()),
    ("message_type", StringType()),
    ("producer_timestamp", TimestampType()),
    ("event_timestamp", TimestampType()),
    ("processing_timestamp", TimestampType()),
    ("kafka_timestamp", TimestampType()),
    ("message_key", StringType()),
    *_POSITION,
)

# One shape each for the 1- and 5-minute, and for the hourly and daily tables.
TEMPERATURE_AGGREGATIONS = _fields(
    ("device_id", StringType()),
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("window_duration", StringType()),
    ("avg_temp_celsius", DoubleType()),
    ("avg_temp_fahrenheit", DoubleType()),
    ("max_temp_celsius", DoubleType()),
    ("min_temp_celsius", DoubleType()),
    ("reading_count", LongType()),
    ("anomaly_count", LongType()),
    ("created_at", TimestampType()),
)

WINDOW_AGGREGATIONS = _fields(
    ("object_code", IntegerType()),
    ("object_name", StringType()),
    ("event_type", StringType()),
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("aggregation_period", StringType()),
    ("event_count", LongType()),
    ("created_at", TimestampType()),
)

WINDOW_DURATIONS = _fields(
    ("object_code", IntegerType()),
    ("object_name", StringType()),
    ("opened_at", TimestampType()),
    ("closed_at", TimestampType()),
    ("duration_seconds", LongType()),
    ("duration_minutes", DoubleType()),
    ("usage_pattern", StringType()),
    ("is_unusual", BooleanType()),
    ("processing_timestamp", TimestampType()),
)

SYSTEM_METRICS = _fields(
    ("metric_name", StringType()),
    ("metric_value", DoubleType()),
    ("metric_unit", StringType()),
    ("tags", StringType()),
    ("timestamp", TimestampType()),
)

# Name -> (schema, key that a row is known by, time column) of every stored table.
TABLES = {
    "temperature_readings": (TEMPERATURE_READINGS, BUS_POSITION, "event_timestamp"),
    "window_events": (WINDOW_EVENTS, BUS_POSITION, "event_timestamp"),
    "temperature_aggregations_1min": (TEMPERATURE_AGGREGATIONS, ("device_id", "window_start"), "window_start"),
    "temperature_aggregations_5min": (TEMPERATURE_AGGREGATIONS, ("device_id", "window_start"), "window_start"),
    "window_aggregations_hourly": (WINDOW_AGGREGATIONS, ("object_code", "object_name", "event_type", "window_start"),
                                   "window_start"),
    "window_aggregations_daily": (WINDOW_AGGREGATIONS, ("object_code", "object_name", "event_type", "window_start"),
                                  "window_start"),
    "window_durations": (WINDOW_DURATIONS, ("object_code", "opened_at", "closed_at"), "opened_at"),
    "system_metrics": (SYSTEM_METRICS, ("metric_name", "timestamp", "tags"), "timestamp"),
}

# Column length limits of the sink tables (quality rule Q-3).
# VARCHAR sizes of the original sink tables.
MAX_LENGTH = {
    "device_id": 50,
    "message_type": 50,
    "anomaly_type": 20,
    "message_key": 100,
    "object_name": 100,
    "event_type": 20,
}
