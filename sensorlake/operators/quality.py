"""Sink constraints as an explicit quality step (Q-1..Q-4, T2, W5).

Decoded rows are labelled ``valid`` or ``quarantine`` with the first failing
rule as reason; nothing is dropped. Both sides are the same DataFrame split by
one predicate, so the check is a projection inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.schemas import MAX_LENGTH, READING_MESSAGE_TYPE, WINDOW_MESSAGE_TYPE

# Reason labels, in the order the rules are applied.
MALFORMED = "malformed_payload"
BAD_EVENT_TIME = "missing_event_timestamp"
MISSING_REQUIRED = "missing_required_field"
TOO_LONG = "value_too_long"
BAD_EVENT_TYPE = "unknown_event_type"
NON_FINITE = "non_finite_value"

READING_FIELDS = ("device_id", "temperature_celsius", "temperature_fahrenheit",
                  "timestamp_epoch", "message_type", "producer_timestamp")
READING_REQUIRED = ("device_id", "temperature_celsius", "temperature_fahrenheit", "timestamp_epoch")
WINDOW_FIELDS = ("object_code", "object_name", "event_type", "message_type", "producer_timestamp")
WINDOW_REQUIRED = ("object_code", "object_name", "event_type")


def _all_null(cols) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNull()
    return cond


def _any_null(cols) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def _non_finite() -> Column:
    """NaN or an infinity in a temperature: JSON readers accept both, and one would spoil a whole average."""
    cond = F.lit(False)
    for c in ("temperature_celsius", "temperature_fahrenheit"):
        cond = cond | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.coalesce(cond, F.lit(False))


def _too_long(df: DataFrame) -> Column:
    cond = F.lit(False)
    for c, n in MAX_LENGTH.items():
        if c in df.columns:
            cond = cond | F.coalesce(F.length(F.col(c)) > n, F.lit(False))
    return cond


def label_readings(decoded: DataFrame) -> DataFrame:
    """Add ``quality_status`` and ``quarantine_reason`` to decoded readings."""
    reason = (F.when(_all_null(READING_FIELDS) & F.col("event_timestamp").isNull(), MALFORMED)
              .when(F.col("event_timestamp").isNull(), BAD_EVENT_TIME)
              .when(_any_null(READING_REQUIRED), MISSING_REQUIRED)
              .when(_non_finite(), NON_FINITE)
              .when(_too_long(decoded), TOO_LONG))
    return _with_status(decoded, reason)


def label_window_events(decoded: DataFrame) -> DataFrame:
    reason = (F.when(_all_null(WINDOW_FIELDS) & F.col("event_timestamp").isNull(), MALFORMED)
              .when(F.col("event_timestamp").isNull(), BAD_EVENT_TIME)
              .when(_any_null(WINDOW_REQUIRED), MISSING_REQUIRED)
              .when(~F.col("event_type").isin("opened", "closed"), BAD_EVENT_TYPE)
              .when(_too_long(decoded), TOO_LONG))
    return _with_status(decoded, reason)


def _with_status(df: DataFrame, reason: Column) -> DataFrame:
    return (df.withColumn("quarantine_reason", reason)
              .withColumn("quality_status",
                          F.when(F.col("quarantine_reason").isNull(), "valid").otherwise("quarantine")))


def split(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without label columns and raw payload, quarantined rows with reason and raw payload)."""
    valid = labelled.filter(F.col("quality_status") == "valid").drop("quality_status", "quarantine_reason", "raw_value")
    bad = labelled.filter(F.col("quality_status") == "quarantine")
    return valid, bad


def _fill(df: DataFrame, defaults: dict) -> DataFrame:
    for name, value in defaults.items():
        if name in df.columns:
            df = df.withColumn(name, F.coalesce(F.col(name), value))
    return df


def fill_reading_defaults(df: DataFrame) -> DataFrame:
    """Column defaults of the sink, applied explicitly (an append writes NULLs) (Q-4)."""
    return _fill(df, {"message_type": F.lit(READING_MESSAGE_TYPE), "is_anomaly": F.lit(False),
                      "anomaly_type": F.lit("NORMAL"), "processing_timestamp": F.current_timestamp()})


def fill_window_defaults(df: DataFrame) -> DataFrame:
    return _fill(df, {"message_type": F.lit(WINDOW_MESSAGE_TYPE), "processing_timestamp": F.current_timestamp()})
