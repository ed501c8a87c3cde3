"""Row classification rules (R-1..R-5), built from column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Anomaly thresholds (strict comparisons) and labels.
HIGH_CELSIUS = 40
LOW_CELSIUS = -20
HIGH_FAHRENHEIT = 104
LOW_FAHRENHEIT = -4
HIGH_TEMP = "HIGH_TEMP"
LOW_TEMP = "LOW_TEMP"
NORMAL = "NORMAL"

# Opening-length classes in minutes (strict upper bounds), the
# "unusual" bound (strict) and labels.
BRIEF_BELOW_MIN = 5
SHORT_BELOW_MIN = 30
MEDIUM_BELOW_MIN = 120
UNUSUAL_ABOVE_MIN = 300
BRIEF = "BRIEF_OPENING"
SHORT = "SHORT_OPENING"
MEDIUM = "MEDIUM_OPENING"
LONG = "LONG_OPENING"
USAGE_PATTERNS = (BRIEF, SHORT, MEDIUM, LONG)


def anomaly_flag(celsius: Column, fahrenheit: Column) -> Column:
    """True when either scale is outside its band; unknown (NULL) counts as false."""
    out_of_band = (
        (celsius > HIGH_CELSIUS) | (celsius < LOW_CELSIUS)
        | (fahrenheit > HIGH_FAHRENHEIT) | (fahrenheit < LOW_FAHRENHEIT)
    )
    return F.when(out_of_band, True).otherwise(False)


def anomaly_type(celsius: Column) -> Column:
    """Celsius decides the type, so a Fahrenheit-only anomaly stays NORMAL."""
    return (F.when(celsius > HIGH_CELSIUS, HIGH_TEMP)
            .when(celsius < LOW_CELSIUS, LOW_TEMP)
            .otherwise(NORMAL))


def detect_anomalies(df: DataFrame) -> DataFrame:
    """Add ``is_anomaly`` and ``anomaly_type`` (R-1, R-2)."""
    c, f = F.col("temperature_celsius"), F.col("temperature_fahrenheit")
    return df.withColumn("is_anomaly", anomaly_flag(c, f)).withColumn("anomaly_type", anomaly_type(c))


def usage_pattern(minutes: Column) -> Column:
    """Opening length class; NULL falls through to the last class."""
    return (F.when(minutes < BRIEF_BELOW_MIN, BRIEF)
            .when(minutes < SHORT_BELOW_MIN, SHORT)
            .when(minutes < MEDIUM_BELOW_MIN, MEDIUM)
            .otherwise(LONG))


def is_unusual(minutes: Column) -> Column:
    return F.when(minutes > UNUSUAL_ABOVE_MIN, True).otherwise(False)


def detect_window_patterns(df: DataFrame) -> DataFrame:
    """Add ``usage_pattern`` and ``is_unusual`` from ``duration_minutes`` (R-3, R-4)."""
    m = F.col("duration_minutes")
    return df.withColumn("usage_pattern", usage_pattern(m)).withColumn("is_unusual", is_unusual(m))


def event_time_for(event_type: Column, start: Column, end: Column) -> Column:
    """R-5: an ``opened`` event happens at the start, a ``closed`` one at the end."""
    return F.when(event_type == "opened", start).otherwise(end)
