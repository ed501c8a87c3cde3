"""Bounded file sources (A-1, A-2, A-7, A-10) with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions.timefmt import parse_strict
from sensorlake.schemas import OPENINGS_CSV, READINGS_CSV


def readings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Readings CSV -> typed readings; a bad time parses to NULL (quarantined later)."""
    raw = spark.read.schema(READINGS_CSV).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return raw.select(
        parse_strict(F.col("timestamp_utc")).alias("event_timestamp"),
        F.col("device_id").cast("string").alias("device_id"),
        F.col("temp_f").alias("temperature_fahrenheit"),
        F.col("temp_c").alias("temperature_celsius"),
    ).withColumn("timestamp_epoch", F.unix_timestamp("event_timestamp"))


def openings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Openings CSV as declared (times stay text; see ``codec.openings_to_events``)."""
    return spark.read.schema(OPENINGS_CSV).option("header", True).option("mode", "PERMISSIVE").csv(path)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A Parquet table of the serving layer (``<root>/<name>``)."""
    return spark.read.parquet(f"{root}/{name}")
