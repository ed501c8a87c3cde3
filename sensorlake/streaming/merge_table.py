"""Aggregates that late rows still amend: partial rows a batch, merged on read (S-4, G-1..G-4).

A watermark closes a window for good; rows behind it are dropped. Here nothing
is dropped and no state is kept in the stream: every micro-batch is aggregated
by itself into *mergeable* partial rows (counts, sums, extremes) per window and
key, written under its batch id, and a reader adds the parts up. A row that
comes weeks late is one more part of its old window.

Layout of a table::

    <path>/deltas/event_date=<d>/batch_id=<b>/      partial rows of batch b
    <path>/base/upto=<b>/event_date=<d>/            merged rows of all batches up to b

A batch that is run again replaces its own folders. :meth:`MergeTable.compact`
merges the dates that have new parts into a new base, which counts once it is
whole; a reader takes, per date, the newest whole base and the parts after it.
What a base replaces is deleted by the *next* compaction, so a reader that
started before isn't cut off. Only dates with new parts are rewritten.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from sensorlake.operators.aggregates import EVENTS_HOURLY, READINGS_1MIN, Tumbling
from sensorlake.session import child_folders, delete_path, path_exists


@dataclass(frozen=True)
class MergeTable:
    """Rows by ``keys`` whose other columns are merged by name; ``day`` tells the date folder from the keys."""
    path: str
    keys: Sequence[str]
    merges: dict[str, Callable[[str], Column]]      # column -> the aggregate that adds two parts up
    day: str                                        # SQL expression over the keys
    schema: StructType                              # of the keys and the merged columns

    def _merged(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy("event_date", *self.keys).agg(*[f(c).alias(c) for c, f in self.merges.items()])

    def write(self, partial: DataFrame, batch_id: int) -> None:
        """Store the partial rows of a batch; a batch that is run again replaces what it wrote, on every date."""
        for day in child_folders(partial.sparkSession, f"{self.path}/deltas"):
            delete_path(partial.sparkSession, f"{self.path}/deltas/{day}/batch_id={int(batch_id)}")
        (partial.withColumn("event_date", F.expr(self.day)).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
         .write.mode("append").partitionBy("event_date", "batch_id").parquet(f"{self.path}/deltas"))

    def _bases(self, spark: SparkSession) -> dict[str, list[int]]:
        """Date folder -> the bases that hold it, oldest first; only whole ones."""
        out: dict[str, list[int]] = {}
        uptos = sorted(int(n.partition("=")[2]) for n in child_folders(spark, f"{self.path}/base") if n.startswith("upto="))
        for upto in uptos:
            if path_exists(spark, f"{self.path}/base/upto={upto}/_SUCCESS"):
                for day in child_folders(spark, f"{self.path}/base/upto={upto}"):
                    if day.startswith("event_date="):
                        out.setdefault(day, []).append(upto)
        return out

    def _parts(self, spark: SparkSession, bases: dict[str, list[int]], upto: int | None = None) -> DataFrame:
        """Every part that counts: the newest base of a date, and the deltas after it (not beyond ``upto``)."""
        columns = ["event_date", *self.keys, *self.merges]
        parts = spark.createDataFrame([], StructType([*self.schema.fields, StructField("event_date", DateType())])).select(*columns)
        if bases:
            paths = [f"{self.path}/base/upto={b[-1]}/{day}" for day, b in bases.items()]
            stored = spark.read.schema(self.schema).parquet(*paths)
            # the folder's date follows from the keys
            parts = parts.unionByName(stored.withColumn("event_date", F.expr(self.day)).select(*columns))
        if child_folders(spark, f"{self.path}/deltas"):
            deltas = spark.read.option("basePath", f"{self.path}/deltas").schema(
                StructType([*self.schema.fields, StructField("event_date", DateType()), StructField("batch_id", LongType())])
            ).parquet(f"{self.path}/deltas")
            if upto is not None:
                deltas = deltas.filter(F.col("batch_id") <= upto)
            if bases:       # one row a date
                done = spark.createDataFrame([(_dt.date.fromisoformat(day.partition("=")[2]), b[-1]) for day, b in bases.items()],
                                             "event_date date, _upto long")
                deltas = deltas.join(F.broadcast(done), "event_date", "left").filter("_upto is null or batch_id > _upto")
            parts = parts.unionByName(deltas.select(*columns))
        return parts

    def read(self, spark: SparkSession) -> DataFrame:
        """All windows and keys, every part added up; ``event_date`` is kept for pruning."""
        return self._merged(self._parts(spark, self._bases(spark)))

    def compact(self, spark: SparkSession, upto: int) -> int:
        """Merge the parts of batches up to ``upto`` into a base, date by date; the number of dates rewritten.

        ``upto`` must be a batch that won't be run again (one before the newest that was committed).
        """
        for name in child_folders(spark, f"{self.path}/base"):
            if not path_exists(spark, f"{self.path}/base/{name}/_SUCCESS"):
                delete_path(spark, f"{self.path}/base/{name}")      # of a compaction that stopped
        bases = self._bases(spark)
        batches = {day: [int(b.partition("=")[2]) for b in child_folders(spark, f"{self.path}/deltas/{day}") if b.startswith("batch_id=")]
                   for day in child_folders(spark, f"{self.path}/deltas") if day.startswith("event_date=")}
        days = [day for day, some in batches.items() if any(bases.get(day, [-1])[-1] < b <= upto for b in some)]
        if days:
            dates = [_dt.date.fromisoformat(d.partition("=")[2]) for d in days]
            due = self._parts(spark, {d: b for d, b in bases.items() if d in days}, upto).filter(F.col("event_date").isin(dates))
            self._merged(due).write.partitionBy("event_date").parquet(f"{self.path}/base/upto={upto}")
        for day, held in bases.items():             # what the bases before this one had replaced already
            for b in batches.get(day, []):
                if b <= held[-1]:
                    delete_path(spark, f"{self.path}/deltas/{day}/batch_id={b}")
            for old in held[:-1]:
                delete_path(spark, f"{self.path}/base/upto={old}/{day}")
        return len(days)


# ----------------------------------------------------------------------------- the aggregates of the jobs

_TEMPERATURE = StructType().add("device_id", "string").add("window_start", "timestamp").add("window_end", "timestamp") \
    .add("sum_celsius", "double").add("sum_fahrenheit", "double").add("max_temp_celsius", "double") \
    .add("min_temp_celsius", "double").add("reading_count", "long").add("anomaly_count", "long")
_EVENTS = StructType().add("object_code", "integer").add("object_name", "string").add("event_type", "string") \
    .add("window_start", "timestamp").add("window_end", "timestamp").add("event_count", "long")


def temperature_table(path: str) -> MergeTable:
    return MergeTable(path, ("device_id", "window_start", "window_end"),
                      {"sum_celsius": F.sum, "sum_fahrenheit": F.sum, "max_temp_celsius": F.max, "min_temp_celsius": F.min,
                       "reading_count": F.sum, "anomaly_count": F.sum}, "to_date(window_start)", _TEMPERATURE)


def event_table(path: str) -> MergeTable:
    return MergeTable(path, ("object_code", "object_name", "event_type", "window_start", "window_end"),
                      {"event_count": F.sum}, "to_date(window_start)", _EVENTS)


def _window(spec: Tumbling) -> list[Column]:
    return [F.window("event_timestamp", spec.width).alias("w")]


def temperature_parts(readings: DataFrame, spec: Tumbling = READINGS_1MIN) -> DataFrame:
    """The partial rows of one batch of readings (with ``is_anomaly``); rows without event time are in no window."""
    return (readings.groupBy(*_window(spec), "device_id").agg(
        F.sum("temperature_celsius").alias("sum_celsius"), F.sum("temperature_fahrenheit").alias("sum_fahrenheit"),
        F.max("temperature_celsius").alias("max_temp_celsius"), F.min("temperature_celsius").alias("min_temp_celsius"),
        F.count(F.lit(1)).alias("reading_count"), F.count_if("is_anomaly").alias("anomaly_count"))
        .select("device_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "sum_celsius", "sum_fahrenheit", "max_temp_celsius", "min_temp_celsius", "reading_count", "anomaly_count"))


def event_parts(events: DataFrame, spec: Tumbling = EVENTS_HOURLY) -> DataFrame:
    return (events.groupBy(*_window(spec), "object_code", "object_name", "event_type").agg(F.count(F.lit(1)).alias("event_count"))
            .select("object_code", "object_name", "event_type", F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "event_count"))


def temperature_view(merged: DataFrame, spec: Tumbling = READINGS_1MIN) -> DataFrame:
    """Merged rows in the shape of ``aggregates.temperature_window_agg``."""
    return merged.select(
        "device_id", "window_start", "window_end", F.lit(spec.label).alias("window_duration"),
        (F.col("sum_celsius") / F.col("reading_count")).alias("avg_temp_celsius"),
        (F.col("sum_fahrenheit") / F.col("reading_count")).alias("avg_temp_fahrenheit"),
        "max_temp_celsius", "min_temp_celsius", "reading_count", "anomaly_count")


def event_view(merged: DataFrame, spec: Tumbling = EVENTS_HOURLY) -> DataFrame:
    return merged.select("object_code", "object_name", "event_type", "window_start", "window_end",
                         F.lit(spec.label).alias("aggregation_period"), "event_count")


def start_amended(rows: DataFrame, table: MergeTable, parts: Callable[[DataFrame], DataFrame], checkpoint: str,
                  trigger: dict | None = None, compact_every: int | None = None) -> StreamingQuery:
    """Stream ``rows`` into ``table``: no watermark, no state; every ``compact_every`` batches the parts up to
    the batch before are compacted."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(parts(batch), batch_id)
        if compact_every and batch_id and batch_id % compact_every == 0:
            table.compact(batch.sparkSession, int(batch_id) - 1)

    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"})).start())
