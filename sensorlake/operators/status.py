"""Pipeline status: per-table row counts and per-topic message counts (G-10, M-5, A-9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name, row_count, status`` (``ok`` when non-empty).

    Each count is a global partial aggregate; the union runs as one job.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", F.when(F.col("row_count") > 0, "ok").otherwise("empty"))


def topic_offsets(records: DataFrame) -> DataFrame:
    """Per topic partition: first and end offset (end = last offset + 1) and record count."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("start_offset"),
        (F.max("offset") + 1).alias("end_offset"),
        F.count(F.lit(1)).alias("record_count"),
    )


def topic_status(records: DataFrame) -> DataFrame:
    """Messages per topic as the sum of end offsets over its partitions (A-9)."""
    return (topic_offsets(records).groupBy("topic")
            .agg(F.sum("end_offset").alias("messages"), F.count(F.lit(1)).alias("partitions")))


def peek(records: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` records from the beginning of the topic (A-8): a bounded top-k."""
    return records.orderBy("topic", "partition", "offset").limit(n)
