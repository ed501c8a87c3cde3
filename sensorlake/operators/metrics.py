"""System metric rows (M-4, B-13) and streaming progress as metrics (S-4, G-12).

Metric rows have the ``system_metrics`` shape: ``metric_name, metric_value,
metric_unit, tags`` (JSON text) and ``timestamp``. Progress metrics come from
the query's progress events (one small record per micro-batch), which
:class:`ProgressTable` stores as they come.
"""

from __future__ import annotations

import datetime as _dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sensorlake.functions.timefmt import utc
from sensorlake.schemas import SYSTEM_METRICS


def metric_rows(spark: SparkSession, rows: list[tuple[str, float, str, dict]],
                at: _dt.datetime | None = None) -> DataFrame:
    """Metric rows from (name, value, unit, tags) tuples; ``at`` defaults to now (UTC)."""
    ts = utc(at or _dt.datetime.now(_dt.timezone.utc))
    data = [(n, float(v), u, json.dumps(t, separators=(",", ":"), sort_keys=True), ts) for n, v, u, t in rows]
    return spark.createDataFrame(data, SYSTEM_METRICS)


def _of_progress(query: str, batch_id: int, at: str, input_rows: int, dropped: int, state_rows: int) -> tuple[list[tuple], _dt.datetime]:
    tags = {"query": query, "batch_id": batch_id}
    return [("stream_input_rows", input_rows, "rows", tags), ("stream_rows_dropped_by_watermark", dropped, "rows", tags),
            ("stream_state_rows", state_rows, "rows", tags)], _dt.datetime.fromisoformat(at.replace("Z", "+00:00"))


def progress_metrics(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Input rows, rows dropped by the watermark and state rows of the latest micro-batches: as many as
    the query object remembers (``spark.sql.streaming.numRecentProgressUpdates``). For all of them, see
    :class:`ProgressTable`."""
    parts = [spark.createDataFrame([], SYSTEM_METRICS)]
    for p in query.recentProgress:
        ops = p.get("stateOperators") or []
        rows, at = _of_progress(p.get("name") or str(p.get("id")), p["batchId"], p["timestamp"], p.get("numInputRows", 0),
                                sum(o.get("numRowsDroppedByWatermark", 0) for o in ops),
                                sum(o.get("numRowsTotal", 0) for o in ops))
        parts.append(metric_rows(spark, rows, at))
    return reduce(DataFrame.unionAll, parts)


class ProgressTable(StreamingQueryListener):
    """Stores the metric rows of every micro-batch of every query under ``path``, by query and batch id.

    ``spark.streams.addListener(ProgressTable(spark, path))`` before the queries start.
    A batch that is run again replaces its rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows, at = _of_progress(p.name or str(p.id), p.batchId, p.timestamp, p.numInputRows,
                                sum(o.numRowsDroppedByWatermark for o in p.stateOperators),
                                sum(o.numRowsTotal for o in p.stateOperators))
        (metric_rows(self.spark, rows, at).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/query={p.id}/batch_id={p.batchId}"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


LOADED = "rows_loaded"


def load_counts(sources: dict[str, DataFrame], at: Column) -> DataFrame:
    """One metric row a source: how many rows its input holds (G-12). One job, a partial count a task."""
    parts = [df.agg(F.count(F.lit(1)).cast("double").alias("metric_value")).select(
        F.lit(LOADED).alias("metric_name"), "metric_value", F.lit("rows").alias("metric_unit"),
        F.to_json(F.struct(F.lit(name).alias("source"))).alias("tags"), at.alias("timestamp")) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts)
