"""The two streaming jobs, wired from library functions (S-8, S-9, B-2..B-11, B-17).

Each job starts

* one *raw* query whose ``foreachBatch`` decodes, labels and fans the batch out
  to the valid table, the quarantine table, the alerts table, the audit
  log and the fingerprints that ``reconcile_tables`` checks them by -- the batch is persisted once and read by every sink instead of
  re-reading the source once per sink;
* one query per stateful operator (each needs its own checkpoint): tumbling
  aggregates, and for window events the first-close pairing.

All sinks are idempotent per batch id and errors propagate, so a failed batch
is re-run after restart (effectively-once). Checkpoints and tables live under
folders the caller passes -- shared storage on a cluster.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlake.functions import codec
from sensorlake.functions.classify import detect_anomalies, detect_window_patterns
from sensorlake.functions.timefmt import whole_second_duration
from sensorlake.operators import aggregates as agg
from sensorlake.operators import offsets, quality, reconcile
from sensorlake.schemas import BUS_POSITION, TABLES
from sensorlake.session import path_exists, use_rocksdb_state
from sensorlake.sinks import audit, parquet, relational
from sensorlake.streaming import merge_table
from sensorlake.streaming.frontiers import PartitionClock
from sensorlake.streaming.identity import IdentityTable
from sensorlake.streaming.pairing import stream_first_close_pairs
from sensorlake.streaming.pairing_tables import start_table_state_pairing
from sensorlake.streaming.pairing_timers import timed_first_close_pairs
from sensorlake.streaming.runner import start_to_parquet


#: What makes a message the same when it is sent again: all it says but the producer's time.
READING_IDENTITY = ("device_id", "event_timestamp", "temperature_celsius", "temperature_fahrenheit")
EVENT_IDENTITY = ("object_code", "object_name", "event_type", "event_timestamp")
COMPACT_EVERY = 100         # batches between compactions of amended aggregates


@dataclass
class Triggers:
    # Trigger intervals of the original jobs.
    raw: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    agg_fast: dict = field(default_factory=lambda: {"processingTime": "1 minute"})
    agg_slow: dict = field(default_factory=lambda: {"processingTime": "5 minutes"})

    @classmethod
    def available_now(cls) -> "Triggers":
        t = {"availableNow": True}
        return cls(raw=t, agg_fast=t, agg_slow=t)


@dataclass(frozen=True)
class Database:
    """A relational copy of every stored table, appended to batch by batch."""
    url: str
    properties: dict = field(default_factory=dict)

    def append(self, batch: DataFrame, table: str) -> None:
        schema, keys, time_col = TABLES[table]
        columns = [c for c in schema.fieldNames() if c in batch.columns]
        relational.append_new(batch.select(*columns), self.url, table, keys, time_col, self.properties)


def _fan_out(tables: str, valid_name: str, time_col: str, label, fill, alerts: bool, key_col: str,
             database: Database | None = None, known: IdentityTable | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        labelled, fresh = label(batch).persist(), None
        try:
            valid, bad = quality.split(labelled)
            if known:
                valid = fresh = known.new_rows(valid, batch_id).persist()
                fresh.count()
            if alerts:
                valid = detect_anomalies(valid)
            valid = fill(valid)
            # sorted by key and time inside each file: readers prune row groups on both
            records = [audit.observed_write(valid, batch_id, valid_name,
                                            parquet.batch_writer(f"{tables}/{valid_name}", time_col,
                                                                 sort_cols=(key_col, time_col)))]
            if database:
                database.append(valid, valid_name)
            # a missing event time stays missing: the folder goes by the bus time
            parquet.write_batch(bad, batch_id, f"{tables}/quarantine_{valid_name}", time_col,
                                date_from=F.coalesce(F.col(time_col), F.col("kafka_timestamp")))
            sent = {valid_name: valid, f"quarantine_{valid_name}": bad}
            if alerts:
                sent["alerts"] = valid.filter(F.col("is_anomaly"))
                parquet.write_batch(sent["alerts"], batch_id, f"{tables}/alerts", time_col)
            # what every table should hold of this batch, for ``reconcile_tables``
            marks = reduce(DataFrame.unionByName, [reconcile.fingerprint(df, name, batch_id) for name, df in sent.items()])
            marks.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("batch_id").parquet(f"{tables}/fingerprints_{valid_name}")
            if database:
                database.append(_batch_metrics(labelled, valid_name, batch_id), "system_metrics")
            audit_df = audit.audit_frame(batch.sparkSession, records)
            audit_df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("batch_id").parquet(f"{tables}/audit_{valid_name}")
            if known:       # last: a batch that fails before is run again with the same rows new
                known.remember(fresh, batch_id)
        finally:
            labelled.unpersist()
            if fresh is not None:
                fresh.unpersist()
    return write


def reconcile_tables(spark: SparkSession, tables: str, valid_name: str) -> DataFrame:
    """Whether every table of a fan-out holds what was sent to it, batch by batch (see ``operators.reconcile``)."""
    expected = spark.read.schema(reconcile.FINGERPRINT_SCHEMA).parquet(f"{tables}/fingerprints_{valid_name}")
    names = [r[0] for r in expected.filter("row_count > 0").select("target").distinct().collect()]      # three tables at most
    stored = [reconcile.stored_fingerprints(parquet.read_archive(spark, f"{tables}/{n}"), n) for n in names if path_exists(spark, f"{tables}/{n}")]
    none = spark.createDataFrame([], reconcile.FINGERPRINT_SCHEMA)
    return reconcile.compare(expected, reduce(DataFrame.unionByName, stored, none))


def offset_audit(spark: SparkSession, tables: str, valid_name: str) -> DataFrame:
    """Which bus offsets never got to a table, and which came again (see ``operators.offsets``): every record of a
    topic is in the table or in its quarantine, unless replays are dropped."""
    stored = [parquet.read_archive(spark, f"{tables}/{n}").select(*BUS_POSITION)
              for n in (valid_name, f"quarantine_{valid_name}") if path_exists(spark, f"{tables}/{n}")]
    return offsets.offset_report(reduce(DataFrame.unionByName, stored))


def _batch_metrics(labelled: DataFrame, table: str, batch_id: int) -> DataFrame:
    """Rows stored and quarantined by one batch as metric rows, timed by the batch's newest record: a batch
    that is run again gives the same rows. An empty batch gives none."""
    counts = labelled.agg(F.count_if(F.col("quality_status") == "valid").alias("rows_stored"),
                          F.count_if(F.col("quality_status") != "valid").alias("rows_quarantined"),
                          F.max("kafka_timestamp").alias("timestamp"))
    names = ("rows_stored", "rows_quarantined")
    metric = F.explode(F.array(*[F.struct(F.lit(n).alias("metric_name"), F.col(n).cast("double").alias("metric_value")) for n in names]))
    return (counts.filter(F.col("rows_stored") + F.col("rows_quarantined") > 0).select(metric.alias("m"), "timestamp")
            .select("m.*", F.lit("rows").alias("metric_unit"),
                    F.lit(json.dumps({"batch_id": int(batch_id), "table": table}, separators=(",", ":"))).alias("tags"), "timestamp"))


def _start_amended(rows: DataFrame, name: str, spec: agg.Tumbling, tables: str, checkpoints: str, trigger: dict) -> StreamingQuery:
    """The same aggregate, amended by late rows, as parts under ``<tables>/<name>_parts`` (see ``merge_table``)."""
    readings = "device_id" in rows.columns
    table = (merge_table.temperature_table if readings else merge_table.event_table)(f"{tables}/{name}_parts")
    parts = merge_table.temperature_parts if readings else merge_table.event_parts
    return merge_table.start_amended(rows, table, lambda batch: parts(batch, spec), f"{checkpoints}/{name}_parts", trigger, COMPACT_EVERY)


def _start_aggregate(aggregate: DataFrame, name: str, tables: str, checkpoints: str, trigger: dict,
                     database: Database | None) -> list[StreamingQuery]:
    """The aggregate's table, by date of the window, and its relational copy (a query of its own)."""
    rows = aggregate.withColumn("created_at", F.current_timestamp())
    queries = [start_to_parquet(rows.withColumn("event_date", F.to_date("window_start")), f"{tables}/{name}",
                                f"{checkpoints}/{name}", name=name, trigger=trigger, partition_by=["event_date"])]
    if database:
        queries.append(_start_database(rows, name, checkpoints, trigger, database))
    return queries


def _start_database(rows: DataFrame, name: str, checkpoints: str, trigger: dict, database: Database) -> StreamingQuery:
    return (rows.writeStream.queryName(f"{name}_database").foreachBatch(lambda batch, _: database.append(batch, name))
            .option("checkpointLocation", f"{checkpoints}/{name}_database").trigger(**trigger).start())


def start_readings(spark: SparkSession, records: DataFrame, tables: str, checkpoints: str,
                   triggers: Triggers | None = None, database: Database | None = None, amend_late: bool = False,
                   drop_replays: bool = False) -> list[StreamingQuery]:
    """Temperature job: raw fan-out + 1-minute and 5-minute aggregates; state in RocksDB.

    ``amend_late``: the aggregates are also kept as parts that late rows amend. ``drop_replays``: readings that
    were sent again, however long ago, are stored once (``streaming.identity``, under the checkpoints).
    """
    use_rocksdb_state(spark)
    t = triggers or Triggers()
    decoded = codec.decode_readings(records)
    raw = (decoded.writeStream.queryName("readings_raw")
           .foreachBatch(_fan_out(tables, "temperature_readings", "event_timestamp",
                                  quality.label_readings, quality.fill_reading_defaults, alerts=True,
                                  key_col="device_id", database=database,
                                  known=IdentityTable(f"{checkpoints}/readings_known", READING_IDENTITY) if drop_replays else None))
           .option("checkpointLocation", f"{checkpoints}/readings_raw")
           .trigger(**t.raw).start())
    valid = detect_anomalies(quality.split(quality.label_readings(decoded))[0])
    queries = [raw]
    for spec, trig in ((agg.READINGS_1MIN, t.agg_fast), (agg.READINGS_5MIN, t.agg_slow)):
        name = f"temperature_aggregations_{spec.label.split('_')[0]}min"
        queries += _start_aggregate(agg.temperature_window_agg(valid, spec), name, tables, checkpoints, trig, database)
        if amend_late:
            queries.append(_start_amended(valid, name, spec, tables, checkpoints, trig))
    return queries


def start_window_events(spark: SparkSession, records: DataFrame, tables: str, checkpoints: str,
                        triggers: Triggers | None = None, pairing_delay: str = "1 hour",
                        pairing: str = "tables", database: Database | None = None,
                        clock: PartitionClock | None = None, amend_late: bool = False,
                        drop_replays: bool = False) -> list[StreamingQuery]:
    """Window-event job: raw fan-out, hourly and daily counts, open/close durations; state in RocksDB.

    ``pairing="tables"`` (default) pairs in skew-proof micro-batch jobs with
    table-backed state (``streaming.pairing_tables``); ``"timers"`` keeps state in parts in the
    state store (``streaming.pairing_timers``; lower latency, one task per object) and ``"state_store"``
    one value an object (``applyInPandasWithState``). ``clock`` waits for slow
    bus partitions (``streaming.frontiers``); by default one maximum over all of them is the clock.
    ``amend_late`` and ``drop_replays`` as in :func:`start_readings`.
    """
    use_rocksdb_state(spark)
    t = triggers or Triggers(raw={"processingTime": "15 seconds"},
                             agg_fast={"processingTime": "1 hour"}, agg_slow={"processingTime": "1 day"})
    decoded = codec.decode_window_events(records)
    raw = (decoded.writeStream.queryName("window_events_raw")
           .foreachBatch(_fan_out(tables, "window_events", "event_timestamp",
                                  quality.label_window_events, quality.fill_window_defaults, alerts=False,
                                  key_col="object_code", database=database,
                                  known=IdentityTable(f"{checkpoints}/window_events_known", EVENT_IDENTITY) if drop_replays else None))
           .option("checkpointLocation", f"{checkpoints}/window_events_raw")
           .trigger(**t.raw).start())
    valid = quality.split(quality.label_window_events(decoded))[0]
    queries = [raw]
    for spec, trig in ((agg.EVENTS_HOURLY, t.agg_fast), (agg.EVENTS_DAILY, t.agg_slow)):
        name = f"window_aggregations_{spec.label}"
        queries += _start_aggregate(agg.window_event_agg(valid, spec), name, tables, checkpoints, trig, database)
        if amend_late:
            queries.append(_start_amended(valid, name, spec, tables, checkpoints, trig))
    if pairing == "tables":
        queries.append(start_table_state_pairing(
            valid, f"{tables}/window_durations", f"{checkpoints}/window_durations_state",
            f"{checkpoints}/window_durations", delay_seconds=_seconds(pairing_delay), trigger=t.raw,
            also=(lambda pairs: database.append(pairs, "window_durations")) if database else None, clock=clock))
        return queries
    pairs = (timed_first_close_pairs if pairing == "timers" else stream_first_close_pairs)(valid, pairing_delay)
    durations = detect_window_patterns(
        pairs.withColumn("duration_seconds", whole_second_duration(F.col("opened_at"), F.col("closed_at")))
             .withColumn("duration_minutes", F.col("duration_seconds") / 60)
             .withColumn("processing_timestamp", F.current_timestamp()))
    queries.append(start_to_parquet(durations, f"{tables}/window_durations", f"{checkpoints}/window_durations",
                                    name="window_durations", trigger=t.raw))
    if database:
        queries.append(_start_database(durations, "window_durations", checkpoints, t.raw, database))
    return queries


def _seconds(interval: str) -> float:
    """'10 minutes' / '1 hour' / '30 seconds' / '1 day' -> seconds."""
    n, unit = interval.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s").lower()]
    return float(n) * scale
