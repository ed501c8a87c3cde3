"""Skew-proof streaming first-close pairing: micro-batches + table-backed state.

``streaming.pairing`` keeps state per object in the state store, so every
event of an object is handled by one task per micro-batch. Here each
micro-batch is a batch job instead (``foreachBatch``):

1. state of the previous batch (openings not yet answered + events not yet
   final) is read from ``<state>/batch_id=<b-1>``, the new events are added;
   events older than what was already final are late: they pair with nothing and
   go to ``<pairs>_late/batch_id=<b>``;
2. the job's own watermark is ``clock - delay``; events before it are final. The
   clock is the newest event time seen, or with a ``PartitionClock`` the least
   over the bus partitions of their newest (``streaming.frontiers``);
3. every pending or final opening is matched to the first final closing after
   it with the ordered scan (``operators.ordered.later_targets``): range
   partitioned on (object, time), so a hot object is split over many tasks;
4. answered pairs (with durations and usage patterns: ``window_durations``
   rows) go to ``<pairs>/batch_id=<b>``; unanswered openings and
   non-final events become ``<state>/batch_id=<b>``; the watermark goes to
   ``<state>/_watermark/batch_id=<b>``.

All three writes replace the batch's own partition, and batch ``b`` reads
only what batch ``b-1`` wrote, so a re-run of a failed batch reproduces it
exactly (effectively-once). A source that has ended is settled by
:func:`finish_pairing`, after which nothing can be late. After its writes, batch ``b`` deletes its own
ordered-scan table and the state of batch ``b-2``, so a long-running stream
keeps a bounded footprint. Previously final closings never need to be kept:
they are earlier than every event still to become final.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from sensorlake.functions.classify import detect_window_patterns
from sensorlake.functions.timefmt import whole_second_duration
from sensorlake.operators.ordered import later_targets
from sensorlake.session import child_folders, delete_path
from sensorlake.streaming.frontiers import FRONTIER_SCHEMA, PartitionClock, advance

_OPEN, _CLOSE = 0, 1
_END = (1 << 62)        # after every event time, with room for a delay

STATE_SCHEMA = StructType([
    StructField("object_code", IntegerType()),
    StructField("object_name", StringType()),
    StructField("event_id", LongType()),
    StructField("_us", LongType()),
    StructField("_kind", IntegerType()),
])
WATERMARK_SCHEMA = StructType([StructField("max_us", LongType()), StructField("final_upto", LongType())])


def _state(spark, path: str, schema: StructType, prev: int) -> DataFrame:
    """What the batch before wrote: nothing for the first; a folder that is gone is an error, not empty state."""
    return spark.createDataFrame([], schema) if prev < 0 else spark.read.schema(schema).parquet(path)


def _event_id(events: DataFrame):
    """A deterministic tie-break id: the event id, else the record's bus position, else its content."""
    if "event_id" in events.columns:
        return F.col("event_id").cast("long")
    if "offset" in events.columns:
        return F.xxhash64("topic", "partition", "offset")
    return F.xxhash64("object_code", "event_type", "event_timestamp")


def _as_state(events: DataFrame) -> DataFrame:
    return (events.filter(F.col("event_timestamp").isNotNull() & F.col("object_code").isNotNull())
            .select(F.col("object_code").cast("int"), "object_name", _event_id(events).alias("event_id"),
                    F.unix_micros("event_timestamp").alias("_us"),
                    F.when(F.col("event_type") == "opened", _OPEN)
                    .when(F.col("event_type") == "closed", _CLOSE).alias("_kind"))
            .filter(F.col("_kind").isNotNull()))


def pair_batch(batch: DataFrame, batch_id: int, pairs_path: str, state_path: str, delay_us: int,
               clock: PartitionClock | None = None, also: Callable[[DataFrame], None] | None = None,
               ended: bool = False) -> None:
    """Process one micro-batch of window events (see module docstring). ``also`` gets the pairs as written;
    ``ended`` makes everything final."""
    spark = batch.sparkSession
    prev = int(batch_id) - 1
    state = _state(spark, f"{state_path}/batch_id={prev}", STATE_SCHEMA, prev)
    mark = _state(spark, f"{state_path}/_watermark/batch_id={prev}", WATERMARK_SCHEMA, prev).first()
    prev_max = mark["max_us"] if mark else None
    final_upto = mark["final_upto"] if mark else None

    new = _as_state(batch)
    if final_upto is not None:
        late = new.filter(F.col("_us") < final_upto)              # older than what is final
        late.write.mode("overwrite").parquet(f"{pairs_path.rstrip('/')}_late/batch_id={batch_id}")
        new = new.filter(F.col("_us") >= final_upto)
    new = new.persist()
    try:
        if clock is None:
            batch_max = new.agg(F.max("_us")).first()[0]
            maxes = [m for m in (prev_max, batch_max) if m is not None]
            max_us = max(maxes) if maxes else None
        else:
            frontiers = f"{state_path}/_frontier/batch_id={batch_id}"
            advance(_state(spark, f"{state_path}/_frontier/batch_id={prev}", FRONTIER_SCHEMA, prev), batch).coalesce(1) \
                .write.mode("overwrite").parquet(frontiers)
            max_us = clock.now(spark.read.schema(FRONTIER_SCHEMA).parquet(frontiers))
        if ended:
            max_us = _END
        bounds = [x for x in (final_upto, None if max_us is None else max_us - delay_us) if x is not None]
        upto = max(bounds) if bounds else None

        events = state.unionByName(new)
        final = F.col("_us") < F.lit(upto) if upto is not None else F.lit(False)
        opens = events.filter((F.col("_kind") == _OPEN) & final).select(
            "object_code", "_us", "object_name", "event_id")
        closes = events.filter((F.col("_kind") == _CLOSE) & final).select("object_code", "_us", "event_id")
        scratch: list[str] = []
        matched = later_targets(opens, closes, ["object_code"], "_us", tie="event_id", created=scratch)

        pairs = matched.filter(F.col("later_min").isNotNull()).select(
            "object_code", "object_name",
            F.timestamp_micros("_us").alias("opened_at"), F.timestamp_micros("later_min").alias("closed_at"))
        pairs = pairs.withColumn("duration_seconds", whole_second_duration(F.col("opened_at"), F.col("closed_at")))
        pairs = detect_window_patterns(pairs.withColumn("duration_minutes", F.col("duration_seconds") / 60))
        pairs.write.mode("overwrite").parquet(f"{pairs_path}/batch_id={batch_id}")
        if also:
            also(spark.read.schema(pairs.schema).parquet(f"{pairs_path}/batch_id={batch_id}"))

        pending = matched.filter(F.col("later_min").isNull()).select(
            "object_code", "object_name", "event_id", "_us", F.lit(_OPEN).alias("_kind"))
        waiting = events.filter(~final)
        pending.unionByName(waiting).write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")
        spark.createDataFrame([(max_us, upto)], WATERMARK_SCHEMA).coalesce(1).write.mode("overwrite") \
            .parquet(f"{state_path}/_watermark/batch_id={batch_id}")
        # housekeeping: the scan table is consumed; batch b-1's state stays for a retry of b
        for path in scratch:
            delete_path(spark, path)
        if batch_id >= 2:
            delete_path(spark, f"{state_path}/batch_id={batch_id - 2}")
            for part in ("_watermark", "_frontier"):
                delete_path(spark, f"{state_path}/{part}/batch_id={batch_id - 2}")
    finally:
        new.unpersist()


def pair_writer(pairs_path: str, state_path: str, delay_seconds: float, clock: PartitionClock | None = None,
                also: Callable[[DataFrame], None] | None = None) -> Callable[[DataFrame, int], None]:
    delay_us = int(delay_seconds * 1_000_000)

    def write(batch: DataFrame, batch_id: int) -> None:
        pair_batch(batch, batch_id, pairs_path, state_path, delay_us, clock, also)
    return write


def start_table_state_pairing(events: DataFrame, pairs_path: str, state_path: str, checkpoint: str,
                              delay_seconds: float = 3600, trigger: dict | None = None,
                              clock: PartitionClock | None = None, also: Callable[[DataFrame], None] | None = None):
    """Start the micro-batch pairing query; pairs land under ``pairs_path/batch_id=<n>``.

    With a ``clock`` the events must carry ``topic, partition, kafka_timestamp`` (as decoded records do).
    """
    return (events.writeStream.foreachBatch(pair_writer(pairs_path, state_path, delay_seconds, clock, also))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "15 seconds"})).start())


def finish_pairing(events_schema: StructType, spark, pairs_path: str, state_path: str) -> None:
    """Settle what is left once the source has ended: every event is final, so every answered opening gets its
    pair. One more batch, after the last that has state; doing it again changes nothing."""
    done = [int(n.partition("=")[2]) for n in child_folders(spark, state_path) if n.startswith("batch_id=")]
    if done:
        pair_batch(spark.createDataFrame([], events_schema), max(done) + 1, pairs_path, state_path, 0, ended=True)
