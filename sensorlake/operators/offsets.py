"""Lost and repeated bus offsets (A-5, A-9): gaps and islands over (topic, partition, offset).

A source that tolerates data loss goes on silently; this says what went
missing and what came twice. Offsets are counted first (copies collapse
map-side), then range-partitioned on (topic, partition, offset), so a topic
partition with most of the records is spread over many tasks. Each task
compares neighbours; what lies between two tasks is found from one row a
(task, topic partition): its first and last offset. No window runs over a
topic partition.

Records without a position (NULL topic, partition or offset) can't be placed;
they are counted in ``unplaced`` of :func:`offset_summary`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.session import estimated_bytes, partitions_for_size, scratch_path

GAP, REPEAT, RANGE = "gap", "repeat", "range"
_FOUND = "topic string, partition int, kind string, first_offset long, last_offset long, records long, pid int"


def _scan():
    gap, repeat, whole = GAP, REPEAT, RANGE

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        pid, names, last = TaskContext.get().partitionId(), ["topic", "partition", "kind", "first_offset", "last_offset", "records", "pid"], None
        ranges: dict[tuple, list[int]] = {}         # topic partitions of this task: first and last offset, distinct ones

        def rows(topic, part, kind, first, upto, n):
            size = len(first)
            return pa.RecordBatch.from_arrays(
                [topic, part, pa.array([kind] * size, pa.string()), pa.array(first, pa.int64()), pa.array(upto, pa.int64()),
                 pa.array(n, pa.int64()), pa.array([pid] * size, pa.int32())], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            topic, part = batch.column("topic"), batch.column("partition")
            code = topic.dictionary_encode().indices.to_numpy().astype(np.int64) << 32 | part.to_numpy().astype(np.int64)
            at, copies = batch.column("offset").to_numpy(), batch.column("copies").to_numpy()
            new = np.r_[True, code[1:] != code[:-1]]
            before = np.r_[at[0], at[:-1]]
            if last is not None and last[:2] == (topic[0].as_py(), part[0].as_py()):
                new[0], before[0] = False, last[2]
            lost = np.flatnonzero(~new & (at - before > 1))
            if len(lost):
                yield rows(topic.take(pa.array(lost)), part.take(pa.array(lost)), gap, before[lost] + 1, at[lost] - 1,
                           at[lost] - before[lost] - 1)
            twice = np.flatnonzero(copies > 1)
            if len(twice):
                yield rows(topic.take(pa.array(twice)), part.take(pa.array(twice)), repeat, at[twice], at[twice], copies[twice] - 1)
            begin = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            for lo, hi in zip(begin, np.r_[begin[1:], len(code)]):
                key = (topic[int(lo)].as_py(), part[int(lo)].as_py())
                seen = ranges.setdefault(key, [int(at[lo]), 0, 0])
                seen[1], seen[2] = int(at[hi - 1]), seen[2] + int(hi - lo)
            last = (topic[len(code) - 1].as_py(), part[len(code) - 1].as_py(), int(at[-1]))
        if ranges:
            keys = list(ranges)
            yield rows(pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), whole,
                       [ranges[k][0] for k in keys], [ranges[k][1] for k in keys], [ranges[k][2] for k in keys])
    return scan


def _scanned(records: DataFrame, created: list[str] | None) -> DataFrame:
    """Gaps and repeats within tasks, and the range of every (task, topic partition); written once."""
    spark = records.sparkSession
    placed = records.filter("topic is not null and partition is not null and offset is not null")
    counted = placed.groupBy("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset")) \
        .agg(F.count(F.lit(1)).alias("copies"))
    n = partitions_for_size(spark, estimated_bytes(placed.select("topic", "partition", "offset")))
    order = ["topic", "partition", "offset"]
    found = counted.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_scan(), _FOUND)
    path = scratch_path(spark, "offset-scan")
    found.write.parquet(path)
    if created is not None:
        created.append(path)
    return spark.read.schema(_FOUND).parquet(path)


def offset_report(records: DataFrame, created: list[str] | None = None) -> DataFrame:
    """One row a hole or repeat: ``topic, partition, kind, first_offset, last_offset, records``.

    ``gap``: offsets first to last that no record has (``records`` of them) between two that are there.
    ``repeat``: one offset, and how many more times than once it came.
    """
    scanned = _scanned(records, created)
    tasks = Window.partitionBy("topic", "partition").orderBy("pid")     # a row a task that holds some of it
    between = (scanned.filter(F.col("kind") == RANGE).withColumn("before", F.lag("last_offset").over(tasks))
               .filter("first_offset - before > 1")
               .select("topic", "partition", F.lit(GAP).alias("kind"), (F.col("before") + 1).alias("from"),
                       (F.col("first_offset") - 1).alias("upto"), (F.col("first_offset") - F.col("before") - 1).alias("records")))
    within = scanned.filter(F.col("kind") != RANGE).drop("pid")
    return within.union(between)


def offset_summary(records: DataFrame, created: list[str] | None = None) -> DataFrame:
    """Per topic partition: ``start_offset, end_offset`` (one beyond the last), ``present`` (distinct offsets),
    ``lost`` (holes between them), ``repeated`` (records that came again); and a row of NULL topic and
    partition with the records that have no position (``unplaced``)."""
    scanned = _scanned(records, created)
    of = lambda kind: F.col("kind") == kind
    placed = scanned.groupBy("topic", "partition").agg(
        F.min(F.when(of(RANGE), F.col("first_offset"))).alias("start_offset"),
        (F.max(F.when(of(RANGE), F.col("last_offset"))) + 1).alias("end_offset"),
        F.sum(F.when(of(RANGE), F.col("records")).otherwise(0)).alias("present"),
        F.sum(F.when(of(REPEAT), F.col("records")).otherwise(0)).alias("repeated"))
    placed = placed.select("topic", "partition", "start_offset", "end_offset", "present",
                           (F.col("end_offset") - F.col("start_offset") - F.col("present")).alias("lost"), "repeated",
                           F.lit(0).cast("long").alias("unplaced"))
    nowhere = records.filter("topic is null or partition is null or offset is null").agg(F.count(F.lit(1)).alias("unplaced"))
    none = lambda kind: F.lit(None).cast(kind)
    return placed.union(nowhere.filter("unplaced > 0").select(
        none("string"), none("int"), none("long"), none("long"), F.lit(0).cast("long"), F.lit(0).cast("long"),
        F.lit(0).cast("long"), "unplaced"))
