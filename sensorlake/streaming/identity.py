"""Replays that come after the watermark (S-11): an identity table by day with a Bloom prefilter.

A producer that re-sends old messages for ever outlives any watermark, and
state for all time doesn't fit a state store. Identities are kept in a table
instead, by the day of the *event* (a copy has its original's event time), so a
record can only be known on its own day:

* ``<path>/ids/day=<d>/batch_id=<b>``: the identities that batch ``b`` was the
  first to bring;
* ``<path>/bloom/day=<d>/batch_id=<b>``: a blocked Bloom filter of them. An
  identity has one block (32,768 bits, Spark's bitmap aggregate) of the day's
  ``blocks`` and ``_PROBES`` bits in it, so a probe is one equi-join.

A batch is reduced to one row an identity, probes the filters of its days, and
only what a filter may know is anti-joined, exactly, with the identities of the days
of those hits: in the usual case of few replays, little is read. A false hit
costs a comparison, never a row. Filters grow with the number of blocks, which
is a parameter by day; past it they only let more through.

Batch ``b`` reads what batches before it wrote and replaces its own folders, so a
batch that is run again finds the same rows new.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import child_folders, delete_path

_PROBES = 4
_BITS = 32768
_NO_DAY = "none"


def _bit(bitmap: Column, position: Column) -> Column:
    """Whether a bit of a bitmap (as ``bitmap_construct_agg`` makes them) is set."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.call_function("div", position, F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, F.pmod(position, F.lit(8)).cast("int")) == 1


@dataclass(frozen=True)
class IdentityTable:
    """Known identities. ``identity``: the columns that make one; ``day``: SQL expression of the event's day."""
    path: str
    identity: Sequence[str]
    day: str = "to_date(event_timestamp)"
    blocks: int = 256                   # of 32,768 bits a day: 4 KB each

    def _keyed(self, rows: DataFrame) -> DataFrame:
        hashed = F.xxhash64(*self.identity)
        return rows.withColumn("day", F.coalesce(F.expr(self.day).cast("string"), F.lit(_NO_DAY))).withColumn(
            "_block", F.pmod(F.shiftrightunsigned(hashed, 32), F.lit(self.blocks)).cast("int")).withColumn(
            "_bits", F.array(*[F.pmod(F.xxhash64(F.lit(k), *self.identity), F.lit(_BITS)).cast("long") for k in range(_PROBES)]))

    def _before(self, spark: SparkSession, part: str, days: list[str], batch_id: int) -> DataFrame | None:
        """What earlier batches stored for ``days``."""
        stored = set(child_folders(spark, f"{self.path}/{part}"))
        there = [d for d in days if f"day={d}" in stored]
        if not there:
            return None
        stored = spark.read.option("basePath", f"{self.path}/{part}").parquet(*[f"{self.path}/{part}/day={d}" for d in there])
        return stored.withColumn("day", F.col("day").cast("string")).filter(F.col("batch_id") < batch_id)

    def new_rows(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of the batch whose identity no earlier batch brought, one an identity."""
        spark, names = batch.sparkSession, batch.columns
        rows = self._keyed(batch.dropDuplicates(list(self.identity)))
        days = [r[0] for r in rows.select("day").distinct().collect()]      # the days of one batch
        bloom = self._before(spark, "bloom", days, batch_id)
        if bloom is None:
            return rows.select(*names)
        merged = bloom.groupBy("day", "_block").agg(F.expr("bitmap_or_agg(bits)").alias("_bitmap"))
        probed = rows.join(merged, ["day", "_block"], "left")
        known = F.lit(True)
        for k in range(_PROBES):
            known = known & _bit(F.col("_bitmap"), F.col("_bits")[k])
        probed = probed.withColumn("_maybe", F.coalesce(known, F.lit(False)))
        hit_days = [r[0] for r in probed.filter("_maybe").select("day").distinct().collect()]
        fresh = probed.filter(~F.col("_maybe")).select(*names)
        ids = self._before(spark, "ids", hit_days, batch_id)
        if ids is None:
            return fresh
        there = ids.select(F.col("day").alias("_day"), *[F.col(c).alias(f"_there_{c}") for c in self.identity])
        same = F.col("day") == F.col("_day")
        for c in self.identity:
            same = same & F.col(c).eqNullSafe(F.col(f"_there_{c}"))
        return fresh.unionByName(probed.filter("_maybe").join(there, same, "left_anti").select(*names))

    def remember(self, fresh: DataFrame, batch_id: int) -> None:
        """Store the identities of the rows that ``new_rows`` gave, and their filters."""
        spark, keyed = fresh.sparkSession, self._keyed(fresh)
        for part in ("ids", "bloom"):
            for day in child_folders(spark, f"{self.path}/{part}"):
                delete_path(spark, f"{self.path}/{part}/{day}/batch_id={int(batch_id)}")
        stamp = F.lit(int(batch_id)).cast("long").alias("batch_id")
        keyed.select(*self.identity, "day", stamp).write.mode("append").partitionBy("day", "batch_id").parquet(f"{self.path}/ids")
        (keyed.select("day", "_block", F.explode("_bits").alias("bit")).groupBy("day", "_block")
         .agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).withColumn("batch_id", stamp)
         .write.mode("append").partitionBy("day", "batch_id").parquet(f"{self.path}/bloom"))

    def compact_filters(self, spark: SparkSession, upto: int) -> None:
        """Merge the filters of batches up to ``upto`` of every day into one (batch id ``upto``); a day at a time."""
        for day in child_folders(spark, f"{self.path}/bloom"):
            old = [b for b in child_folders(spark, f"{self.path}/bloom/{day}") if b.startswith("batch_id=") and int(b.partition("=")[2]) <= upto]
            if len(old) < 2:
                continue
            work = f"{self.path}/_merged"
            delete_path(spark, work)
            (spark.read.parquet(*[f"{self.path}/bloom/{day}/{b}" for b in old]).groupBy("_block")
             .agg(F.expr("bitmap_or_agg(bits)").alias("bits")).write.parquet(work))
            # bits only add up: filters merged into one of them may stay beside the others until these are gone
            spark.read.parquet(work).write.mode("append").parquet(f"{self.path}/bloom/{day}/batch_id={upto}")
            for b in old:
                if b != f"batch_id={upto}":
                    delete_path(spark, f"{self.path}/bloom/{day}/{b}")
            delete_path(spark, work)
