"""Event-time frontiers per bus partition: a clock that waits for slow partitions (S-12, J-3).

Openings and closings of an object travel in different partitions (the message
key names the event type), and partitions are read at different speeds. One
maximum over all records would let the fastest partition decide what is late.
Here every (topic, partition) has its own frontier, the newest event time it
has delivered, and the clock is the *least* frontier:

* a partition that has delivered nothing for ``idle_seconds`` of bus time (the
  newest append time over all partitions minus its own) is idle and doesn't
  hold the clock back; what it sends when it wakes up may be late. Bus times
  are part of the records, so a batch that is run again decides alike;
* while fewer than ``partitions`` partitions are known, those still missing
  count as active ones without a frontier, until bus time has gone on for
  ``idle_seconds`` since the first record.

A frontier table has one row a partition (topics have thousands at most), so it
is kept next to the operator's state, a folder a batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRONTIER_SCHEMA = "topic string, partition int, max_us long, bus_us long, first_bus_us long"


def advance(previous: DataFrame, batch: DataFrame, event_time: str = "event_timestamp",
            bus_time: str = "kafka_timestamp") -> DataFrame:
    """The frontiers after ``batch``: per partition the newest event and bus time and the first bus time.
    Records without an event time still show that their partition is alive."""
    seen = batch.select("topic", F.col("partition").cast("int").alias("partition"), F.unix_micros(event_time).alias("max_us"),
                        F.unix_micros(bus_time).alias("bus_us"), F.unix_micros(bus_time).alias("first_bus_us"))
    return previous.unionByName(seen).groupBy("topic", "partition").agg(
        F.max("max_us").alias("max_us"), F.max("bus_us").alias("bus_us"), F.min("first_bus_us").alias("first_bus_us"))


@dataclass(frozen=True)
class PartitionClock:
    """The least frontier of the active partitions; ``partitions``: how many there are, if known."""
    idle_seconds: float = 600.0
    partitions: int | None = None

    def now(self, frontiers: DataFrame) -> int | None:
        """The clock in microseconds: None while an active partition hasn't delivered an event time."""
        idle_us = int(self.idle_seconds * 1_000_000)
        newest, first, known = frontiers.agg(F.max("bus_us"), F.min("first_bus_us"), F.count("*")).first()
        if not known:
            return None
        active = frontiers if newest is None else frontiers.filter(F.col("bus_us").isNull() | (F.col("bus_us") >= newest - idle_us))
        least, silent = active.agg(F.min("max_us"), F.count_if(F.col("max_us").isNull())).first()
        missing = self.partitions is not None and known < self.partitions and (newest is None or newest - first <= idle_us)
        return None if silent or missing else least
