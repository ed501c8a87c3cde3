"""Open/close correlation (J-1, J-3, F-4..F-6, R-3, R-4).

* :func:`first_close_pairs` pairs each opening with the first later closing
  of the same object -- the open/close cycles the ``window_durations`` table
  is meant to hold.
* :func:`pair_pattern_counts` gives, per object and usage pattern, how many
  (open, later close) pairs the all-pairs self-join would produce and how
  many are unusual, without producing the pairs: for every opening it counts
  the closes beyond each duration boundary.

Both rest on :func:`sensorlake.operators.ordered.later_targets`, one range
shuffle plus a checkpoint; neither emits pairs or puts an object in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.classify import (
    BRIEF,
    BRIEF_BELOW_MIN,
    LONG,
    MEDIUM,
    MEDIUM_BELOW_MIN,
    SHORT,
    SHORT_BELOW_MIN,
    UNUSUAL_ABOVE_MIN,
    detect_window_patterns,
)
from sensorlake.functions.timefmt import whole_second_duration
from sensorlake.operators.ordered import later_targets

_MICROS = 1_000_000


def _sides(events: DataFrame, tie: str | None):
    ev = events.filter(F.col("event_timestamp").isNotNull())
    t = [tie] if tie else []
    opens = ev.filter(F.col("event_type") == "opened").select(
        "object_code", F.unix_micros("event_timestamp").alias("_us"), "object_name", *t)
    closes = ev.filter(F.col("event_type") == "closed").select(
        "object_code", F.unix_micros("event_timestamp").alias("_us"), *t)
    return opens, closes


def first_close_pairs(events: DataFrame, tie: str | None = "event_id",
                      n_partitions: int | None = None) -> DataFrame:
    """Each opening paired with the first strictly later closing of its object.

    Output: ``object_code, object_name, opened_at, closed_at, duration_seconds,
    duration_minutes, usage_pattern, is_unusual``. Openings with no later close
    are not paired (inner-join semantics). Arrival order is irrelevant.
    """
    opens, closes = _sides(events, tie)
    nxt = later_targets(opens, closes, ["object_code"], "_us", tie=tie, n_partitions=n_partitions)
    pairs = nxt.filter(F.col("later_min").isNotNull()).select(
        "object_code", "object_name",
        F.timestamp_micros("_us").alias("opened_at"),
        F.timestamp_micros("later_min").alias("closed_at"),
    )
    pairs = pairs.withColumn("duration_seconds", whole_second_duration(F.col("opened_at"), F.col("closed_at")))
    pairs = pairs.withColumn("duration_minutes", F.col("duration_seconds") / 60)
    return detect_window_patterns(pairs)


def pair_pattern_counts(events: DataFrame, tie: str | None = "event_id",
                        n_partitions: int | None = None) -> DataFrame:
    """Per object and usage pattern: number of (open, later close) pairs and unusual ones.

    Equal to grouping the all-pairs join ``open.ts < close.ts`` (same object)
    by pattern, where a pair's duration is the difference of whole epoch
    seconds. With T the open's whole second, a close c falls

    * in BRIEF  iff  t < c <= (T+300)s - 1us,  SHORT up to (T+1800)s - 1us,
      MEDIUM up to (T+7200)s - 1us, LONG beyond;
    * in "unusual" iff c > (T+18001)s - 1us (duration > 300 minutes).

    So each open becomes five probes whose "later close" counts difference
    into band counts. Output: ``object_code, object_name, usage_pattern,
    pair_count, unusual_count`` for bands with at least one pair.
    """
    opens, closes = _sides(events, tie)
    sec = F.call_function("div", F.col("_us") - F.pmod(F.col("_us"), F.lit(_MICROS)), F.lit(_MICROS))

    def bound(minutes: int, extra_seconds: int = 0):
        return (sec + minutes * 60 + extra_seconds) * _MICROS - 1

    thresholds = F.array(
        F.struct(F.lit(0).alias("j"), F.col("_us").alias("x")),
        F.struct(F.lit(1).alias("j"), bound(BRIEF_BELOW_MIN).alias("x")),
        F.struct(F.lit(2).alias("j"), bound(SHORT_BELOW_MIN).alias("x")),
        F.struct(F.lit(3).alias("j"), bound(MEDIUM_BELOW_MIN).alias("x")),
        F.struct(F.lit(4).alias("j"), bound(UNUSUAL_ABOVE_MIN, 1).alias("x")),
    )
    t = [tie] if tie else []
    probes = (opens.select("object_code", "object_name", *t, F.explode(thresholds).alias("p"))
                   .select("object_code", "object_name", *t, F.col("p.j").alias("j"), F.col("p.x").alias("_us")))
    counted = later_targets(probes, closes, ["object_code"], "_us", tie=tie, n_partitions=n_partitions)

    c = F.col("later_count")
    zero = F.lit(0).cast("long")

    def part(pattern, pairs, unusual):
        return F.struct(F.lit(pattern).alias("usage_pattern"), pairs.alias("pairs"), unusual.alias("unusual"))

    contributions = (
        F.when(F.col("j") == 0, F.array(part(BRIEF, c, zero)))
        .when(F.col("j") == 1, F.array(part(BRIEF, -c, zero), part(SHORT, c, zero)))
        .when(F.col("j") == 2, F.array(part(SHORT, -c, zero), part(MEDIUM, c, zero)))
        .when(F.col("j") == 3, F.array(part(MEDIUM, -c, zero), part(LONG, c, zero)))
        .otherwise(F.array(part(LONG, zero, c)))
    )
    return (counted.select("object_code", "object_name", F.explode(contributions).alias("d"))
            .groupBy("object_code", "object_name", F.col("d.usage_pattern").alias("usage_pattern"))
            .agg(F.sum("d.pairs").alias("pair_count"), F.sum("d.unusual").alias("unusual_count"))
            .filter(F.col("pair_count") > 0))


def usage_pattern_summary(cycles: DataFrame) -> DataFrame:
    """Per object and usage pattern over open/close cycles: count, unusual count, average minutes."""
    return cycles.groupBy("object_code", "object_name", "usage_pattern").agg(
        F.count(F.lit(1)).alias("cycles"),
        F.count_if(F.col("is_unusual")).alias("unusual_cycles"),
        F.avg("duration_minutes").alias("avg_duration_minutes"),
    )
