"""Trailing statistics from mergeable moments (G-5, GF-6): no raw rows but at the edges.

A moments row holds, for a device and a window, how many readings there are,
their mean, the sum of squared deviations from it, extremes and anomalies. Two
such rows merge exactly (up to rounding) into one for both windows, so minutes
roll up to hours and hours to any range:

    n = n1 + n2,  d = mean2 - mean1,  mean = mean1 + d n2 / n,  m2 = m2_1 + m2_2 + d^2 n1 n2 / n

The deviations are merged, not the sums of squares, so nothing cancels when the
mean is large against the spread. A range that begins and ends anywhere is cut into whole
hours, whole minutes at its two ends, and raw readings of the two minutes that
it cuts: the hour, minute and raw tables are read for their own ranges only
(literals that reach the scans).

A merge folds a list sorted by window: at most 60 minutes an hour, and one row an hour of
the range and 120 minutes for the answer, whatever the number of readings.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.timefmt import utc, utc_literal

MINUTE, HOUR = _dt.timedelta(minutes=1), _dt.timedelta(hours=1)
_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
_PARTS = ("n", "mean", "m2", "low", "high", "anomalies")


def minute_moments(readings: DataFrame) -> DataFrame:
    """device_id, window_start and the moments of every minute; one shuffle, partial per map task."""
    return _of_raw(readings, F.date_trunc("minute", "event_timestamp")).filter("window_start is not null")


def _of_raw(readings: DataFrame, window: Column) -> DataFrame:
    c = F.col("temperature_celsius")
    return readings.groupBy("device_id", window.alias("window_start")).agg(
        F.count(c).alias("n"), F.avg(c).alias("mean"), (F.var_pop(c) * F.count(c)).alias("m2"),
        F.min(c).alias("low"), F.max(c).alias("high"), F.count(F.when(F.col("is_anomaly"), 1)).alias("anomalies"),
        F.count(F.lit(1)).alias("rows"))


def _fold(part: Column) -> Column:
    """Moments rows, in order -> the moments of all of them."""
    none = F.lit(None).cast("double")
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"), none.alias("low"),
                    none.alias("high"), F.lit(0).cast("long").alias("anomalies"), F.lit(0).cast("long").alias("rows"))

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        d = b["mean"] - a["mean"]
        some = b["n"] > 0           # a window may hold rows without a temperature
        return F.struct(
            n.alias("n"), F.when(some, a["mean"] + d * b["n"] / n).otherwise(a["mean"]).alias("mean"),
            F.when(some, a["m2"] + b["m2"] + d * d * a["n"] * b["n"] / n).otherwise(a["m2"]).alias("m2"),
            F.least(a["low"], b["low"]).alias("low"), F.greatest(a["high"], b["high"]).alias("high"),
            (a["anomalies"] + b["anomalies"]).alias("anomalies"), (a["rows"] + b["rows"]).alias("rows"))

    return F.aggregate(part, zero, add)


def merged(moments: DataFrame, *keys: Column | str) -> DataFrame:
    """Moments rows -> one for each value of ``keys``. The rows of one must be few (see module docstring)."""
    row = F.struct("window_start", *_PARTS, "rows")
    folded = moments.groupBy(*keys).agg(_fold(F.array_sort(F.collect_list(row))).alias("_m"))
    return folded.select(*[c for c in folded.columns if c != "_m"], "_m.*")


def hour_moments(minutes: DataFrame) -> DataFrame:
    """Minutes rolled up to hours."""
    return merged(minutes, "device_id", F.date_trunc("hour", "window_start").alias("window_start"))


def _floor(at: _dt.datetime, width: _dt.timedelta) -> _dt.datetime:
    return at - (at - _EPOCH) % width


def _ceil(at: _dt.datetime, width: _dt.timedelta) -> _dt.datetime:
    return _floor(at + width - _dt.timedelta(microseconds=1), width)


def _between(df: DataFrame, col: str, low: _dt.datetime, high: _dt.datetime) -> DataFrame:
    return df.filter((F.col(col) >= utc_literal(low)) & (F.col(col) < utc_literal(high)))


def range_moments(readings: DataFrame, minutes: DataFrame, hours: DataFrame, after: _dt.datetime, upto: _dt.datetime) -> DataFrame:
    """Moments rows that together cover the readings with ``after < event_timestamp <= upto``, each reading once."""
    low, high = (utc(t) + _dt.timedelta(microseconds=1) for t in (after, upto))      # low <= time < high
    parts = []

    def cover(lo: _dt.datetime, hi: _dt.datetime, levels: list[tuple[DataFrame, _dt.timedelta]]) -> None:
        if lo >= hi:
            return
        if not levels:
            parts.append(_of_raw(_between(readings, "event_timestamp", lo, hi), F.date_trunc("minute", "event_timestamp")))
            return
        (table, width), *finer = levels
        first, last = _ceil(lo, width), _floor(hi, width)
        if first >= last:
            cover(lo, hi, finer)
            return
        parts.append(_between(table, "window_start", first, last))
        cover(lo, first, finer)
        cover(last, hi, finer)

    cover(low, high, [(hours, HOUR), (minutes, MINUTE)])
    columns = ["device_id", "window_start", *_PARTS, "rows"]
    out = minutes.select(*columns).limit(0) if not parts else parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def temperature_stats(readings: DataFrame, minutes: DataFrame, hours: DataFrame, as_of: _dt.datetime,
                      span: _dt.timedelta = 24 * HOUR) -> DataFrame:
    """``views.temperature_stats`` of the strict trailing range, from the moments tables."""
    stats = merged(range_moments(readings, minutes, hours, utc(as_of) - span, as_of), "device_id")
    return stats.select(
        "device_id", F.col("rows").alias("reading_count"), F.when(F.col("n") > 0, F.col("mean")).alias("avg_temp_celsius"),
        F.col("low").alias("min_temp_celsius"), F.col("high").alias("max_temp_celsius"),
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev_temp_celsius"),
        F.col("anomalies").alias("anomaly_count"))
