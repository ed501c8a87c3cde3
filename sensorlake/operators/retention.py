"""Retention (M-3, D-5, F-9, F-10, G-11, M-4).

``cleanup_old_data`` in a relational store deletes rows older than
``as_of - days`` and logs the count. On Parquet there is no DELETE: rows are
split by the same strict predicate into kept and expired ones, and
:func:`apply_retention` does it on a stored table: it drops expired dates,
rewrites the cut-off's own date and stores the count as a metric row. A run
that stops at any step is finished by the next one (see there).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions.timefmt import utc, utc_literal
from sensorlake.operators.metrics import metric_rows
from sensorlake.operators.views import AsOf, resolve_as_of
from sensorlake.session import child_folders, children, delete_path, move_folder, path_exists

# Retention default and metric naming.
DEFAULT_DAYS_TO_KEEP = 30
CLEANUP_METRIC = "data_cleanup_temp_readings"
CLEANUP_UNIT = "rows_deleted"


def cutoff(df: DataFrame, as_of: AsOf, days_to_keep: int, col: str = "event_timestamp") -> Column:
    return resolve_as_of(df, as_of, col) - F.make_dt_interval(F.lit(days_to_keep))


def expired_predicate(df: DataFrame, as_of: AsOf, days_to_keep: int,
                      col: str = "event_timestamp") -> Column:
    """Strict: a row exactly at the cut-off is kept."""
    return F.col(col) < cutoff(df, as_of, days_to_keep, col)


def kept_rows(df: DataFrame, as_of: AsOf = None, days_to_keep: int = DEFAULT_DAYS_TO_KEEP,
              col: str = "event_timestamp") -> DataFrame:
    # NULL event times are not older than the cut-off, so they stay (as a DELETE would leave them)
    return df.filter(~F.coalesce(expired_predicate(df, as_of, days_to_keep, col), F.lit(False)))


def cleanup_metric(df: DataFrame, as_of: AsOf = None, days_to_keep: int = DEFAULT_DAYS_TO_KEEP,
                   col: str = "event_timestamp") -> DataFrame:
    """One metric row: number of expired rows, tagged with the retention setting."""
    at = resolve_as_of(df, as_of, col)
    expired = F.coalesce(expired_predicate(df, at, days_to_keep, col), F.lit(False))
    return df.agg(F.count_if(expired).cast("double").alias("metric_value")).select(
        F.lit(CLEANUP_METRIC).alias("metric_name"),
        "metric_value",
        F.lit(CLEANUP_UNIT).alias("metric_unit"),
        F.to_json(F.named_struct(F.lit("days_to_keep"), F.lit(days_to_keep))).alias("tags"),
        at.alias("timestamp"),
    )


INTENT_SCHEMA = "id string, as_of timestamp, days_to_keep int, deleted long, stored array<string>"


def apply_retention(spark: SparkSession, table_path: str, metrics_path: str, as_of: _dt.datetime,
                    days_to_keep: int = DEFAULT_DAYS_TO_KEEP, date_col: str = "event_date",
                    col: str = "event_timestamp") -> int:
    """Delete expired rows of a table laid out by date, store the metric row, return the number deleted.

    Dates before the cut-off's are dropped as folders, its own date is rewritten
    without its expired rows (its inner layout by ``batch_id`` is kept); later
    dates aren't touched. Only those dates are read.

    What is to be deleted, and how much it is, is written under ``_retention`` (a
    name that readers skip) before anything is: a run that stops is taken up again
    by the next, before its own work, so no kept row is lost and the stored count
    is the one intended. The old day is moved aside before the new one takes its
    place and deleted last. Batches that a writer adds to that day meanwhile are
    kept; the day is missing for readers between the two moves.
    """
    table_path = table_path.rstrip("/")
    work = f"{table_path}/_retention"
    resumed = _resume(spark, table_path, metrics_path, date_col, col)
    cut = utc(as_of) - _dt.timedelta(days=days_to_keep)
    if resumed is not None and resumed[0] == (utc(as_of), days_to_keep):
        return resumed[1]
    expired = (F.col(date_col) <= F.lit(cut.date())) & (F.col(col) < utc_literal(cut))
    dated = any(name.startswith(f"{date_col}=") for name in child_folders(spark, table_path))
    deleted = spark.read.parquet(table_path).filter(expired).count() if dated else 0
    stored = children(spark, _day(table_path, date_col, cut))
    spark.createDataFrame([(uuid.uuid4().hex, utc(as_of), days_to_keep, deleted, stored)], INTENT_SCHEMA).coalesce(1).write \
        .mode("overwrite").parquet(f"{work}/intent")
    _resume(spark, table_path, metrics_path, date_col, col)
    return deleted


def _day(table_path: str, date_col: str, at: _dt.datetime) -> str:
    return f"{table_path}/{date_col}={at.date().isoformat()}"


def _written(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def _resume(spark: SparkSession, table_path: str, metrics_path: str, date_col: str,
            col: str) -> tuple[tuple[_dt.datetime, int], int] | None:
    """Carry out the intent under ``_retention`` from wherever it stands; every step may be done again.
    Returns ((as_of, days), rows deleted), or None if there is no intent."""
    work = f"{table_path}/_retention"
    if not _written(spark, f"{work}/intent"):
        delete_path(spark, work)            # nothing was deleted before the intent was whole
        return None
    intent = spark.read.schema(INTENT_SCHEMA).parquet(f"{work}/intent").select(
        "id", F.unix_micros("as_of").alias("us"), "days_to_keep", "deleted", "stored").first()
    if intent is None:                      # it was being deleted, as the last thing
        delete_path(spark, work)
        return None
    as_of = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc) + _dt.timedelta(microseconds=intent["us"])
    cut = as_of - _dt.timedelta(days=intent["days_to_keep"])
    day, aside = _day(table_path, date_col, cut), _day(f"{work}/old", date_col, cut)
    if not path_exists(spark, aside):
        if not _written(spark, f"{work}/new") and path_exists(spark, day):
            table = spark.read.parquet(table_path)
            kept = table.filter((F.col(date_col) == F.lit(cut.date())) & F.coalesce(F.col(col) >= utc_literal(cut), F.lit(True)))
            inner = [c for c in ("batch_id",) if c in table.columns]
            kept.write.mode("overwrite").partitionBy(date_col, *inner).parquet(f"{work}/new")
        if path_exists(spark, day):
            move_folder(spark, day, aside)
    if path_exists(spark, aside):           # the new day takes its place, then what came while it was made
        new = _day(f"{work}/new", date_col, cut)
        came = [f"{aside}/{name}" for name in children(spark, aside) if name not in intent["stored"]]
        if path_exists(spark, new) and not path_exists(spark, day):
            move_folder(spark, new, day)
        # a writer may have made the day anew meanwhile: then its parts go in one by one
        for part in [f"{new}/{name}" for name in children(spark, new)] + came:
            there = f"{day}/{part.rpartition('/')[2]}"
            if not path_exists(spark, there):
                move_folder(spark, part, there)
    for name in child_folders(spark, table_path):
        if name.startswith(f"{date_col}=") and name.partition("=")[2] < cut.date().isoformat():
            delete_path(spark, f"{table_path}/{name}")
    metric = metric_rows(spark, [(CLEANUP_METRIC, intent["deleted"], CLEANUP_UNIT, {"days_to_keep": intent["days_to_keep"]})], as_of)
    metric.coalesce(1).write.mode("overwrite").parquet(f"{metrics_path.rstrip('/')}/run={intent['id']}")
    delete_path(spark, f"{work}/intent")    # from here on the run counts as done
    delete_path(spark, work)
    return (as_of, intent["days_to_keep"]), intent["deleted"]
