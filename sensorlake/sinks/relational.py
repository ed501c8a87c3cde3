"""JDBC sink with idempotent append (B-1, B-14, B-16, B-18) and table scan (A-7).

No JDBC driver ships with this repository; the code is written against
Spark's public ``jdbc`` data source options and works with any driver on the
classpath. Idempotence: the batch is anti-joined on its key (the bus position of
a reading or event; key and window of an aggregate) against
the rows already in the target *for the batch's own time range* (the range is
pushed down as a WHERE clause), then appended. Errors are raised, never
swallowed, so a failed batch is re-run on restart instead of being lost.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               predicate: str | None = None, partition_column: str | None = None,
               bounds: tuple[str, str] | None = None, partitions: int = 1) -> DataFrame:
    """Scan a relational table; ``predicate`` is pushed to the database. With a numeric, date or
    time column and its ``bounds`` (text, UTC) the scan is split over ``partitions`` connections;
    rows outside the bounds and NULLs are read too."""
    query = f"(SELECT * FROM {table} WHERE {predicate}) t" if predicate else table
    split = {}
    if partition_column and bounds and partitions > 1:
        split = {"column": partition_column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": partitions}
    return spark.read.jdbc(url, query, properties=properties or {}, **split)


def time_range(batch: DataFrame, time_col: str) -> str | None:
    """The WHERE clause that covers the batch's times (UTC text, as stored), rows without time included."""
    text = [F.date_format(f(time_col), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(n) for n, f in (("lo", F.min), ("hi", F.max))]
    lo, hi, missing = batch.agg(*text, F.count_if(F.col(time_col).isNull())).first()
    parts = ([f"{time_col} BETWEEN '{lo}' AND '{hi}'"] if lo else []) + ([f"{time_col} IS NULL"] if missing else [])
    return " OR ".join(parts) or None


#: Columns that differ from run to run of one batch.
RUN_TIMES = ("processing_timestamp", "created_at")


def _absent(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    there = existing.select(*[F.col(k).alias(f"_there_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_there_{k}"))
    return batch.dropDuplicates(list(keys)).join(there, same, "left_anti")


def new_rows(batch: DataFrame, existing: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Rows of ``batch``, one a key, whose key isn't in ``existing``; NULLs in a key equal each other. Rows
    whose key is all NULL have none: they are told apart by all their columns (but ``RUN_TIMES``)."""
    keys = list(key_cols)
    keyless = F.lit(True)
    for k in keys:
        keyless = keyless & F.col(k).isNull()
    whole = [c for c in batch.columns if c not in RUN_TIMES]
    return _absent(batch.filter(~keyless), existing, keys).unionByName(_absent(batch.filter(keyless), existing.filter(keyless), whole))


def append_new(batch: DataFrame, url: str, table: str, key_cols: Sequence[str],
               time_col: str, properties: dict | None = None) -> int:
    """Append rows of ``batch`` whose key is not yet in ``table``; return the count."""
    batch = batch.persist()
    try:
        predicate = time_range(batch, time_col)
        if predicate is None:
            return 0
        existing = read_table(batch.sparkSession, url, table, properties, predicate)
        obs = Observation(f"jdbc_append_{table}")
        new_rows(batch, existing, key_cols).observe(obs, F.count(F.lit(1)).alias("n")).write.jdbc(
            url, table, mode="append", properties=properties or {})
        return int(obs.get["n"])
    finally:
        batch.unpersist()


def jdbc_writer(url: str, table: str, key_cols: Sequence[str], time_col: str,
                properties: dict | None = None) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, url, table, key_cols, time_col, properties)
    return write
