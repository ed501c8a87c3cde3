"""Access paths as file layout (M-6): several columns interleaved, and an index of what each file holds.

A table sorted by one key serves filters on that key; the dashboards also filter
by anomaly flag and type, by event type and by the unusual flag. Here every
column named gets a *rank* of ``RANK_BITS`` bits (how many of the column's
quantiles lie below the value, so ranks are even whatever the distribution; a
column of few values spreads them over all bits), the bits of the ranks are
interleaved, and the rows are range-partitioned by that number: a file then
holds a narrow range of each column.

Next to the data goes ``_files``: per file the least and greatest value of the
columns (from one aggregate by file name). :func:`read_where` compares a filter with
it and opens only files that can hold rows; the filter is still applied. A
table has thousands of files at most a date, so the index fits the driver.
"""

from __future__ import annotations

import math
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from sensorlake.session import estimated_bytes, partitions_for_size

RANK_BITS = 8
_ACCURACY = 1000        # of the quantiles; a rank may be off by 1/1000 of the rows, which moves no row out of the result


def _number(name: str, kind: DataType, shared: int = 0) -> Column:
    """A number that sorts as the column does (strings: by seven bytes after the ``shared`` ones that all begin with)."""
    c = F.col(name)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (NumericType, BooleanType)):
        return c.cast("double")
    if isinstance(kind, StringType):
        return F.conv(F.hex(F.rpad(F.substring(c.cast("binary"), shared + 1, 7), 7, b"\x00")), 16, 10).cast("double")
    raise TypeError(f"{name}: no order for {kind.simpleString()}")


def _numbers(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """The columns as numbers; what all values of a string column begin with is the least's and the greatest's prefix."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    ends = df.agg(*[f(c).cast("binary").alias(f"{n}_{c}") for c in texts for n, f in (("low", F.min), ("high", F.max))]).first() if texts else {}
    shared = {c: len(os.path.commonprefix([bytes(ends[f"low_{c}"] or b""), bytes(ends[f"high_{c}"] or b"")])) for c in texts}
    return {c: _number(c, df.schema[c].dataType, shared.get(c, 0)) for c in columns}


def _quantiles(df: DataFrame, numbers: dict[str, Column]) -> dict[str, list[float]]:
    """The distinct ones of 2 ** RANK_BITS quantiles a column, rising to the greatest value, from one aggregate with
    bounded sketches."""
    n = 1 << RANK_BITS
    at = F.array(*[F.lit(i / n) for i in range(1, n + 1)])
    row = df.agg(*[F.percentile_approx(number, at, F.lit(_ACCURACY)).alias(c) for c, number in numbers.items()]).first()
    return {c: sorted(set(row[c] or [])) for c in numbers}


def _rank(number: str, bounds: list[float]) -> Column:
    """How many bounds lie below the value, spread over the bits, by bisection; NULL is least."""
    def below(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {number} > {bounds[mid]!r}D THEN {below(mid + 1, hi)} ELSE {below(lo, mid)} END"

    bounds = [b for b in bounds if math.isfinite(b)]
    if not bounds:
        return F.lit(0)
    return F.least(F.expr(below(0, len(bounds))) * ((1 << RANK_BITS) // len(bounds)), F.lit((1 << RANK_BITS) - 1))


def interleaved(df: DataFrame, columns: Sequence[str], out: str = "_z") -> DataFrame:
    """``df`` with ``out``: the bits of the columns' ranks in turn, the leading ones first."""
    numbers = _numbers(df, columns)
    bounds = _quantiles(df, numbers)
    names = {c: f"_n{i}" for i, c in enumerate(columns)}
    ranked = df.withColumns({names[c]: numbers[c] for c in columns}).withColumns({f"_r{i}": _rank(names[c], bounds[c]) for i, c in enumerate(columns)})
    z = F.lit(0).cast("long")
    for bit in range(RANK_BITS):
        for k in range(len(columns)):
            place = bit * len(columns) + (len(columns) - 1 - k)
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(f"_r{k}"), bit).bitwiseAND(F.lit(1)).cast("long"), place))
    return ranked.withColumn(out, z).select(*[df[f"`{c}`"] for c in df.columns], out)


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str], at_least: int = 1) -> None:
    """Write ``df`` in as many files as its size needs (``at_least`` so many), interleaved by ``columns`` (7 at most), and their index."""
    if not 0 < len(columns) * RANK_BITS < 63:
        raise ValueError(f"{len(columns)} columns of {RANK_BITS} bits don't fit a long")
    spark = df.sparkSession
    n = max(at_least, partitions_for_size(spark, estimated_bytes(df)))
    interleaved(df, columns).repartitionByRange(n, "_z").sortWithinPartitions("_z").drop("_z").write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    held = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
    missing = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns]
    stored.groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file")).agg(
        *held, *missing, F.count(F.lit(1)).alias("row_count")).coalesce(1).write.mode("overwrite").parquet(f"{path}/_files")


def files_where(spark: SparkSession, path: str, where: dict[str, tuple]) -> tuple[list[str], int]:
    """(the files that may hold rows with ``low <= column <= high`` for all of ``where``, how many there are). A None bound is open."""
    index = spark.read.parquet(f"{path}/_files")
    match = F.lit(True)
    for c, (low, high) in where.items():
        if low is not None:
            match = match & (F.col(f"high_{c}") >= F.lit(low))
        if high is not None:
            match = match & (F.col(f"low_{c}") <= F.lit(high))
    return [r["file"] for r in index.filter(match).select("file").collect()], index.count()


def read_where(spark: SparkSession, path: str, where: dict[str, tuple], schema) -> DataFrame:
    """The rows with ``low <= column <= high`` for every column of ``where``; only files that may hold some are opened."""
    files, _ = files_where(spark, path, where)
    df = spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in files]) if files else spark.createDataFrame([], schema)
    for c, (low, high) in where.items():
        df = df if low is None else df.filter(F.col(c) >= F.lit(low))
        df = df if high is None else df.filter(F.col(c) <= F.lit(high))
    return df
