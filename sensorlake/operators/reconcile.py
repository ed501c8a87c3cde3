"""Reconciliation of a fan-out (B-15, B-17): order-free fingerprints of batches and tables.

A micro-batch goes to several tables. A row count per table (the audit) finds a
lost batch, but not a row lost here and doubled there, or a value that went to
the wrong row. A fingerprint does, and needs no sort: the number of rows, the sum of the rows' 64-bit
hashes and the exclusive or of a second hash. All three are ordinary aggregates (partial
per map task), they don't depend on order or partitioning, and they add up: the
fingerprint of a table's batch is taken from the batch when it is written and again from the
table later, by batch id.

Columns that a run stamps itself (``RUN_TIMES``) are left out, and those that the sink adds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.sinks.relational import RUN_TIMES

#: Columns that the sinks add to a row.
SINK_COLUMNS = ("event_date", "batch_id")

FINGERPRINT_SCHEMA = "target string, batch_id long, row_count long, hash_sum decimal(38,0), hash_xor long"

# What a comparison can say.
OK, LOST, DOUBLED, CHANGED, MISSING, UNEXPECTED = "ok", "rows_lost", "rows_doubled", "rows_changed", "batch_missing", "batch_unexpected"


def hashed_columns(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c not in RUN_TIMES and c not in SINK_COLUMNS)


def _aggregates(columns: Sequence[str]) -> list:
    """Count, sum and xor of the hashes of the rows; the two hashes differ in seed."""
    plain = [F.col(c) for c in columns]
    return [F.count(F.lit(1)).alias("row_count"), F.sum(F.xxhash64(*plain).cast("decimal(38,0)")).alias("hash_sum"),
            F.bit_xor(F.xxhash64(F.lit("second"), *plain)).alias("hash_xor")]


def fingerprint(batch: DataFrame, target: str, batch_id: int, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: what ``batch``, written to ``target`` as ``batch_id``, should be found as. An empty batch has count 0."""
    return batch.agg(*_aggregates(columns or hashed_columns(batch))).select(
        F.lit(target).alias("target"), F.lit(int(batch_id)).cast("long").alias("batch_id"), "row_count", "hash_sum", "hash_xor")


def stored_fingerprints(table: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row for every batch id that a stored table holds rows of."""
    return table.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(*_aggregates(columns or hashed_columns(table))).select(
        F.lit(target).alias("target"), "batch_id", "row_count", "hash_sum", "hash_xor")


def compare(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Per target and batch id: ``target, batch_id, status, expected_rows, stored_rows``.

    Several expected rows of one target and batch (a batch that was run again) must be alike; they count as one.
    """
    keys = ["target", "batch_id"]
    marks = ["row_count", "hash_sum", "hash_xor"]
    want = expected.filter("row_count > 0").select(*keys, *marks).distinct()
    have = stored.select(*keys, *[F.col(c).alias(f"_{c}") for c in marks])
    same = F.lit(True)
    for c in marks:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    status = (F.when(F.col("_row_count").isNull(), MISSING).when(F.col("row_count").isNull(), UNEXPECTED).when(same, OK)
              .when(F.col("_row_count") < F.col("row_count"), LOST).when(F.col("_row_count") > F.col("row_count"), DOUBLED)
              .otherwise(CHANGED))
    return want.join(have, keys, "full").select(
        *keys, status.alias("status"), F.coalesce("row_count", F.lit(0)).cast("long").alias("expected_rows"),
        F.coalesce("_row_count", F.lit(0)).cast("long").alias("stored_rows"))
