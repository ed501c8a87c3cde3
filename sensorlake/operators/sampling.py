"""Replay helpers: seeded sample (L-9) and duplicate removal (S-11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_key(id_col: Column, seed: int = 0) -> Column:
    """A hash of id and seed that any SQL engine has: neighbouring ids, and other seeds, are unrelated."""
    return F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(f"/{seed}")))


def replay_sample(df: DataFrame, n: int, id_col: str, seed: int = 0) -> DataFrame:
    """At most ``n`` rows without replacement, in a seeded pseudo-random order.

    A sampling operator: the limit is the feature. Planned as a top-k
    (TakeOrderedAndProject), so each task keeps only ``n`` candidates.
    """
    return df.orderBy(sample_key(F.col(id_col), seed), F.col(id_col)).limit(n)


def drop_replayed(df: DataFrame, identity: Sequence[str] | None = None) -> DataFrame:
    """Remove re-sent copies: one row per record identity (such as topic, partition and offset, or a
    record's own id), or per distinct row if no identity is named. Device and time are no identity: a
    device may report twice in an instant.

    Batch: a hash aggregate with map-side combine. Stream: bounded state via
    ``dropDuplicatesWithinWatermark`` (the input must carry a watermark).
    """
    keys = list(identity or df.columns)
    return df.dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)
