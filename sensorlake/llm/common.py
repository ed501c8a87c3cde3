"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import checkpoint_root

#: A word: a run of anything but ASCII space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes that one step of the vectorised passes works on; bounds their memory whatever a batch holds.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pinned(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder of the session: read once, lineage cut, survives a lost executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def n_parts(spark: SparkSession) -> int:
    """Partitions of a hand-made exchange: the session's shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def tie(docs: DataFrame) -> Column:
    """A hash of all columns but the text: orders rows that share doc_id and text, whatever their partition."""
    return F.xxhash64(F.to_json(F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != "text"])))


def steps(batches: Iterator[pa.RecordBatch], text: str = "text",
          limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` text bytes (at least one row each)."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.frombuffer(batch.column(text).buffers()[1], np.int32,
                              batch.num_rows + 1, batch.column(text).offset * 4) if batch.column(text).buffers()[1] \
            else np.zeros(batch.num_rows + 1, np.int32)
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(sizes, int(sizes[lo]) + limit, side="right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi
