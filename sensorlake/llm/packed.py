"""Texts packed into blocks, and the exchange of sorted arrays between blocks and buckets.

A *block* is a row that holds a few megabytes of texts (whole ones; a longer text is a block of
its own), so numpy can work on all of them at once. Operators that ask something about every
n-gram of the corpus send, for every block, one sorted array of hashes to every bucket of the
hash space, and get one array of answers back: what is exchanged is a few bytes a distinct
n-gram of a block, and an n-gram that stands in every text is one entry a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import n_parts, pinned

BLOCK_BYTES = 8 << 20
BLOCKS = "block long, ids array<long>, sizes array<long>, data binary"
_TEXT_LEVEL = 3         # an eighth smaller than the fastest level, for 1 s a 100 MB


def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made, codec = TaskContext.get().partitionId(), 0, pa.Codec("zstd", compression_level=_TEXT_LEVEL)
    ids, texts, held = [], [], 0

    def block() -> pa.RecordBatch:
        data = b"".join(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([task << 32 | made]), pa.array([ids], pa.list_(pa.int64())),
             pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
             pa.array([codec.compress(data, asbytes=True)], pa.binary())], ["block", "ids", "sizes", "data"])

    for batch in batches:
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary())):
            text = text.as_py() or b""
            if texts and held + len(text) > BLOCK_BYTES:
                yield block()
                made, ids, texts, held = made + 1, [], [], 0
            ids.append(key)
            texts.append(text)
            held += len(text)
    if texts:
        yield block()


def pack(docs: DataFrame) -> DataFrame:
    """doc_id (long), text of every row, null texts as empty ones -> blocks, written once."""
    return pinned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack_batches, BLOCKS))


class Block:
    """The texts of one row of ``pack``: text i is ``data[off[i]:off[i + 1]]``."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.number = batch.column("block")[row].as_py()
        self.ids = batch.column("ids")[row].values
        self.off = np.concatenate([[0], np.cumsum(batch.column("sizes")[row].values.to_numpy())])
        packed = batch.column("data")[row].as_buffer()
        self.bytes = pa.decompress(packed, int(self.off[-1]), "zstd", asbytes=True) if self.off[-1] else b""
        self.data = np.frombuffer(self.bytes, np.uint8)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.RecordBatch, int]]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield Block(batch, row), batch, row


def encoded(values: np.ndarray) -> bytes:
    """64-bit values, byte plane by byte plane, compressed: small values and small steps take little."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True) \
        if len(values) else b""


def decoded(data: bytes, n: int, kind=np.uint64) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data, n * 8, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(kind).reshape(n)


def encoded_sorted(values: np.ndarray) -> bytes:
    return encoded(np.diff(values, prepend=values.dtype.type(0)))


def decoded_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(decoded(data, n), dtype=np.uint64)


def slices(sorted_buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of every bucket that occurs."""
    cuts = np.flatnonzero(np.diff(sorted_buckets)) + 1
    edges = [0, *cuts.tolist(), len(sorted_buckets)]
    for lo, hi in zip(edges, edges[1:]):
        if hi > lo:
            yield int(sorted_buckets[lo]), lo, hi


def by_bucket(sent: DataFrame) -> DataFrame:
    """Rows with (bucket, block) -> the same, a bucket's rows together and by block."""
    return sent.repartition(n_parts(sent.sparkSession), "bucket").sortWithinPartitions("bucket", "block")


def buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """The rows of one bucket after another, of ``by_bucket``."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != now and rows:
                yield now, rows
                rows = []
            now = row["bucket"]
            rows.append(row)
    if rows:
        yield now, rows


def answered(blocks: DataFrame, **answers: DataFrame) -> DataFrame:
    """Every block with the rows (block, bucket, ...) that were sent back to it, as an array a name."""
    for name, rows in answers.items():
        rest = [c for c in rows.columns if c != "block"]
        blocks = blocks.join(rows.groupBy("block").agg(F.collect_list(F.struct(*rest)).alias(name)), "block", "left")
    return blocks


_SQL_NAMES = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string",
              pa.float64(): "double", pa.bool_(): "boolean"}


def ddl(schema: pa.Schema) -> str:
    """An Arrow schema of simple types as Spark writes it."""
    return ", ".join(f"{f.name} {_SQL_NAMES[f.type]}" for f in schema)


def batch_of(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def over_blocks(fn: Callable, schema: pa.Schema) -> Callable:
    """fn(block, batch, row) -> list of dicts, as a function for mapInArrow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, batch, row in blocks_of(batches):
            if rows := fn(block, batch, row):
                yield batch_of(rows, schema)
    return run


def over_buckets(fn: Callable, schema: pa.Schema) -> Callable:
    """fn(bucket, rows) -> list of dicts, as a function for mapInArrow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in buckets_of(batches):
            if out := fn(bucket, rows):
                yield batch_of(out, schema)
    return run
