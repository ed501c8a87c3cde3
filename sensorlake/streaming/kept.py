"""Small running states kept as versioned tables: the newest row of every key (N-1), a bottom-k sample (L-9).

Both are commutative merges, so batches may come in any order. Batch ``b``
reads only what batch ``b - 1`` left and writes its own version, so a batch
that is run again writes the same version; versions that neither of the last
two batches needs are deleted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorlake.operators.sampling import replay_sample
from sensorlake.session import child_folders, delete_path, path_exists

_MANIFEST = "bucket int, version long"


def _versions(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the whole folders ``<name>=<n>`` under ``path``."""
    found = [n for n in child_folders(spark, path) if n.startswith(f"{name}=")]
    return sorted(int(n.partition("=")[2]) for n in found if path_exists(spark, f"{path}/{n}/_SUCCESS"))


@dataclass(frozen=True)
class LatestTable:
    """One row a key, the one that ``order`` puts last, in ``buckets`` folders by a hash of the key.

    A batch is reduced to one row a key by a partial ``max_by``; only the buckets
    it has keys of are merged with their last version and written anew. The
    manifest of a batch names, for every bucket, the version that holds it
    (``buckets`` rows). Rows with a NULL key are one key; NULLs in ``order`` are least.
    """
    path: str
    schema: StructType                  # of the rows
    keys: Sequence[str]
    order: Sequence[str]
    buckets: int = 64

    def _newest(self, rows: DataFrame) -> DataFrame:
        names = self.schema.fieldNames()
        newest = F.max_by(F.struct(*names), F.struct(*self.order)).alias("_newest")
        return rows.groupBy("bucket", *[F.col(k).alias(f"_key_{k}") for k in self.keys]).agg(newest).select("bucket", "_newest.*")

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.select(F.pmod(F.hash(*self.keys), F.lit(self.buckets)).alias("bucket"), *self.schema.fieldNames())

    def _manifest(self, spark: SparkSession, batch_id: int) -> dict[int, int]:
        if batch_id < 0:
            return {}
        return {r["bucket"]: r["version"] for r in
                spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/batch_id={batch_id}").collect()}

    def _at(self, spark: SparkSession, held: dict[int, int]) -> DataFrame:
        """The rows of the given versions of buckets."""
        out = spark.createDataFrame([], StructType([*StructType().add("bucket", "integer").fields, *self.schema.fields]))
        if held:
            by_bucket = F.create_map(*[F.lit(x) for b in sorted(held) for x in (b, held[b])])
            paths = [f"{self.path}/version={v}/bucket={b}" for b, v in sorted(held.items())]
            stored = spark.read.schema(self.schema).parquet(*paths)
            out = out.unionByName(self._bucketed(stored).filter(by_bucket[F.col("bucket")].isNotNull()))
        return out

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one batch into the version of the batch before."""
        spark, batch_id = batch.sparkSession, int(batch_id)
        held = self._manifest(spark, batch_id - 1)
        newest = self._newest(self._bucketed(batch)).persist()
        try:
            touched = {r[0] for r in newest.select("bucket").distinct().collect()}       # ``buckets`` at most
            before = self._at(spark, {b: v for b, v in held.items() if b in touched})
            self._newest(before.unionByName(newest)).write.mode("overwrite").partitionBy("bucket").parquet(
                f"{self.path}/version={batch_id}")
        finally:
            newest.unpersist()
        now = held | {b: batch_id for b in touched}
        spark.createDataFrame(sorted(now.items()), _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/manifest/batch_id={batch_id}")
        needed = set(now.values()) | set(held.values()) | {batch_id}
        for version in _versions(spark, self.path, "version"):
            if version < batch_id and version not in needed:
                delete_path(spark, f"{self.path}/version={version}")
        if batch_id >= 2:
            delete_path(spark, f"{self.path}/manifest/batch_id={batch_id - 2}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row of every key after the last batch."""
        done = _versions(spark, f"{self.path}/manifest", "batch_id")
        return self._at(spark, self._manifest(spark, done[-1]) if done else {}).drop("bucket")


@dataclass(frozen=True)
class RunningSample:
    """A bottom-k sketch: the ``n`` rows least by a seeded hash of ``id_col``, over all batches so far.

    The least n of a union are among the least n of its parts, so the state is n
    rows and a batch costs a top-k. Equal to ``sampling.replay_sample`` over all rows.
    """
    path: str
    schema: StructType
    n: int
    id_col: str
    seed: int = 0

    def _state(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id}")

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        spark, batch_id = batch.sparkSession, int(batch_id)
        both = self._state(spark, batch_id - 1).unionByName(batch.select(*self.schema.fieldNames()))
        replay_sample(both, self.n, self.id_col, self.seed).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        if batch_id >= 2:
            delete_path(spark, f"{self.path}/batch_id={batch_id - 2}")

    def read(self, spark: SparkSession) -> DataFrame:
        done = _versions(spark, self.path, "batch_id")
        return self._state(spark, done[-1] if done else -1)
