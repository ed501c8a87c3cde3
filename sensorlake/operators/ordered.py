"""Skew-proof "what comes later in my key" scan.

For every *probe* row the operator returns, among the *target* rows with the
same key and a strictly greater order value,

* ``later_count`` -- how many there are, and
* ``later_min``   -- the smallest such order value (the next target).

That is the core of first-close pairing (an as-of join forward in time) and of
counting open/close pairs by duration band, without ever emitting pairs.

Plan (one shuffle of the input, no window over a whole key):

1. union probes and targets, ``repartitionByRange`` on (key, order, kind, tie):
   Spark samples the bounds, so a key that holds a third of all rows is spread
   over many partitions; identical order values are split by the tie column;
2. inside each range partition, a vectorised pandas pass walks the rows in
   descending order and keeps running counts / minima per key (carried across
   Arrow batches), and emits one summary row per (partition, key);
3. the result is ``checkpoint()``-ed to the shared checkpoint folder, which
   pins the partition ids and cuts lineage (a lost executor recomputes from
   the checkpoint, not from a re-sampled range shuffle);
4. the per-(partition, key) summaries -- at most #keys + #partitions rows --
   are turned into "everything in later partitions" by a window over the
   partitions of one key (bounded by the partition count). Only keys that go on
   in a later partition have one -- at most one a partition boundary, since the
   rows are range-partitioned by key -- and only those are joined back on
   (partition, key), a side of at most #partitions rows.

Ordering contract: at an equal order value targets sort before probes, so a
target never counts as "later" than a probe with the same value.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from sensorlake.session import checkpoint_root, estimated_bytes, partitions_for_size, scratch_path, setting

_KIND_TARGET, _KIND_PROBE, _KIND_SUMMARY = 0, 1, 2


def _scan_partition(keys: Sequence[str], payload: Sequence[str]):
    out_cols = [*keys, "_o", "_k", *payload, "_pid", "_cnt", "_min"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        from pyspark import TaskContext

        none = np.iinfo(np.int64).max            # "no target seen yet"
        pid = TaskContext.get().partitionId()
        carry_key, carry_cnt, carry_min = None, 0, none
        for pdf in batches:
            if pdf.empty:
                continue
            pdf = pdf.reset_index(drop=True)
            kf = pdf[list(keys)]
            starts = (kf != kf.shift()).any(axis=1).to_numpy()
            starts[0] = True
            group = np.cumsum(starts)
            is_target = (pdf["_k"] == _KIND_TARGET).to_numpy()
            o = pdf["_o"].to_numpy(dtype=np.int64)
            # rows arrive in descending order: "seen before" == "later in time", and the
            # smallest target seen so far is the next target after the current row
            tgt_one = is_target.astype(np.int64)
            tgt_o = np.where(is_target, o, none)
            by_group = pd.DataFrame({"g": group, "n": tgt_one, "m": tgt_o}).groupby("g", sort=False)
            count_incl = by_group["n"].cumsum().to_numpy()
            min_incl = by_group["m"].cummin().to_numpy()
            if carry_key is not None and tuple(kf.iloc[0]) == carry_key:
                first = group == 1
                count_incl = np.where(first, count_incl + carry_cnt, count_incl)
                min_incl = np.where(first, np.minimum(min_incl, carry_min), min_incl)
            count_excl = count_incl - tgt_one          # probes are not targets: same value

            probe = ~is_target
            probes = pdf.loc[probe, [*keys, "_o", "_k", *payload]].copy()
            probes["_pid"] = pid
            probes["_cnt"] = count_excl[probe]
            pmin = min_incl[probe]
            probes["_min"] = pd.arrays.IntegerArray(np.where(pmin == none, 0, pmin), pmin == none)

            summary = kf.groupby(group, sort=False).first().reset_index(drop=True)
            agg = by_group.agg(n=("n", "sum"), m=("m", "min"))
            summary["_o"] = pd.arrays.IntegerArray(np.zeros(len(summary), np.int64), np.ones(len(summary), bool))
            summary["_k"] = _KIND_SUMMARY
            for c in payload:
                summary[c] = None
            summary["_pid"] = pid
            summary["_cnt"] = agg["n"].to_numpy()
            smin = agg["m"].to_numpy()
            summary["_min"] = pd.arrays.IntegerArray(np.where(smin == none, 0, smin), smin == none)

            carry_key = tuple(kf.iloc[-1])
            carry_cnt = int(count_incl[-1])
            carry_min = int(min_incl[-1])
            with warnings.catch_warnings():
                warnings.simplefilter("ignore", FutureWarning)
                yield pd.concat([probes[out_cols], summary[out_cols]], ignore_index=True)

    return scan


def _partitions_for(df: DataFrame) -> int:
    """Range partition count from Catalyst's size estimate of the input.

    One partition per ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` of
    estimated input, and enough for the cluster's cores; without an estimate (a
    micro-batch) the session's shuffle partitions.
    """
    return partitions_for_size(df.sparkSession, estimated_bytes(df))


def _materialize(df: DataFrame, created: list[str] | None = None) -> DataFrame:
    """Write to a table in the shared checkpoint folder and read it back (cuts lineage,
    pins ``_pid``; a lost executor re-reads files instead of re-sampling the range shuffle).
    The folder is appended to ``created`` so a caller that consumed the result can delete it."""
    path = scratch_path(df.sparkSession, "ordered-scan")
    # fewer, larger Arrow batches for the pandas pass (narrow rows, about 10 MB a batch)
    with setting(df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", "65536"):
        df.write.mode("errorifexists").parquet(path)
    if created is not None:
        created.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_table(probes: DataFrame, targets: DataFrame, keys: Sequence[str], order: str,
               tie: str | None = None, n_partitions: int | None = None,
               created: list[str] | None = None) -> DataFrame:
    """Steps 1-3: range-partition, scan each partition, write the result to the shared folder.

    Returns the written table: probe rows (``_k`` = 1) with in-partition
    ``_cnt`` / ``_min`` and summary rows (``_k`` = 2) per (``_pid``, key).
    """
    spark = probes.sparkSession
    checkpoint_root(spark)
    keys = list(keys)
    payload = [c for c in probes.columns if c not in (*keys, order)]
    probe_schema = {f.name: f.dataType for f in probes.schema.fields}

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        tie_col = F.col(tie).cast("long") if tie else F.lit(0).cast("long")
        cols = [F.col(k) for k in keys] + [
            F.col(order).cast("long").alias("_o"), F.lit(kind).alias("_k"), tie_col.alias("_t")]
        for c in payload:
            cols.append(F.col(c) if kind == _KIND_PROBE else F.lit(None).cast(probe_schema[c]).alias(c))
        nonnull = F.col(order).isNotNull()
        for k in keys:
            nonnull = nonnull & F.col(k).isNotNull()
        return df.filter(nonnull).select(*cols)

    both = shaped(probes, _KIND_PROBE).unionByName(
        shaped(targets.select(*keys, order, *([tie] if tie else [])), _KIND_TARGET))
    n = n_partitions or _partitions_for(both)
    ranged = (both.repartitionByRange(n, *keys, "_o", "_k", "_t")
                  .sortWithinPartitions(*keys, F.desc("_o"), F.desc("_k"), F.desc("_t"))
                  .drop("_t"))
    out_schema = StructType(
        [both.schema[k] for k in keys]
        + [StructField("_o", LongType()), StructField("_k", IntegerType())]
        + [StructField(c, probe_schema[c], True) for c in payload]
        + [StructField("_pid", IntegerType()), StructField("_cnt", LongType()), StructField("_min", LongType())]
    )
    return _materialize(ranged.mapInPandas(_scan_partition(keys, payload), out_schema), created)


def later_targets(probes: DataFrame, targets: DataFrame, keys: Sequence[str], order: str,
                  tie: str | None = None, n_partitions: int | None = None,
                  created: list[str] | None = None) -> DataFrame:
    """Per probe row: count and smallest order value of same-key targets with a greater order.

    ``order`` (and ``tie``) must be integral columns present in both inputs;
    every other probe column is carried through. Rows with a NULL key or order
    are dropped (they pair with nothing). Returns the probe columns plus
    ``later_count`` (long) and ``later_min`` (long, NULL when none). The folder
    of the intermediate table is appended to ``created`` (if given); it may be
    deleted once every action on the result has run.
    """
    keys = list(keys)
    payload = [c for c in probes.columns if c not in (*keys, order)]
    scanned = scan_table(probes, targets, keys, order, tie, n_partitions, created)

    # step 4: what lies in later partitions of the same key
    per_part = (scanned.filter(F.col("_k") == _KIND_SUMMARY)
                .groupBy("_pid", *keys)
                .agg(F.sum("_cnt").alias("_pcnt"), F.min("_min").alias("_pmin")))
    later_parts = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(1, Window.unboundedFollowing)
    suffix = per_part.select("_pid", *keys,
                             F.sum("_pcnt").over(later_parts).alias("_acnt"),
                             F.min("_pmin").over(later_parts).alias("_amin")).filter("_acnt is not null")
    return (scanned.filter(F.col("_k") == _KIND_PROBE)
            .join(suffix, ["_pid", *keys], "left")
            .select(*keys, F.col("_o").alias(order), *payload,
                    (F.col("_cnt") + F.coalesce(F.col("_acnt"), F.lit(0))).alias("later_count"),
                    F.coalesce(F.col("_min"), F.col("_amin")).alias("later_min")))
