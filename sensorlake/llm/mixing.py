"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Targets: sources in code point order (null last) weigh 1, 2, 3, 1, ... and share the
words of the corpus by weight; a target stops at ``CAP`` times its source's words and the
excess is shared again by weight until no target is above. Sorted by cap per weight the
stopped sources are a prefix, so one pass of running sums over the source table solves it
exactly in integers.

Copies: every document of a source has the same expected number of copies r = target /
source words (at most ``CAP``). Documents stand in the order (size, hash bucket, doc_id,
text hash); with one random offset u in [0, 1) per source, document i is emitted once for
every integer in (u + (i-1) r, u + i r]. That is floor or ceil of r, so no document exceeds
``CAP`` copies, and, since neighbours in the order have nearly equal sizes, the words taken
stray from the target by about one document's size.

The prefix sum is never taken over a source in one task: rows are counted per cell
(source, size, bucket) and per class (source, root of the size); running sums over the classes of
a source and over the cells of a class give each cell's offset, and a row's position is its
offset plus its number within the cell.

Defined cases: null text or no words: size 0; null source: a source of its own; null doc_id:
a key like any other; repeated rows: each takes its own position, rows of one doc_id and text that
differ in other columns in the order of a hash of these; texts of any length; empty input: empty
result. ``copies`` reads no other columns, ``mix`` passes them on.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import pinned, table, tie, word_count

WEIGHTS = (1, 2, 3)     # by source in code point order, repeating
CAP = 3                 # copies of a document, and target per source word, at most
SEED = "mix-1"
_WIDE = "decimal(38,0)"
KEY = ["_source", "doc_id", "_text"]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size and hashes that name a row: ``_source`` (null-safe) and ``_text``."""
    return docs.select(
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")).alias("_source"),
        "doc_id", F.coalesce(F.md5("text"), F.lit("~")).alias("_text"), word_count(F.col("text")).alias("size"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(_source, size) rows -> one row per source; its target is the fraction _num / _den.

    The windows here run over the source table (one row per source), not over documents.
    """
    per = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    named = Window.partitionBy().orderBy(F.col("_source") == "n", "_source")
    weights = F.array(*map(F.lit, WEIGHTS))
    per = per.withColumn("_w", F.element_at(weights, ((F.row_number().over(named) - 1) % len(WEIGHTS) + 1).cast("int")))
    by_cap = Window.partitionBy().orderBy(F.expr(f"source_size * {math.lcm(*WEIGHTS)} div _w"), "_source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    per = (per
           # what is left to share, and among which weights, once all sources before this one have stopped
           .withColumn("_rest", F.sum("source_size").over(everything)
                       - CAP * F.coalesce(F.sum("source_size").over(before), zero))
           .withColumn("_rest_w", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), zero))
           .withColumn("_stop", F.expr(f"cast(_rest as {_WIDE}) * _w > cast({CAP} * source_size as {_WIDE}) * _rest_w"))
           .withColumn("_stopped", F.min("_stop").over(by_cap.rowsBetween(Window.unboundedPreceding, 0)))
           # the first source that doesn't stop has the largest weight left
           .withColumn("_free", F.max(F.when(~F.col("_stopped"), F.struct("_rest_w", "_rest"))).over(everything)))
    return per.select(
        "_source", "source_size",
        F.expr(f"cast(if(_stopped, {CAP} * source_size, _free._rest * _w) as {_WIDE})").alias("_num"),
        F.expr(f"cast(if(_stopped, 1, _free._rest_w) as {_WIDE})").alias("_den"))


def copies(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """One row per document: _source, doc_id, _text, size, source_size, target, copies, taken."""
    rows = pinned(_keyed(docs).withColumn("_bucket", F.substring(F.md5(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.lit("|"), "_text")), 1, 2)))
    cell = ["_source", "size", "_bucket"]
    counted = rows.groupBy(*cell).agg(F.count("*").alias("_n")).withColumn("_class", F.floor(F.sqrt("size")))
    earlier = Window.partitionBy("_source").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("_source", "_class").orderBy("size", "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    classes = counted.groupBy("_source", "_class").agg(F.sum("_n").alias("_n")).select(
        "_source", "_class", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    offsets = counted.withColumn("_in", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(
        classes, ["_source", "_class"]).select(*cell, (F.col("_base") + F.col("_in")).alias("_offset"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed), "_source")), 1, 8), 16, 10).cast(_WIDE)
    sources = (source_targets(rows).withColumn("_draw", draw)
               .withColumn("_one", F.expr(f"cast(_den * source_size as {_WIDE})"))
               .withColumn("_u", F.expr(f"cast((_draw * _one) div 4294967296 as {_WIDE})")))
    numbered = rows.withColumn("_i", F.row_number().over(Window.partitionBy(*cell).orderBy("doc_id", "_text")))
    # r = _num / _one copies each; _u / _one is the offset: all in whole numbers
    return (numbered.join(offsets, cell).join(sources, "_source")
            .withColumn("_i", (F.col("_offset") + F.col("_i")).cast(_WIDE))
            .withColumn("copies", F.expr(
                "if(_one = 0, 0, (_i * _num + _u) div _one - ((_i - 1) * _num + _u) div _one)").cast("long"))
            .select("_source", "doc_id", "_text", "size", "source_size",
                    (F.col("_num").cast("double") / F.col("_den").cast("double")).alias("target"),
                    "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs``, all columns, as often as it was drawn (0 to ``CAP`` times)."""
    same = Window.partitionBy(*KEY)     # rows that differ in other columns go by a hash of these, so reruns agree
    drawn = copies(docs, seed).select(*KEY, "copies").withColumn("_k", F.row_number().over(same.orderBy("copies")))
    keyed = _keyed_rows(docs).withColumn("_k", F.row_number().over(same.orderBy("_tie")))
    null_safe = [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in [*KEY, "_k"]]
    on = null_safe[0] & null_safe[1] & null_safe[2] & null_safe[3]
    return (keyed.alias("d").join(drawn.filter("copies > 0").alias("m"), on)
            .select("d._row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m.copies"))).alias("_c"))
            .select("_row.*"))


def _keyed_rows(docs: DataFrame) -> DataFrame:
    """The whole row as one struct (so no column name can clash) with the columns that name it."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), *[
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")).alias("_source"),
        F.col("doc_id"), F.coalesce(F.md5("text"), F.lit("~")).alias("_text"), tie(docs).alias("_tie")])


def op4_mix(spark, sf_dir):
    """Words taken from every document of ``documents``."""
    return copies(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = rf"""
WITH rows AS (
  SELECT doc_id, source,
         CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS sk,
         coalesce(md5(text), '~') AS tx,
         coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0)::BIGINT AS size
  FROM documents),
cells AS (SELECT *, substr(md5(coalesce(doc_id::VARCHAR, '~') || '|' || tx), 1, 2) AS b FROM rows),
numbered AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY size, b, doc_id NULLS FIRST, tx) AS i FROM cells),
per AS (SELECT sk, sum(size)::HUGEINT AS s, row_number() OVER (ORDER BY sk = 'n', sk) AS rk FROM rows GROUP BY sk),
weighed AS (SELECT *, ((rk - 1) % {len(WEIGHTS)} + 1)::HUGEINT AS w FROM per),
ranked AS (SELECT *, sum(s) OVER () - {CAP} * coalesce(sum(s) OVER before, 0) AS rest,
                  sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS rest_w,
                  row_number() OVER (ORDER BY s * 6 // w, sk) AS k
           FROM weighed
           WINDOW before AS (ORDER BY s * 6 // w, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stops AS (SELECT *, min(CASE WHEN rest * w > {CAP} * s * rest_w THEN 1 ELSE 0 END) OVER (ORDER BY k) AS stopped FROM ranked),
free AS (SELECT rest AS f_rest, rest_w AS f_w FROM stops WHERE stopped = 0 ORDER BY k LIMIT 1),
targets AS (SELECT sk, s, CASE WHEN stopped = 1 THEN {CAP} * s ELSE f_rest * w END::HUGEINT AS num,
                   CASE WHEN stopped = 1 THEN 1 ELSE f_w END::HUGEINT AS den
            FROM stops LEFT JOIN free ON true),
drawn AS (SELECT *, den * s AS one, ((('0x' || substr(md5('{SEED}' || sk), 1, 8))::HUGEINT) * (den * s)) // 4294967296 AS u
          FROM targets)
SELECT doc_id, size, s::BIGINT AS source_size, num::DOUBLE / den::DOUBLE AS target,
       (size * CASE WHEN one = 0 THEN 0
                    ELSE (i * num + u) // one - ((i - 1) * num + u) // one END)::BIGINT AS taken
FROM numbered JOIN drawn USING (sk)
"""
