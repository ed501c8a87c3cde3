"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased. Every item of the benchmark yields its
seeds of 3 words, or of 2 or 1 where 3 are too many for a short item (see ``_seed_words``).
Those that are common in the corpus compared with the item's other seeds (document frequency
over ``RARE`` times the item's median, and over ``RARE_FLOOR``) are not used, the most
frequent first, as long as every passage of the required similarity shares one that is. Documents are read once: a bit table of fixed size says which of a document's n-grams
can be seeds at all, and around such places the hashed words of the passage are kept.
The places join the seeds on the n-gram; a passage and an item that share at least as many
seeds as any passage of the required similarity must (see ``contaminated``) are aligned.

Similarity of a passage and an item of L words: (1 + s / L) / 2, s the best local alignment
score in words (match +1, mismatch and gap -1). A verbatim copy scores 1, one with a share
e of the words replaced or left out 1 - e. Rows are returned at ``SIMILARITY`` or more.

Exact copies and edited ones are found wherever they stand in a text, however long. Frequent
passages are no special case: each document's passage is one row, dealt by (document, item).

Defined cases: null or empty text: no words, no hit; null doc_id: reported under null;
repeated rows: reported once; items without words: never hit; empty tables: empty result. Only doc_id, text and
item_id are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import pinned, steps, table
from sensorlake.llm.kernels import PLAIN, Hasher, Texts, grams, words

SEED_WORDS = 3
SIMILARITY = 0.8
RARE, RARE_FLOOR = 8, 100
TABLE_BITS = 24         # the bit table has 2^24 bits (2 MB), whatever the benchmark's size
_HASH_SEED = 11


def _positions_left(n_words: int, seed: int, similarity: float) -> int:
    """Positions of an item's seeds of ``seed`` words that a passage of the similarity shares at least.

    With score s, m matches and m - s errors, the matches stand in at most m - s + 1 runs, each
    of which loses seed - 1 positions. That is linear in m, which is s at least and n_words at most.
    """
    s = max(1, math.ceil((2 * similarity - 1) * n_words - 1e-6))
    return min(m - (seed - 1) * (m - s + 1) for m in (s, n_words))


def _seed_words(n_words: int, similarity: float) -> int:
    """Words of an item's seeds: as many up to ``SEED_WORDS`` as leave a position to every passage of the similarity."""
    return next((k for k in range(SEED_WORDS, 1, -1) if _positions_left(n_words, k, similarity) >= 1), 1)


def _seed_lists(similarity: float):
    """item_id, text -> item_id, hashed words, seeds, positions of them that are left at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(_HASH_SEED)
        for batch in steps(batches):
            texts = Texts(batch.column("text"), lower=True)
            starts, ends, first = words(texts, PLAIN)
            hashed = hasher.runs(hasher.sums(texts.data), starts, ends)
            lists = [hashed[first[i]:first[i + 1]] for i in range(batch.num_rows)]
            sizes = [_seed_words(len(x), similarity) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([x.view(np.int64).tolist() for x in lists], pa.list_(pa.int64())),
                 pa.array([grams(x, k).view(np.int64).tolist() for x, k in zip(lists, sizes)], pa.list_(pa.int64())),
                 pa.array([_positions_left(len(x), k, similarity) for x, k in zip(lists, sizes)], pa.int64())],
                ["item_id", "item_words", "seeds", "n_left"])
    return run


def _places(bits: np.ndarray, lengths: list[int], around: int):
    """doc_id, th, text -> passages (first word, hashed words) with the n-grams in them that may be seeds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(_HASH_SEED)
        mask = np.uint64((1 << TABLE_BITS) - 1)
        for batch in steps(batches):
            texts = Texts(batch.column("text"), lower=True)
            starts, ends, first = words(texts, PLAIN)
            hashed = hasher.runs(hasher.sums(texts.data), starts, ends)
            doc_of = np.repeat(np.arange(batch.num_rows), np.diff(first))
            at, gram = [], []
            for n in lengths:
                g = grams(hashed, n) if len(hashed) >= n else hashed[:0]
                may = np.flatnonzero(bits[(g & mask) >> np.uint64(5)] >> (g & np.uint64(31)).astype(np.uint32) & np.uint32(1))
                may = may[doc_of[may] == doc_of[may + n - 1]]
                at.append(may)
                gram.append(g[may])
            at, gram = np.concatenate(at), np.concatenate(gram)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, gram = at[order], gram[order]
            doc = doc_of[at]
            new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (np.diff(at) > 2 * around)])
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(at))
            lo = np.maximum(at[begin] - around, first[doc[begin]])
            hi = np.minimum(at[end - 1] + around, first[doc[begin] + 1])
            for k in range(0, len(begin), 4096):
                b, e = begin[k:k + 4096], end[k:k + 4096]
                rows = pa.array(doc[b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("th").take(rows),
                     pa.array(lo[k:k + 4096] - first[doc[b]]),
                     pa.array([hashed[x:y].view(np.int64) for x, y in zip(lo[k:k + 4096], hi[k:k + 4096])],
                              pa.list_(pa.int64())),
                     pa.array([np.unique(gram[x:y].view(np.int64)) for x, y in zip(b, e)], pa.list_(pa.int64()))],
                    ["doc_id", "th", "start", "passage", "seeds"])
    return run


def align(passage: np.ndarray, item: np.ndarray) -> int:
    """Best local alignment score of two word sequences: match +1, mismatch and gap -1."""
    if not len(passage) or not len(item):
        return 0
    steps_, best = np.arange(len(passage)), 0
    row = np.zeros(len(passage), np.int64)
    for word in item:
        cell = np.where(passage == word, 1, -1)
        cell[1:] += row[:-1]
        np.maximum(cell, row - 1, out=cell)
        np.maximum(cell, 0, out=cell)
        row = np.maximum.accumulate(cell + steps_) - steps_     # gaps along the passage
        best = max(best, int(row.max()))
    return best


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        passages, items = batch.column("passage"), batch.column("item_words")
        score = []
        for i in range(batch.num_rows):
            item = items[i].values.to_numpy()
            score.append((1 + align(passages[i].values.to_numpy(), item) / len(item)) / 2)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "th", "item_id", "start")), pa.array(score, pa.float64())],
            ["doc_id", "th", "item_id", "start", "similarity"])


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, th (hash of the text), item_id, start (word of the passage), similarity: the hits.

    A passage of the similarity shares ``n_left`` positions of an item's seeds at least. Seeds that
    aren't used have fewer positions than that, so one that is used is shared; and as a seed is lost
    only with all its positions, no more of the used seeds are lost than positions.
    """
    spark = docs.sparkSession
    bench = pinned(items.select("item_id", "text").mapInArrow(
        _seed_lists(similarity), "item_id long, item_words array<long>, seeds array<long>, n_left long")
        .filter(F.size("item_words") > 0).dropDuplicates(["item_id", "item_words"])
        .withColumn("bench_id", F.xxhash64("item_id", "item_words")))
    seeds = (bench.select("bench_id", "n_left", F.size("seeds").alias("n_places"), F.explode("seeds").alias("seed"))
             .groupBy("bench_id", "n_left", "n_places", "seed").agg(F.count("*").alias("places")))
    slot = F.col("seed").bitwiseAND((1 << TABLE_BITS) - 1)
    table_rows = (seeds.groupBy(F.shiftright(slot, 5).alias("w"))
                  .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(seed & 31 as int))")).alias("b")).collect())  # bounded
    bits = np.zeros(1 << (TABLE_BITS - 5), np.uint32)
    for r in table_rows:
        bits[r.w] = r.b
    longest = bench.agg(F.max(F.size("item_words"))).first()[0] or 0
    if not longest:
        return spark.createDataFrame([], "doc_id long, th long, item_id long, start long, similarity double")
    lengths = sorted(r[0] for r in bench.select(F.size("item_words") - F.size("seeds") + 1).distinct().collect())
    found = pinned(docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(
        _places(bits, lengths, 2 * longest),
        "doc_id long, th long, start long, passage array<long>, seeds array<long>"))
    hits = found.select("doc_id", "th", "start", F.explode("seeds").alias("seed")).distinct()
    frequent = hits.groupBy("seed").agg(F.count_distinct("doc_id", "th").alias("df"))
    known = seeds.join(frequent, "seed", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    middle = known.groupBy("bench_id").agg(F.median("df").alias("mid"))
    falling = Window.partitionBy("bench_id").orderBy(F.desc("df"), "seed").rowsBetween(Window.unboundedPreceding, 0)
    common = (F.col("df") > F.greatest(F.lit(RARE_FLOOR), RARE * F.col("mid"))) & (F.sum("places").over(falling) < F.col("n_left"))
    rare = known.join(middle, "bench_id").withColumn("common", common).filter(~F.col("common"))
    per_item = rare.groupBy("bench_id", "n_places", "n_left").agg(F.count("*").alias("n_rare")).withColumn(
        "needed", F.greatest(F.lit(1), F.col("n_rare") - (F.col("n_places") - F.col("n_left"))))
    place = ["doc_id", "th", "start"]
    shared = (hits.join(rare.select("seed", "bench_id"), "seed").groupBy(*place, "bench_id").agg(F.count("*").alias("n"))
              .join(per_item.select("bench_id", "needed"), "bench_id").filter("n >= needed")
              .select(F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "th", "start").alias("place"),
                      "bench_id"))
    passages = found.dropDuplicates(place).select(
        F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "th", "start").alias("place"), *place, "passage")
    pairs = (passages.join(shared, "place").join(bench.select("bench_id", "item_id", "item_words"), "bench_id")
             .select(*place, "passage", "item_id", "item_words"))
    return (pairs.mapInArrow(_aligned, "doc_id long, th long, item_id long, start long, similarity double")
            .filter(F.col("similarity") >= similarity - 1e-9))


def op1_decontaminate(spark, sf_dir):
    """Documents that hold an item of ``benchmark``, with the best similarity of each item."""
    hits = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"),
                                                 F.count("*").alias("n_passages"))
