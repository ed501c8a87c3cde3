"""Quality rules: an isolation forest on the rules' statistics, with a threshold from labelled rows.

1. One pass over the texts gives every document its statistics (``STATISTICS``): words, characters
   by kind, repeated lines, and words in repeated windows of three. Words and lines are compared as
   they are (Arrow dictionaries), not by hashes. The rows are narrow and written once.
2. Documents that break a base rule (under ``MIN_WORDS`` words, or more than half of the words in
   repeated windows) fail. The others are judged by the forest.
3. ``TREES`` isolation trees are grown on the driver, each on ``TREE_ROWS`` of at most ``POOL_ROWS``
   labelled documents, the least by a hash of the id: a bounded sample, whatever the corpus.
   A tree splits a random feature at a random value between its extremes, so what lies apart is
   alone after few splits. The score is 2 ** -(mean path length / expected path length).
4. The threshold comes from all the labelled documents that the sample's half of the hashes leaves
   out: the least score (in steps of 1 / ``STEPS``) that no more than ``MAX_LOSS`` of those with
   quality 1 reach. Counted by step in Spark, so the driver gets ``STEPS`` rows at most.

A feature is a share or a mean, so documents of any length compare; ``features`` lists them.

Defined cases: null and empty texts have no words and fail; whole texts of any length; repeated rows
are judged alike, each on its own; a null id has no label; a document with several labels counts as
good only if none is 0; null quality is no label; without good and bad labelled documents, or without
a sample, nothing is rejected but by the base rules; an empty table gives no row. Of the documents
only doc_id and text are read, of the labels doc_id and quality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sensorlake.llm.common import pinned, steps, table
from sensorlake.llm.kernels import SPACED, Texts, words

MIN_WORDS = 50
POOL_ROWS = 8192
TREES, TREE_ROWS = 300, 32  # small trees: the more rows a tree has, the more of the bad ones lie together
STEPS = 4096
MAX_LOSS = 0.005

#: Statistics of a document, all whole numbers.
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words",
              "n_upper", "n_letters", "n_digits", "n_marks", "n_marked_words", "n_ends")


def _mask(text: str) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(text.encode())] = True
    return mask


_SYMBOL = _mask("#*$%&|<>")
_UPPER = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _mask("0123456789")
_ASCII_LETTER = _UPPER | _mask("abcdefghijklmnopqrstuvwxyz")
_FIRST = np.ones(256, bool)         # bytes that begin a code point
_FIRST[128:192] = False
_LETTER = _ASCII_LETTER | _FIRST & (np.arange(256) >= 128)
_MARK = np.zeros(256, bool)         # ASCII signs
_MARK[33:127] = True
_MARK &= ~_ASCII_LETTER & ~_DIGIT
_END = _mask(".!?")


# ----------------------------------------------------------------------------- statistics

def _sums(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Set entries of every run off[i]:off[i + 1]."""
    total = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[off]).astype(np.int64)


def _codes(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for every run of bytes, equal for equal runs, and how many there are."""
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    runs = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    coded = runs.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))


def _joined(parts: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """One number a row for several, equal where all are equal; packed in bits while a long has room."""
    key, wide = parts[0]
    for more, size in parts[1:]:
        if (wide - 1).bit_length() + (size - 1).bit_length() > 62:
            distinct, key = np.unique(key, return_inverse=True)
            wide = max(1, len(distinct))
        key, wide = key * size + more, wide * size
    return key


def _often(key: np.ndarray) -> np.ndarray:
    """Whether a row's number occurs more than once."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def _step_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    texts = Texts(column)
    data, off, docs = texts.data, texts.off, len(texts.off) - 1
    starts, ends, first = words(texts, SPACED)
    in_word = SPACED[data]
    n_words = np.diff(first)
    doc = np.repeat(np.arange(docs), n_words)
    code, kinds = _codes(data[in_word], ends - starts)

    covered = np.zeros(len(doc), bool)
    if len(doc) > 2:
        at = np.flatnonzero(doc[2:] == doc[:-2])
        found = at[_often(_joined([(doc[at], docs), *[(code[at + k], kinds) for k in range(3)]]))]
        for k in range(3):
            covered[found + k] = True
    distinct = np.unique(_joined([(doc, docs), (code, kinds)]), return_index=True)[1]

    breaks = np.flatnonzero(data == 10)
    edge = np.sort(np.concatenate([off[:-1], breaks + 1]))          # where lines begin; a document without text has one
    line_doc = np.sort(np.concatenate([np.arange(docs), np.searchsorted(off, breaks, side="right") - 1]))
    stop = np.r_[edge[1:], len(data)]
    size = stop - edge - np.r_[line_doc[1:] == line_doc[:-1], False]  # without the line feed that ends it
    worded = _sums(in_word, np.r_[edge, len(data)]) > 0
    line, line_kinds = _codes(data[data != 10], size)
    line, line_doc = line[worded], line_doc[worded]
    lines = np.bincount(line_doc, minlength=docs)
    once = np.unique(_joined([(line_doc, docs), (line, line_kinds)]), return_index=True)[1]

    marks = np.zeros(len(data) + 1, np.int32)
    np.cumsum(_MARK[data], out=marks[1:])
    by_word = lambda flag: np.bincount(doc[flag], minlength=docs)
    return {
        "n_words": n_words, "word_chars": _sums(in_word & _FIRST[data], off), "n_symbols": _sums(_SYMBOL[data], off),
        "n_dup_lines": lines - np.bincount(line_doc[once], minlength=docs), "n_repeat_words": by_word(covered),
        "n_lines": lines, "n_distinct_words": np.bincount(doc[distinct], minlength=docs),
        "n_upper": _sums(_UPPER[data], off), "n_letters": _sums(_LETTER[data], off), "n_digits": _sums(_DIGIT[data], off),
        "n_marks": _sums(_MARK[data], off), "n_marked_words": by_word(marks[ends] > marks[starts]),
        "n_ends": by_word(_END[data[ends - 1]]) if len(doc) else np.zeros(docs, np.int64),
    }


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        found = _step_statistics(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(found[s], pa.int64()) for s in STATISTICS]],
                                         ["doc_id", *STATISTICS])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row of (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(_statistics, "doc_id long, " + ", ".join(f"{s} long" for s in STATISTICS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# ----------------------------------------------------------------------------- forest

def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Shares and means of a document's statistics, a row each. Shares of what most documents hardly have
    are taken over a little more than the text, so that one such thing in a short text is no anomaly."""
    s = {k: np.asarray(v, np.float64) for k, v in stats.items()}
    n, letters = np.maximum(s["n_words"], 1), s["n_letters"]
    return np.column_stack([
        s["word_chars"] / n,
        s["n_symbols"] / (n + 50),
        s["n_dup_lines"] / (s["n_lines"] + 5),
        s["n_repeat_words"] / (n + 50),
        s["n_upper"] / (letters + 250),
        s["n_digits"] / (letters + 250),
        s["n_marks"] / (n + 20),
        s["n_marked_words"] / (n + 20),
        s["n_ends"] / (n + 20),
        np.log(n / np.maximum(s["n_distinct_words"], 1)) / np.log(n + 1),
    ])


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length to a row in a random tree over ``n`` rows."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), (n == 2) * 1.0)


class Forest:
    """Isolation trees as flat arrays: node -> feature (-1: a leaf), split value, first child, path length at a leaf."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 0):
        draw = np.random.default_rng(seed)
        size = min(tree_rows, len(rows))
        limit = int(np.ceil(np.log2(max(size, 2))))
        self.expected = max(float(expected_path(np.array([size]))[0]), 1.0)
        feature, split, child, length, self.roots = [], [], [], [], []
        for _ in range(trees if size else 0):
            todo = [(self._node(feature, split, child, length), rows[draw.permutation(len(rows))[:size]], 0)]
            self.roots.append(todo[0][0])
            while todo:
                node, part, depth = todo.pop()
                low, high = part.min(0), part.max(0)
                open_ = np.flatnonzero(high > low)
                if depth >= limit or not len(open_):
                    length[node] = depth + float(expected_path(np.array([len(part)]))[0])
                    continue
                f = int(draw.choice(open_))
                at = float(draw.uniform(low[f], high[f]))
                right = part[:, f] > at
                feature[node], split[node] = f, at
                child[node] = self._node(feature, split, child, length)
                self._node(feature, split, child, length)
                todo += [(child[node], part[~right], depth + 1), (child[node] + 1, part[right], depth + 1)]
        self.feature, self.child = np.array(feature, np.int32), np.array(child, np.int32)
        self.split, self.length, self.depth = np.array(split), np.array(length), limit

    @staticmethod
    def _node(*arrays: list) -> int:
        for a, empty in zip(arrays, (-1, 0.0, 0, 0.0)):
            a.append(empty)
        return len(arrays[0]) - 1

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / expected path length): near 1 for rows that lie apart."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                f = self.feature[node]
                node = np.where(f < 0, node, self.child[node] + (rows[every, f] > self.split[node]))
            total += self.length[node]
        return 2.0 ** -(total / max(len(self.roots), 1) / self.expected)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = features({s: batch.column(s).to_numpy() for s in STATISTICS})
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.scores(found))], [*batch.schema.names, "score"])
    return run


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with the forest's score; the forest is broadcast (``TREES`` trees of at most twice ``TREE_ROWS`` nodes)."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)
    return stats.mapInArrow(_scored(shared), StructType([*stats.schema.fields, StructField("score", DoubleType())]))


# ----------------------------------------------------------------------------- labels and threshold

def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that pass the base rules and have a label, with ``good`` and ``_half``, the half of the hashes they are in."""
    good = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    return (stats.filter(~base_failed()).join(good.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id")).drop("_id")
            .withColumn("_half", F.pmod(F.xxhash64(F.col("doc_id")), F.lit(2))))


def grow(known: DataFrame) -> Forest | None:
    """The forest of a bounded sample of the labelled documents: the ``POOL_ROWS`` least by a hash of the id."""
    sample = known.filter("_half = 0").select(*STATISTICS, F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 31)).alias("_h"))
    share = min(1.0, 2 * POOL_ROWS / max(sample.count(), 1))      # so tasks return few rows, whatever their number
    rows = sample.filter(F.col("_h") < int(share * (1 << 31))).orderBy("_h", *STATISTICS).limit(POOL_ROWS).collect()
    return Forest(features({s: np.array([r[s] for r in rows]) for s in STATISTICS})) if rows else None


def threshold(known: DataFrame, max_loss: float = MAX_LOSS) -> float:
    """The least score, in steps, that at most ``max_loss`` of the good documents outside the sample reach."""
    at = F.floor(F.col("score") * STEPS).cast("int")
    counts = known.filter("_half = 1").groupBy(at.alias("at")).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).collect()
    good, bad = np.zeros(STEPS + 2, np.int64), 0
    for r in counts:
        good[r["at"]] += r["good"]
        bad += r["bad"]
    if not bad or not good.sum():
        return float("inf")
    reached = np.cumsum(good[::-1])[::-1]
    return float(np.flatnonzero(reached <= max_loss * good.sum())[0]) / STEPS


def judged(docs: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """doc_id, the statistics, base_failed, score (0 without a forest) and kept for every row of ``docs``."""
    stats = pinned(statistics(docs))
    known = pinned(labelled(stats, labels))
    forest = grow(known)
    if forest is None:
        return stats.withColumn("score", F.lit(0.0)).withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed())
    cut = threshold(scored(known, forest), max_loss)
    return scored(stats, forest).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") < F.lit(cut)))


def op13_rules(spark, sf_dir: str) -> DataFrame:
    out = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
