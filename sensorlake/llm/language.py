"""Language identification by error-correcting output codes over byte n-grams.

Every label gets a codeword; for each bit of the code a binary classifier (naive Bayes on
hashed byte 3-grams, its two classes the equally weighted labels whose bit is 1 and 0) says
how likely the text belongs to a label with that bit. Loss-weighted decoding adds, per
codeword, a logistic loss for each bit, weighted by how well that bit's classifier does on the
learned labels, and takes the codeword with the least loss. ``score`` is the share of the best
codeword in a softmax of the negative losses; a text whose two best codewords lie within
``AMBIGUOUS`` of each other is flagged.

Texts are lower-cased, everything but letters becomes a space. Counts are taken in Spark over
all learning rows; the model is #labels x ``BUCKETS`` counts (labels are a closed set), so its
size doesn't depend on the number of documents.

Defined cases: null text or a text without a letter: ``und``, score 0, not ambiguous; null
label: predicted, not learned from; no learning rows: every text is ``und``; one learned
label: every text with a letter gets it, score 1; repeated rows count as often as they stand;
codewords at the same distance: the label that comes first, flagged as ambiguous; texts of any length
are read whole, some megabytes of texts at a time; empty input: empty result. Only doc_id, text and lang are read, lang never for a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import steps, table
from sensorlake.llm.kernels import Texts

BUCKETS = 1 << 16
UNKNOWN = "und"
AMBIGUOUS = 0.02
_SHARPNESS = 12.0       # mean log-odds of a bit are multiplied by this before the loss
_SMOOTH = 0.5
_STEP = 1 << 20
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def _grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every 3-gram around a letter, text by text, and the texts' first 3-grams (one more at the end)."""
    texts = Texts(pa.array([f" {t.lower()} " if t else "  " for t in column.to_pylist()], pa.large_string()))
    data = _LETTERS[texts.data].astype(np.uint32)
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) if len(data) > 2 else data[:0]
    keep = np.flatnonzero(data[1:-1] != 32)     # the ends of every text are spaces: no 3-gram spans two texts
    bucket = (code[keep] * np.uint32(2654435761)) >> np.uint32(16)
    return bucket, np.searchsorted(keep, texts.off)


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in steps(batches, limit=_STEP):
        bucket, first = _grams(batch.column("text"))
        langs = np.array(batch.column("lang").to_pylist(), object)
        n = np.diff(first)
        for lang in set(langs):
            mine = np.repeat(langs == lang, n)
            total[lang] = total.get(lang, 0) + np.bincount(bucket[mine], minlength=BUCKETS)
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                          pa.array(counts[at])], ["lang", "bucket", "n"])


def codewords(k: int) -> np.ndarray:
    """k codewords of +1 and -1: all splits of up to six labels, else the best of some random codes."""
    if k <= 6:
        columns = [[1 if i == 0 or m >> (i - 1) & 1 == 0 else -1 for i in range(k)] for m in range(1, 1 << max(k - 1, 0))]
        return np.array(columns, np.float32).T.reshape(k, -1)
    rng, best, apart = np.random.default_rng(1), None, -1
    bits = 12 * int(np.ceil(np.log2(k)))
    for _ in range(50):
        code = np.where(rng.random((k, bits)) < 0.5, -1, 1).astype(np.float32)
        distance = (bits - code @ code.T) / 2
        np.fill_diagonal(distance, bits)
        if distance.min() > apart and (np.abs(code.sum(0)) < k).all():
            best, apart = code, distance.min()
    return best


def learn(rows: DataFrame) -> dict:
    """text, lang rows -> the model: labels, codewords, bit weights and per bucket log-odds of every bit."""
    counted = (rows.filter("text is not null and lang is not null").select("text", "lang")
               .mapInArrow(_counts, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    labels = sorted(counted["lang"].unique())
    counts = np.zeros((len(labels), BUCKETS))
    counts[np.searchsorted(labels, counted["lang"].to_numpy(str)) if labels else [], counted["bucket"]] = counted["n"]
    share = (counts + _SMOOTH) / (counts.sum(1, keepdims=True) + _SMOOTH * BUCKETS) if labels else counts
    code = codewords(len(labels)) if labels else np.zeros((0, 0), np.float32)
    odds = np.stack([np.log(share[code[:, b] > 0].mean(0)) - np.log(share[code[:, b] < 0].mean(0))
                     for b in range(code.shape[1])], 1) if code.size else np.zeros((BUCKETS, 0))
    # a bit counts by the expected margin of its classifier on the labels themselves
    margin = (code * (share @ odds)).mean(0) if code.size else np.zeros(0)
    weight = np.clip(margin, 0.05 * margin.max(), None) if margin.size and margin.max() > 0 else np.ones(code.shape[1])
    return {"labels": labels, "code": code, "odds": odds.astype(np.float32), "weight": weight / max(weight.sum(), 1e-9)}


def _decoded(model: dict, batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    labels, code = model["labels"], model["code"]
    known = np.array([_has_letter(t) for t in batch.column("text").to_pylist()], bool)
    n = batch.num_rows
    if not labels:
        return [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool)
    bucket, first = _grams(batch.column("text"))
    count = np.diff(first)
    margin = np.zeros((n, code.shape[1]))
    full = np.flatnonzero(count)
    if code.shape[1] and len(full):
        margin[full] = np.add.reduceat(model["odds"][bucket], first[full], axis=0, dtype=np.float64) / count[full, None]
    loss = (np.logaddexp(0, -_SHARPNESS * margin[:, None, :] * code[None]) * model["weight"]).sum(2)
    chance = np.exp(-_SHARPNESS * (loss - loss.min(1, keepdims=True)))
    chance /= chance.sum(1, keepdims=True)
    best = chance.argmax(1)
    top = np.sort(chance, 1)
    close = (top[:, -1] - top[:, -2] < AMBIGUOUS) if len(labels) > 1 else np.zeros(n, bool)
    return ([labels[b] if k else UNKNOWN for b, k in zip(best, known)],
            np.where(known, top[:, -1], 0.0), close & known)


def _predicted(model: dict, keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, limit=_STEP):
            lang, score, close = _decoded(model, batch)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(lang, pa.string()), pa.array(score), pa.array(close)],
                [*keys, "lang_pred", "score", "ambiguous"])
    return run


def predict(docs: DataFrame, model: dict, keys: dict[str, str]) -> DataFrame:
    """The ``keys`` columns (name -> type), lang_pred, score and ambiguous of every row."""
    schema = ", ".join(f"`{k}` {t}" for k, t in keys.items()) + ", lang_pred string, score double, ambiguous boolean"
    return docs.select(*[docs[f"`{k}`"] for k in dict.fromkeys([*keys, "text"])]).mapInArrow(_predicted(model, list(keys)), schema)


def held_out(part: int, of: int) -> Column:
    """Whether crc32 of doc_id as text leaves ``part`` (null doc_id: as if it were empty)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % of == part


def op6_language(spark, sf_dir):
    """Language of every document of ``documents``, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", held_out(2, 4).alias("held_out"), "text", "lang")
    return predict(rows, learn(rows.filter("not held_out")), {"doc_id": "long", "held_out": "boolean"})
