"""Language-model scores: an interpolated modified Kneser-Ney n-gram model.

Words are split at ASCII white space, A-Z lower-cased; every text ends with one end token, which
is counted like a word, and starts after ``order`` - 1 start marks, which are context only. Tokens and
n-grams are 64-bit hashes.

Counting, highest order first. Texts are packed into blocks (see ``packed``). A block sends its
distinct n-grams, sorted, with their counts in learning texts, to buckets of the hash space. A bucket's
merged n-grams are the model's first table: sorted hash arrays with counts, one row a bucket. It tells
every block the count of its n-grams, and one block of each that it owns it. Owners then add up, by
the n-grams of one word less, what the model needs of that order: after how many distinct words each stands
(its count there), how often it is a context, with how many distinct followers seen once, twice, more
often. Merged by bucket these are the next table, again sorted hash arrays, whose totals go back to the
blocks, and so on down to words, which have their plain counts, too. In the end the blocks score their
texts. Buckets look n-grams up in memory-mapped files of those arrays. Texts that aren't learned
from take part with counts of 0. ``score`` looks other texts up in stored tables the same way.

p(w) is interpolated with the uniform distribution over all words and an unknown one, every higher
order with the one below (where a context wasn't seen, the one below holds); the discounts of an order
come from its counts of counts over all learning texts. All text counts, none is cut; what a frequent
word or n-gram sends is one entry a block and order.

The registered order is 2: each order more exchanges and stores its own arrays, and with trigrams they go
beyond the disk that the budget allows (see the README for measured figures).

Defined cases: null text: empty (the end token alone); null doc_id: scored, and split as if its
text were empty; repeated rows: each is learned from and scored; nothing to learn from: every
score is 0; empty input: empty result. Only doc_id, text are read.
"""

from __future__ import annotations

import os
import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import n_parts, pinned, table
from sensorlake.llm.kernels import SPACED, SPREAD, Hasher, mixed, words
from sensorlake.llm.packed import (Block, answered, by_bucket, ddl, decoded, decoded_sorted, encoded,
                                   encoded_sorted, over_blocks, over_buckets, pack, slices)

END, START = np.uint64(1), np.uint64(2)
ORDER = 2
HELD_OUT = 10                   # one in so many documents, by crc32 of doc_id, is not learned from
STATS = 5                       # distinct words before, uses as a context, followers seen once, twice, more often
_CHUNK = 1 << 21

SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("grams", pa.binary()),
                  ("counts", pa.binary())])
#: Answers to blocks, and with block -1 the bucket's own table and its counts of counts.
MERGED = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("grams", pa.binary()),
                    ("counts", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64()), ("n1", pa.int64()),
                    ("n2", pa.int64()), ("n3", pa.int64()), ("n4", pa.int64()), ("more", pa.int64())])
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                    ("perplexity", pa.float64())])


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT == 0


class HashArrays:
    """Sorted hashes with columns of numbers in a memory-mapped file of the worker; removed at the end."""

    def __init__(self, hashes: np.ndarray, columns: np.ndarray):
        self.columns, self.n = len(columns), len(hashes)
        handle, self.path = tempfile.mkstemp()
        with os.fdopen(handle, "wb") as out:
            hashes.astype(np.uint64).tofile(out)
            np.ascontiguousarray(columns, np.int64).tofile(out)

    def __enter__(self) -> "HashArrays":
        whole = np.memmap(self.path, np.uint64, "r", shape=(1 + self.columns, self.n)) if self.n else \
            np.zeros((1 + self.columns, 0), np.uint64)
        self.hashes, self.values = whole[0], whole[1:].view(np.int64)
        return self

    def __exit__(self, *_) -> None:
        del self.hashes, self.values
        os.unlink(self.path)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The columns of the hashes that are there, zeros for the others."""
        if not self.n:
            return np.zeros((self.columns, len(wanted)), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, wanted), self.n - 1)
        return np.where(self.hashes[at] == wanted, self.values[:, at], 0)


class Grams:
    """The distinct n-grams of one order in a block, in sending order: hashes, and of each its context and its end, which are
    n-grams of one word less (0 for words)."""

    def __init__(self, hashes: np.ndarray, place: np.ndarray, before: np.ndarray, after: np.ndarray, start: int):
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.hashes, self.place = hashes[order], rank[place]        # place: of every token, the n-gram that it ends
        self.before, self.after = before[order], after[order]
        self.start = rank[start] if start >= 0 else -1              # the n-gram of start marks alone


class Tokens:
    """The tokens of a block and their n-grams: ``grams[k]`` of k words each, up to ``order``."""

    def __init__(self, block: Block, n_buckets: int, order: int = ORDER):
        hasher = Hasher(60, fold_case=True)
        starts, ends, first = words(block, SPACED)
        hashed = np.empty(len(starts), np.uint64)
        lo = 0
        while lo < len(starts):         # a few megabytes of words at a time
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _CHUNK)))
            a, b = int(starts[lo]), int(ends[hi - 1])
            hashed[lo:hi] = hasher.runs(hasher.sums(block.data[a:b]), starts[lo:hi] - a, ends[lo:hi] - a)
            lo = hi
        n = len(first) - 1
        self.first = first + np.arange(n + 1)                       # first token of every text
        token = np.full(len(hashed) + n, END)
        last = np.zeros(len(token), bool)
        last[self.first[1:] - 1] = True
        token[~last] = hashed
        self.ids = block.ids.to_pylist()
        self.held = np.fromiter(map(held_out, self.ids), bool, n)
        self.learned = np.repeat(~self.held, np.diff(self.first))
        self.n_buckets, self.order = n_buckets, order
        distinct, place = np.unique(np.append(token, START), return_inverse=True)
        nothing = np.zeros(len(distinct), np.int64)
        word = Grams(distinct, place[:-1], nothing, nothing, int(place[-1]))
        self.grams = {1: word}
        for k in range(2, order + 1):
            low = self.grams[k - 1]
            context = np.append(low.start, low.place[:-1])
            context[self.first[:-1]] = low.start
            pairs = context << 32 | word.place
            if k < order:               # start marks alone are a context of the order above
                pairs = np.append(pairs, low.start << 32 | word.start)
            pair, place = np.unique(pairs, return_inverse=True)
            before, end = pair >> 32, pair & 0xFFFFFFFF
            after = end                             # the same n-gram without its first word
            if k > 2:
                after = np.empty(len(pair), np.int64)
                after[place] = np.append(low.place, low.start)[:len(place)]
            self.grams[k] = Grams(mixed(low.hashes[before] * SPREAD + word.hashes[end]), place[:len(context)], before, after,
                                  int(place[-1]) if k < order else -1)

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        """Buckets are ranges of the hashes, so the steps between a bucket's are small."""
        return ((hashes >> np.uint64(32)) * np.uint64(self.n_buckets) >> np.uint64(32)).astype(np.int64)

    def learned_counts(self, grams: Grams) -> np.ndarray:
        return np.bincount(grams.place[self.learned], minlength=len(grams.hashes)).astype(np.int64)

    def replies(self, k: int, batch: pa.RecordBatch, row: int) -> np.ndarray:
        """What the buckets told of the n-grams of k words."""
        return self.answers(self.grams[k].hashes, batch.column(f"grams_{k}")[row].as_py(), columns(k, self.order))

    def answers(self, hashes: np.ndarray, rows: list[dict] | None, columns: int) -> np.ndarray:
        out = np.zeros((columns, len(hashes)), np.int64)
        have = {r["bucket"]: r for r in rows or ()}
        for b, lo, hi in slices(self.bucket(hashes)):
            out[:, lo:hi] = decoded(have[b]["counts"], columns * (hi - lo), np.int64).reshape(columns, -1)
        return out

    def sent(self, block: int, hashes: np.ndarray, columns: np.ndarray) -> list[dict]:
        return [{"bucket": b, "block": block, "n": hi - lo, "grams": encoded_sorted(hashes[lo:hi]),
                 "counts": encoded(np.ascontiguousarray(columns[:, lo:hi]).reshape(-1))}
                for b, lo, hi in slices(self.bucket(hashes))]


def columns(k: int, order: int) -> int:
    """Numbers that an n-gram of k words has: its count, or what the order above tells of it (words: their plain count, too)."""
    return 1 if k == order else STATS + (k == 1)


def _send_grams(n_buckets: int, order: int):
    def run(block: Block, batch, row) -> list[dict]:
        own = Tokens(block, n_buckets, order)
        top = own.grams[order]
        return own.sent(block.number, top.hashes, own.learned_counts(top)[None])
    return over_blocks(run, SENT)


def _summed(rows: list[dict], columns: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes and columns as sent by each block; the distinct hashes and the summed columns."""
    hashes = [decoded_sorted(r["grams"], r["n"]) for r in rows]
    sent = [decoded(r["counts"], columns * r["n"], np.int64).reshape(columns, -1) for r in rows]
    distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
    together = np.concatenate(sent, axis=1)
    total = np.stack([np.bincount(place, c, len(distinct)) for c in together]).astype(np.int64)
    return hashes, sent, distinct, total


def _table(bucket: int, distinct: np.ndarray, total: np.ndarray, of: np.ndarray, tokens: int) -> dict:
    times = np.bincount(np.minimum(of, 5), minlength=6)
    return {"block": -1, "bucket": bucket, "n": len(distinct), "grams": encoded_sorted(distinct),
            "counts": encoded(total.reshape(-1)), "tokens": tokens, "types": int((of > 0).sum()),
            "n1": int(times[1]), "n2": int(times[2]), "n3": int(times[3]), "n4": int(times[4]), "more": int(of.sum())}


def _merge_grams(k: int, order: int):
    """Totals of all n-grams of k words; in a block's answer the count is doubled, plus one if the block owns the n-gram."""
    wide, count = columns(k, order), 1 if k == 1 < order else 0     # which column is the count that the model takes

    def run(bucket: int, rows: list[dict]) -> list[dict]:
        hashes, sent, distinct, total = _summed(rows, wide)
        seen = total.any(axis=0)
        distinct, total = distinct[seen], total[:, seen]
        out = [_table(bucket, distinct, total, total[count], int(total[0].sum()) if k == 1 else 0)]
        free = total[count] > 0
        with HashArrays(distinct, total) as model:
            for r, mine, part in zip(rows, hashes, sent):
                found = model.find(mine)
                if k > 1:
                    at = np.minimum(np.searchsorted(distinct, mine), max(len(distinct) - 1, 0))
                    owns = (part[0] > 0) & free[at] if len(distinct) else np.zeros(len(mine), bool)
                    free[at[owns]] = False
                    found[0] = found[0] * 2 + owns
                out.append({"block": r["block"], "bucket": bucket, "n": len(mine), "counts": encoded(found.reshape(-1))})
        return out
    return run


def _send_lower(n_buckets: int, order: int, k: int):
    """What the owners of the n-grams of k words tell of those of one word less."""
    def run(block: Block, batch, row) -> list[dict]:
        own = Tokens(block, n_buckets, order)
        high, low = own.grams[k], own.grams[k - 1]
        told = own.replies(k, batch, row)[0]
        mine = np.flatnonzero(told & 1)
        count, n = told[mine] >> 1, len(low.hashes)
        times = lambda some: np.bincount(high.before[mine[some]], minlength=n)
        stats = [np.bincount(high.after[mine], minlength=n), np.bincount(high.before[mine], count, n),
                 times(count == 1), times(count == 2), times(count > 2)]
        plain = [own.learned_counts(low)] if k == 2 else []
        return own.sent(block.number, low.hashes, np.stack([*plain, *stats]).astype(np.int64))
    return over_blocks(run, SENT)


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """By count: 0, 1, 2, 3 or more; where a count of counts is zero, 0.5 a count."""
    if not (n1 and n2 and n3):
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0, [0, 1, 2, 3])


def _score(n_buckets: int, facts: dict):
    order = facts["order"]

    def run(block: Block, batch, row) -> list[dict]:
        own = Tokens(block, n_buckets, order)
        told = {k: own.replies(k, batch, row).astype(np.float64) for k in range(1, order + 1)}
        for k in range(2, order + 1):
            told[k][0] //= 2            # without the mark of the owner
        size, word = facts["words"] + 1, own.grams[1]
        cut = {k: facts["cuts"][k - 1] for k in range(1, order + 1)}
        count, preceding = (told[1][0], told[1][1]) if order > 1 else (told[1][0], told[1][0])
        if facts["types"]:
            held_back = cut[1][1:] @ facts["lower_times"] / facts["types"]
            chance = np.maximum(preceding - cut[1][np.minimum(preceding, 3).astype(int)], 0) / facts["types"] + held_back / size
        else:
            chance = np.full(len(word.hashes), 1 / size)
        for k in range(2, order + 1):
            grams, of = own.grams[k], told[k][0]
            uses, once, twice, often = told[k - 1][-4:]
            spare = cut[k][1] * once + cut[k][2] * twice + cut[k][3] * often
            known = uses[grams.before] > 0
            chance = np.where(known, (np.maximum(of - cut[k][np.minimum(of, 3).astype(int)], 0) + spare[grams.before] * chance[grams.after])
                              / np.where(known, uses[grams.before], 1), chance[grams.after])
        base = np.log10((count + 0.1) / (facts["tokens"] + 0.1 * size))
        begin = own.first[:-1]
        by_text = lambda x: np.add.reduceat(x, begin) if len(begin) else x[:0]
        n = np.diff(own.first)
        score, base_score = by_text(np.log10(chance)[own.grams[order].place]), by_text(base[word.place])
        n_known = by_text((count > 0).astype(np.int64)[word.place])
        return [{"doc_id": i, "held_out": bool(h), "n_tokens": int(a), "n_known": int(b), "train_tokens": facts["tokens"],
                 "base_score": float(c), "score": float(d), "perplexity": float(10 ** min(-d / a, 300))}
                for i, h, a, b, c, d in zip(own.ids, own.held, n, n_known, base_score, score)]
    return over_blocks(run, SCORES)


_REPLY = ["block", "bucket", "counts"]
_MODEL = ["bucket", "n", "grams", "counts", "tokens", "types", "n1", "n2", "n3", "n4", "more"]


def _facts(tables: list[DataFrame]) -> dict:
    """The model's totals, from the rows of its tables (highest order first): one row of sums an order."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "types", "n1", "n2", "n3", "n4", "more")]
    by_order = [t.agg(*sums).first() for t in reversed(tables)]
    one = by_order[0]
    # words follow as many distinct words as there are distinct bigrams; a model of words alone has their counts
    types = one.more
    return {"order": len(tables), "tokens": one.tokens, "words": one.types, "types": types,
            "cuts": [discounts(r.n1, r.n2, r.n3, r.n4) for r in by_order],
            "lower_times": np.array([one.n1, one.n2, one.types - one.n1 - one.n2], float)}


def kneser_ney(docs: DataFrame, order: int = ORDER) -> tuple[DataFrame, ...]:
    """Scores of all rows (SCORES), and the model: its tables, highest order first, a row of sorted hash arrays a
    bucket (bucket, n, grams, counts, the row's totals and the number of buckets). To be used elsewhere, tables are written as Parquet."""
    if order < 1:
        raise ValueError("an order of 1 at least")
    buckets = n_parts(docs.sparkSession)
    blocks = pack(docs)
    sent, merged, replies = blocks.mapInArrow(_send_grams(buckets, order), ddl(SENT)), [], {}
    for k in range(order, 0, -1):
        found = pinned(by_bucket(sent).mapInArrow(over_buckets(_merge_grams(k, order), MERGED), ddl(MERGED)))
        merged.append(found.filter("block < 0").select(*_MODEL, F.lit(buckets).alias("buckets")))
        replies[f"grams_{k}"] = found.filter("block >= 0").select(*_REPLY)
        if k > 1:
            sent = answered(blocks, **{f"grams_{k}": replies[f"grams_{k}"]}).mapInArrow(_send_lower(buckets, order, k), ddl(SENT))
    scores = answered(blocks, **replies).mapInArrow(_score(buckets, _facts(merged)), ddl(SCORES))
    return scores, *merged


def _ask(n_buckets: int, order: int, k: int):
    """The n-grams of k words of a block, without counts."""
    def run(block: Block, batch, row) -> list[dict]:
        own = Tokens(block, n_buckets, order)
        hashes = own.grams[k].hashes
        return own.sent(block.number, hashes, np.zeros((1, len(hashes)), np.int64))
    return over_blocks(run, SENT)


def _look_up(k: int, order: int):
    """A bucket's part of the model (block -1) is written to a file and mapped; blocks get their n-grams' numbers from it."""
    wide = columns(k, order)

    def run(bucket: int, rows: list[dict]) -> list[dict]:
        model = [r for r in rows if r["block"] < 0]
        hashes = decoded_sorted(model[0]["grams"], model[0]["n"]) if model else np.zeros(0, np.uint64)
        total = decoded(model[0]["counts"], wide * model[0]["n"], np.int64).reshape(wide, -1) if model else np.zeros((wide, 0), np.int64)
        with HashArrays(hashes, total) as mapped:
            del hashes, total           # what is looked up is read from the file
            out = []
            for r in rows:
                if r["block"] >= 0:
                    found = mapped.find(decoded_sorted(r["grams"], r["n"]))
                    found[0] *= 2 if k > 1 else 1
                    out.append({"block": r["block"], "bucket": bucket, "n": r["n"], "counts": encoded(found.reshape(-1))})
        return out
    return run


def score(docs: DataFrame, *tables: DataFrame) -> DataFrame:
    """Scores of texts by a model that ``kneser_ney`` has counted from others (its tables, highest order first).

    The number of buckets is the model's; every bucket is read by one task, mapped, and asked by all blocks.
    """
    order, buckets = len(tables), tables[0].agg(F.max("buckets")).first()[0] or 1
    blocks, replies = pack(docs), {}
    for k, stored in zip(range(order, 0, -1), tables):
        asked = blocks.mapInArrow(_ask(buckets, order, k), ddl(SENT))
        both = asked.unionByName(stored.select("bucket", F.lit(-1).cast("long").alias("block"), "n", "grams", "counts"))
        replies[f"grams_{k}"] = by_bucket(both).mapInArrow(over_buckets(_look_up(k, order), MERGED), ddl(MERGED)).select(*_REPLY)
    return answered(blocks, **replies).mapInArrow(_score(buckets, _facts(list(tables))), ddl(SCORES))


def op8_kneser_ney(spark, sf_dir):
    """Score of every document of ``documents``."""
    return kneser_ney(table(spark, sf_dir, "documents"))[0]
