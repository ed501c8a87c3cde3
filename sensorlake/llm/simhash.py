"""SimHash near-duplicates by anchor-point covering.

Fingerprints: texts are lower-cased (A-Z), split into words, and their 3-word shingles
(repeats included) hashed with XXH64, seed 42; a bit is 1 if it is set in over half of the
hashes. Fewer words than a shingle: the whole sequence; no word or null text: zero.

Links: two fingerprints link at ``MAX_BITS`` or fewer differing bits. The anchors are the
codewords of a covering code: bits 0-22 and 23-45 of a fingerprint are each covered by the
perfect binary Golay code (every 23-bit word lies within 3 bits of exactly one codeword),
so there are 2^24 anchors with covering radius 3 + 3 on those 46 bits; the other 18 bits
don't matter to an anchor. A fingerprint x goes to every anchor that covers some word within
two flips of x, marked *near* if one flip does. If x and y differ in at most three bits,
some word z lies within one flip of the one and two of the other; the anchor that covers z
gets both, one of them near. So comparing, at each anchor, the near ones with all finds
every link: about 70 rows a fingerprint, among 2^24 anchors, with no assumption on the data.

Only distinct fingerprints are replicated (a group of equal ones is one row), and a task
reports a spanning forest of the links it finds rather than the pairs. An anchor that holds
more near fingerprints than ``HOT`` and than a ten-thousandth of all is split: its near ones
are dealt into chunks, the others copied to each. There are at most 10,000 such anchors, so
the list of them is bounded.

Defined cases: null doc_id: fingerprinted and linked, but never the name of a component
unless the whole component has none (then null); repeated rows and ties: one fingerprint;
empty input: empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import pinned, steps, table
from sensorlake.llm.graph import components, spanning

SHINGLE = 3             # words
MAX_BITS = 3            # the anchors are laid out for this distance; smaller ones work too
HOT = 4096              # near fingerprints of an anchor that one task compares
_SEED = 42
_BLOCK = 1 << 16        # shingles whose bits are counted at once
_PAIRS = 1 << 21        # pairs compared at once

# The binary Golay code (length 23, dimension 12).
GOLAY_LENGTH, GOLAY_CHECKS, GOLAY_POLYNOMIAL = 23, 11, 0b110001110101


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text (0 if it has no word)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends)]
    last = ends[shingle - 1:] or ends[-1:]
    counts, n, digest = np.zeros(64, np.int64), len(last), xxhash.xxh64_digest
    for lo in range(0, n, _BLOCK):
        hashed = b"".join([digest(joined[s:e], _SEED) for s, e in zip(starts[lo:lo + _BLOCK], last[lo:lo + _BLOCK])])
        counts += np.unpackbits(np.frombuffer(hashed, np.uint8)).reshape(-1, 64).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _fingerprints(keys: list[str], shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(found.view(np.int64))],
                                             [*keys, "fp"])
    return run


def with_fingerprints(docs: DataFrame, keys: dict[str, str], shingle: int = SHINGLE) -> DataFrame:
    """The ``keys`` columns (name -> type) and ``fp`` (long) of every row; reads ``text`` besides."""
    schema = ", ".join(f"{k} {t}" for k, t in keys.items()) + ", fp long"
    return docs.select(*keys, "text").mapInArrow(_fingerprints(list(keys), shingle), schema)


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders by the code's polynomial."""
    left = words.astype(np.int64)
    for bit in range(GOLAY_LENGTH - 1, GOLAY_CHECKS - 1, -1):
        left = np.where(left >> bit & 1, left ^ (GOLAY_POLYNOMIAL << (bit - GOLAY_CHECKS)), left)
    return left


def anchor_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every syndrome: the anchors reached with up to two flips, as differences to the
    word's own upper bits, and the fewest flips that reach each (9: no entry); and the
    syndrome of every value of the upper 12 bits."""
    ones = 1 << np.arange(GOLAY_LENGTH)
    pairs = np.array([a | b for i, a in enumerate(ones) for b in ones[:i]])
    triples = np.array([a | b for i, a in enumerate(ones) for j, b in enumerate(ones[:i]) for b in (b | ones[:j])])
    flips = np.concatenate([[0], ones, pairs])
    cost = np.concatenate([[0], np.ones(len(ones), int), np.full(len(pairs), 2)])
    within_three = np.concatenate([flips, triples])
    leader = np.zeros(1 << GOLAY_CHECKS, np.int64)
    leader[_syndrome(within_three)] = within_three
    of_flips = _syndrome(flips)
    rows = []
    for s in range(1 << GOLAY_CHECKS):
        reached = (flips ^ leader[s ^ of_flips]) >> GOLAY_CHECKS
        best: dict[int, int] = {}
        for anchor, c in zip(reached.tolist(), cost.tolist()):  # by rising cost
            best.setdefault(anchor, c)
        rows.append(best)
    width = max(map(len, rows))
    steps_to, costs = np.zeros((len(rows), width), np.int32), np.full((len(rows), width), 9, np.int8)
    for s, best in enumerate(rows):
        steps_to[s, :len(best)], costs[s, :len(best)] = list(best), list(best.values())
    upper = _syndrome(np.arange(1 << (GOLAY_LENGTH - GOLAY_CHECKS)) << GOLAY_CHECKS)
    return steps_to, costs, upper


def _to_anchors(layout, chunks_of: dict[int, int], homes_only: bool):
    steps_to, costs, upper = layout

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = np.array(sorted(chunks_of), np.int32)
        pieces = np.array([chunks_of[k] for k in sorted(chunks_of)], np.int32)
        for batch in batches:
            whole = batch.column("fp").to_numpy().astype(np.int64)
            for fp in np.array_split(whole, len(whole) // 8192 + 1):
                sides = []
                for shift in (0, GOLAY_LENGTH):
                    word = fp >> shift & ((1 << GOLAY_LENGTH) - 1)
                    s = upper[word >> GOLAY_CHECKS] ^ (word & ((1 << GOLAY_CHECKS) - 1))
                    sides.append(((word >> GOLAY_CHECKS)[:, None] ^ steps_to[s], costs[s]))
                (low, low_cost), (high, high_cost) = sides
                cost = low_cost[:, :, None] + high_cost[:, None, :]
                i, a, b = np.nonzero(cost <= (0 if homes_only else 2))
                anchor = (high[i, b] << 12 | low[i, a]).astype(np.int32)
                near, one, piece = cost[i, a, b] <= 1, fp[i], np.zeros(len(i), np.int32)
                if len(split):
                    at = np.minimum(np.searchsorted(split, anchor), len(split) - 1)
                    parts = np.where(split[at] == anchor, pieces[at], 1)
                    again = np.repeat(np.arange(len(i)), parts)
                    piece = (np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)).astype(np.int32)
                    anchor, one, parts = anchor[again], one[again], parts[again]
                    near = near[again] & ((one & 0x7FFFFFFF) * 2654435761 % (1 << 31) % parts == piece)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(piece), pa.array(one), pa.array(near)],
                                                 ["anchor", "piece", "fp", "near"])
    return run


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Rows sorted by ``keys`` -> columns that hold whole groups, with ``group`` (0, 1, ...) added."""
    left: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        left = rows if left is None else pa.concat_tables([left, rows])
        changed = _changes(left, keys)
        if changed.any():
            last = int(np.flatnonzero(changed)[-1]) + 1
            yield _columns(left.slice(0, last), changed[:last - 1])
            left = left.slice(last)
    if left is not None and left.num_rows:
        yield _columns(left, _changes(left, keys))


def _changes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    out = np.zeros(max(rows.num_rows - 1, 0), bool)
    for k in keys:
        c = rows.column(k).to_numpy()
        out |= c[1:] != c[:-1]
    return out


def _columns(rows: pa.Table, changed: np.ndarray) -> dict[str, np.ndarray]:
    out = {name: rows.column(name).to_numpy(zero_copy_only=False) for name in rows.column_names}
    return out | {"group": np.concatenate([[0], np.cumsum(changed)])}


def pairs_by_group(group: np.ndarray, left: np.ndarray, limit: int = _PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i, j), i of ``left`` and j any row of its group, in steps of about ``limit`` pairs."""
    size = np.bincount(group)
    start = np.cumsum(size) - size
    mine = size[group[left]]
    done = np.cumsum(mine)
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + limit, side="right")))
        n = mine[lo:hi]
        i = np.repeat(left[lo:hi], n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[group[left[lo:hi]]], n)
        yield i, j
        lo = hi


def _links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["anchor", "piece"]):
            fp, kept = rows["fp"], []
            for i, j in pairs_by_group(rows["group"], np.flatnonzero(rows["near"])):
                x, y = fp[i], fp[j]
                ok = (np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits) & (x != y)
                if ok.any():
                    kept.append(spanning(x[ok], y[ok]))
            if kept:
                u, v = spanning(*map(np.concatenate, zip(*kept)))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
    return run


def link_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct fingerprints (fp) -> (node, root) for every one that links to a smaller one."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the anchors are laid out for at most {MAX_BITS} bits")
    layout = anchor_table()
    schema = "anchor int, piece int, fp long, near boolean"
    homes = prints.mapInArrow(_to_anchors(layout, {}, True), schema).groupBy("anchor").agg(F.count("*").alias("n"))
    total = homes.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT, total // 10_000)
    split = {r.anchor: -(-r.n // limit) for r in homes.filter(F.col("n") > limit).collect()}  # 10,000 at most
    placed = prints.mapInArrow(_to_anchors(layout, split, False), schema)
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(n, "anchor", "piece").sortWithinPartitions("anchor", "piece")
    return components(dealt.mapInArrow(_links(max_bits), "u long, v long"))


def near_duplicates(docs: DataFrame, keys: dict[str, str] | None = None, shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: the key columns (doc_id among them), fp, group (a fingerprint of the component) and component_id."""
    rows = pinned(with_fingerprints(docs, keys or {"doc_id": "long"}, shingle))
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("_first"))
    rooted = prints.join(link_components(prints.select("fp"), max_bits), prints.fp == F.col("node"), "left").select(
        "fp", "_first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    return rows.join(rooted.join(named, "root").select("fp", F.col("root").alias("group"), "component_id"), "fp")


def op3_simhash(spark, sf_dir):
    """Fingerprint and component of every document of ``documents``."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
