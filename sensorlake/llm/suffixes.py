"""Suffix-array dedup: bytes covered by a 50-byte string of an earlier document are removed.

Which suffixes are sorted. Every 50-byte window of a text is assigned to the 20-byte gram in it
with the least hash. Equal windows have the same gram, so only windows of the same gram need
comparing; neighbouring windows mostly share their gram, and a run of them (at most ``SPAN``) is
one suffix: it starts where the run does and ends with the run's last window (80 bytes at most).
So the array is sparse, about one suffix every 16 bytes, yet covers every window. The runs are found
once, when texts are packed, and kept with the block (two bytes a run, compressed).

1. Blocks of texts send the sorted hashes of their grams to buckets of the hash space, which
   answer for each whether it occurs again anywhere (one bit in effect). Suffixes of grams that
   occur once in the corpus have no equal window and need no sorting; that is exact.
2. The other suffixes, ordered by (gram hash, bytes), leave every block as sorted runs, one a
   bucket (the leading bytes of the order are the hash, so buckets are ranges of it), front-coded:
   common prefix with the one before, length, the bytes that are new. Equal suffixes of a block
   are one entry, with the smallest doc_id.
3. A bucket merges its runs: hashes as numbers, and what shares a hash with loser trees that carry
   common prefix lengths: two heads with different lengths are ordered by them alone, those with
   equal lengths are compared from there on, and a run's next head brings its length from the
   front coding. Trees of many hashes play their matches together. So a suffix is compared
   with those of its gram, however many runs the bucket has. The merged order comes with its
   common prefixes: at full length the suffix is the same, at 8 bytes or more the gram.
4. Where a gram has one suffix only, its smallest doc_id holds for all its windows; where it has
   several, the windows of the distinct ones are hashed and each gets the smallest doc_id of its
   own. What is smaller than the block's own smallest goes back to the block, which removes the
   bytes and hashes the rest.

A gram with over ``HOT`` occurrences (a line that every document has, with other text around it)
would make a large group of distinct suffixes: its windows are sent one by one, each its own
sort key, so they spread over all buckets.

Defined cases: null text: empty; null doc_id: kept whole, and nothing is removed for it;
repeated rows with one doc_id: not smaller than each other, so both keep or lose the same bytes;
texts under 50 bytes: kept; empty input: empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import n_parts, pinned, table
from sensorlake.llm.kernels import Hasher
from sensorlake.llm.packed import (BLOCKS, Block, answered, blocks_of, by_bucket, ddl, decoded, decoded_sorted, encoded,
                                   encoded_sorted, over_blocks, over_buckets, pack_batches, slices)

WINDOW, GRAM = 50, 20
SPAN = WINDOW - GRAM + 1        # grams of a window, and windows of a suffix at most
KEY = 8                         # bytes of the gram's hash before a suffix
HOT = 4096
_STEP = 1 << 16                 # windows that are hashed at once: their arrays stay in the cache
_TREES = 1 << 16                # heads of all trees that are merged together
_STEP_COST = 4                  # of a step of them, for each level, in strings that are merged alone
_PRINT = np.uint64((1 << 40) - 1)
_NEVER = np.iinfo(np.int64).max


@lru_cache
def _hasher(seed: int) -> Hasher:
    """One a worker: its powers are kept for the next block."""
    return Hasher(seed)


def window_runs(block: Block, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every run of windows with one gram: first window, number of windows, place of the gram in the first."""
    parts = []
    n = len(block.data) - WINDOW + 1
    for lo in range(0, max(n, 0), _STEP):
        hi = min(lo + _STEP, n)
        data = block.data[lo:hi + WINDOW - 1]
        sums = hasher.sums(data)
        at = np.arange(len(data) - GRAM + 1)
        grams = hasher.runs(sums, at, at + GRAM)
        least, width = grams, 1
        while width < SPAN:
            shift = min(width, SPAN - width)
            least = np.minimum(least[:-shift], least[shift:])
            width += shift
        text = np.repeat(np.arange(len(block.off) - 1), np.diff(np.clip(block.off, lo, hi)))
        whole = np.arange(lo, hi) + WINDOW <= block.off[text + 1]
        new = np.ones(hi - lo, bool)
        new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, hi - lo))
        if (size > SPAN).any():
            pieces = -(-size // SPAN)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first, rest = np.repeat(first, pieces) + nth * SPAN, np.repeat(size, pieces) - nth * SPAN
            size = np.minimum(rest, SPAN)
        keep = whole[first]
        first, size = first[keep], size[keep]
        # a run that leaves its text's last window ends there
        size = np.minimum(size, block.off[text[first] + 1] - WINDOW + 1 - lo - first)
        lead = (grams[first[:, None] + np.arange(SPAN)] == least[first][:, None]).argmax(1)
        parts.append((first + lo, size, lead))
    none = np.zeros(0, np.int64)
    return tuple(map(np.concatenate, zip(*parts))) if parts else (none, none, none)


#: A block with the runs of its texts: gaps between them, sizes, places of the grams.
WITH_RUNS = BLOCKS + ", n_runs int, gap binary, size binary, lead binary"


def _pack_with_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = _hasher(50)
    for block, batch, row in blocks_of(pack_batches(batches)):
        first, size, lead = window_runs(block, hasher)
        gap = first - np.concatenate([[0], (first + size)[:-1]]) if len(first) else first
        yield pa.RecordBatch.from_arrays(
            [*batch.slice(row, 1).columns, pa.array([len(first)], pa.int32()), pa.array([encoded(gap)], pa.binary()),
             *[pa.array([pa.compress(x.astype(np.uint8).tobytes(), "zstd", asbytes=True)], pa.binary()) for x in (size, lead)]],
            [*batch.schema.names, "n_runs", "gap", "size", "lead"])


class Suffixes:
    """The runs of a block's texts that have a doc_id, and its distinct grams in sending order."""

    def __init__(self, block: Block, n_buckets: int, batch: pa.RecordBatch, row: int):
        self.block, self.hasher, self.n_buckets = block, _hasher(50), n_buckets
        self.padded = np.append(block.data, np.zeros(SPAN + WINDOW, np.uint8))
        known = block.ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = block.ids.fill_null(0).to_numpy()
        n = batch.column("n_runs")[row].as_py()
        size, lead = (np.frombuffer(pa.decompress(batch.column(c)[row].as_buffer(), n, "zstd") if n else b"", np.uint8).astype(np.int64)
                      for c in ("size", "lead"))
        first = np.cumsum(decoded(batch.column("gap")[row].as_py(), n, np.int64) + np.concatenate([[0], size[:-1]])) if n else size
        text = np.searchsorted(block.off, first, side="right") - 1
        keep = known[text] if n else np.zeros(0, bool)
        self.text, self.first, self.size = text[keep], first[keep], size[keep]
        self.gram = self._hashes(first[keep] + lead[keep], self.first, GRAM)
        self.sent, self.place, self.count = np.unique(self.order(self.gram), return_inverse=True, return_counts=True)

    def _hashes(self, at: np.ndarray, rising: np.ndarray, width: int) -> np.ndarray:
        """Hashes of the bytes at some places, which rise as ``rising`` does but for a window's length."""
        out, lo = np.zeros(len(at), np.uint64), 0
        while lo < len(at):
            begin = max(int(at[lo]) - SPAN, 0)
            hi = int(np.searchsorted(rising, at[lo] + _STEP))
            hi = min(max(hi, lo + 1), len(at))
            some = at[lo:hi]
            sums = self.hasher.sums(self.block.data[begin:int(some.max()) + width])
            out[lo:hi] = self.hasher.runs(sums, some - begin, some - begin + width)
            lo = hi
        return out

    def order(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(40)) % np.uint64(self.n_buckets) << np.uint64(40) | hashes & _PRINT

    def by_bucket(self, values: np.ndarray) -> Iterator[tuple[int, int, int]]:
        return slices((values >> np.uint64(40)).astype(np.int64))

    def entries(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct suffixes to be sorted, in sending order: key, place, bytes; of every occurrence its entry, text and first window."""
        code = codes[self.place] if len(codes) else np.zeros(0, np.uint8)
        plain, hot = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
        text, first, size, gram = (x[plain] for x in (self.text, self.first, self.size, self.gram))
        if len(hot):
            of, at = _ranges(self.first[hot], self.size[hot])
            sums = self._hashes(at, at, WINDOW)
            text, first = np.append(text, self.text[hot][of]), np.append(first, at)
            size, gram = np.append(size, np.ones(len(at), size.dtype)), np.append(gram, sums)
        key, length = self.order(gram), size + WINDOW - 1
        by, new = sorted_suffixes(key, self.padded, first, length)
        entry = np.empty(len(by), np.int64)
        entry[by] = np.cumsum(new) - 1
        some = by[new]
        return key[some], first[some], length[some], entry, text, first

    def chars(self, key: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Key and bytes of suffixes, a row each; what follows a suffix in its row is not defined."""
        out = np.empty((len(key), KEY + int(length.max())), np.uint8)
        out[:, :KEY] = key.astype(">u8").view(np.uint8).reshape(-1, KEY)
        out[:, KEY:] = np.lib.stride_tricks.sliding_window_view(self.padded, out.shape[1] - KEY)[first]
        return out


def sorted_suffixes(key: np.ndarray, data: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by (key, bytes, length), and of every place in it whether it differs from the one before.

    Suffixes of one key are told apart by eight bytes at a time; only groups that differ there are
    sorted anew. ``data`` goes on for eight bytes after the last suffix.
    """
    by = np.argsort(key, kind="stable")
    new = np.ones(len(by), bool)
    new[1:] = key[by[1:]] != key[by[:-1]]
    words = np.ndarray(len(data) - 7, ">u8", data, 0, (1,))
    tied, done, more = np.arange(len(by)), 0, True
    while more:
        group = np.cumsum(new[tied]) - 1
        tied = tied[np.bincount(group, minlength=1)[group] > 1]
        group = np.cumsum(new[tied]) - 1
        size = length[by[tied]]
        more = bool((size > done).any())
        if more:
            beyond = np.clip(done + 8 - size, 0, 7).astype(np.uint64) << np.uint64(3)
            word = words[np.minimum(first[by[tied]] + done, len(words) - 1)].astype(np.uint64) >> beyond << beyond
            word[size <= done] = 0
        else:                                       # the bytes agree, up to zeros at an end
            word = size.astype(np.uint64)
        differs = (word[1:] != word[:-1]) & (group[1:] == group[:-1])
        mixed = np.zeros(len(tied) + 1, bool)
        mixed[group[1:][differs]] = True
        again = np.flatnonzero(mixed[group])
        order = again[np.lexsort((word[again], group[again]))]
        by[tied[again]], word[again] = by[tied[order]], word[order]
        new[tied[1:]] |= (word[1:] != word[:-1]) & (group[1:] == group[:-1])
        done += 8
    return by, new


def _codes(block: Suffixes, rows: list[dict] | None) -> np.ndarray:
    out = np.zeros(len(block.sent), np.uint8)
    have = {r["bucket"]: r["codes"] for r in rows or ()}
    for bucket, lo, hi in block.by_bucket(block.sent):
        if bucket in have:
            out[lo:hi] = np.frombuffer(pa.decompress(have[bucket], hi - lo, "zstd"), np.uint8)
    return out


GRAMS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("grams", pa.binary()),
                   ("counts", pa.binary())])
CODES = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("codes", pa.binary())])
RUNS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("prefix", pa.binary()),
                  ("length", pa.binary()), ("tail", pa.binary()), ("tail_bytes", pa.int64()), ("least", pa.binary())])
FINDS = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("entry", pa.binary()),
                   ("windows", pa.binary()), ("least", pa.binary())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                    ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _send_grams(n_buckets: int):
    def run(block: Block, batch, row) -> list[dict]:
        own = Suffixes(block, n_buckets, batch, row)
        return [{"bucket": b, "block": block.number, "n": hi - lo, "grams": encoded_sorted(own.sent[lo:hi] & _PRINT),
                 "counts": encoded(own.count[lo:hi].astype(np.int64))} for b, lo, hi in own.by_bucket(own.sent)]
    return over_blocks(run, GRAMS)


def _which_repeat(bucket: int, rows: list[dict]) -> list[dict]:
    """0: the gram occurs once in the corpus, 1: again, 2: over HOT times."""
    grams = np.concatenate([decoded_sorted(r["grams"], r["n"]) for r in rows])
    _, place = np.unique(grams, return_inverse=True)
    total = np.bincount(place, np.concatenate([decoded(r["counts"], r["n"], np.int64) for r in rows]))
    code = np.where(total <= 1, 0, np.where(total <= HOT, 1, 2)).astype(np.uint8)[place]
    ends = np.cumsum([r["n"] for r in rows])
    return [{"block": r["block"], "bucket": bucket, "codes": pa.compress(code[e - r["n"]:e].tobytes(), "zstd", asbytes=True)}
            for r, e in zip(rows, ends) if code[e - r["n"]:e].any()]


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Sorted strings of up to 255 bytes -> common prefix with the one before, length, and the bytes after the prefix."""
    length = np.fromiter(map(len, strings), np.int64, len(strings))
    width = int(length.max())
    return front_coded_rows(np.array(strings, f"S{width}").view(np.uint8).reshape(-1, width), length)


def front_coded_rows(chars: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """The same of strings that are the first ``length`` bytes of rows."""
    differ = chars[1:] != chars[:-1]
    same = np.where(differ.any(1), differ.argmax(1), chars.shape[1])
    prefix = np.concatenate([[0], np.minimum(same, np.minimum(length[1:], length[:-1]))])
    column = np.arange(chars.shape[1], dtype=np.uint8)
    return prefix, length, chars[(column >= prefix.astype(np.uint8)[:, None]) & (column < length.astype(np.uint8)[:, None])].tobytes()


def front_decoded(prefix: list[int], length: list[int], tail: bytes) -> list[bytes]:
    out = front_decoded_rows(np.array(prefix, np.int64), np.array(length, np.int64), tail, max(length, default=0))
    return [row[:n].tobytes() for row, n in zip(out, length)]


def front_decoded_rows(prefix: np.ndarray, length: np.ndarray, tail: bytes, width: int) -> np.ndarray:
    """Strings as rows of ``width`` bytes, zeros after them; a prefix of 0 begins a run."""
    column = np.arange(width, dtype=np.uint8)
    out = np.zeros((len(prefix), width), np.uint8)
    new, end = np.frombuffer(tail, np.uint8), np.cumsum(length - prefix)
    for lo in range(0, len(out), _STEP):
        some = slice(lo, lo + _STEP)
        sent = column >= prefix[some].astype(np.uint8)[:, None]
        sent &= column < length[some].astype(np.uint8)[:, None]
        out[some][sent] = new[end[lo] - length[lo] + prefix[lo]:end[some][-1]]
    for some, lo, hi in ((prefix > 0, 0, KEY), (prefix > KEY, KEY, width)):
        some[:-1] |= some[1:]                           # and the strings before
        some = np.flatnonzero(some)
        known, nth = prefix[some], np.arange(len(some))
        for c in range(lo, min(int(known.max(initial=0)), hi)):     # a byte of the prefix is that of the last string that sent it
            out[some, c] = out[some[np.maximum.accumulate(np.where(known <= c, nth, 0))], c]
    return out


def _send_runs(n_buckets: int):
    def run(block: Block, batch, row) -> list[dict]:
        own = Suffixes(block, n_buckets, batch, row)
        key, first, size, entry, text, _ = own.entries(_codes(own, batch.column("codes")[row].as_py()))
        if not len(key):
            return []
        least = np.full(len(key), _NEVER)
        np.minimum.at(least, entry, own.ids[text])
        out = []
        for b, lo, hi in own.by_bucket(key):
            prefix, length, tail = front_coded_rows(own.chars(key[lo:hi], first[lo:hi], size[lo:hi]), size[lo:hi] + KEY)
            out.append({"bucket": b, "block": block.number, "n": hi - lo,
                        "prefix": pa.compress(prefix.astype(np.uint8).tobytes(), "zstd", asbytes=True),
                        "length": pa.compress(length.astype(np.uint8).tobytes(), "zstd", asbytes=True),
                        "tail": pa.compress(tail, "zstd", asbytes=True), "tail_bytes": len(tail),
                        "least": encoded(least[lo:hi])})
        return out
    return over_blocks(run, RUNS)


def _first_difference(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings whose first ``known`` bytes agree."""
    n = min(len(a), len(b))
    near = min(known + 8, n)                    # mostly it is right there
    x = int.from_bytes(a[known:near], "big") ^ int.from_bytes(b[known:near], "big")
    if x or near == n:
        return near - (x.bit_length() + 7 >> 3)
    x = int.from_bytes(a[near:n], "big") ^ int.from_bytes(b[near:n], "big")
    return n - (x.bit_length() + 7 >> 3)


def merged(runs: list[list[bytes]], prefixes: list[list[int]]) -> Iterator[tuple[int, int, int]]:
    """Loser tree over sorted runs and their common prefixes: (run, number in it, common prefix with the last one out).

    ``known[r]`` is the common prefix of run r's head with the last winner that it met; the head
    that shares more with that winner is the smaller one, so heads are only compared, from the
    known prefix on, when the two lengths are equal.
    """
    k = len(runs)
    heads: list[bytes | None] = [r[0] if r else None for r in runs]
    known, at = [0] * k, [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = known[a], known[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        n = _first_difference(x, y, p)
        if x[n:n + 1] <= y[n:n + 1]:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    losers = [0] * k
    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if k > 1 else 0
    for r in range(k):
        if heads[r] is None:
            known[r] = -1           # shares nothing with any winner: it never is the smaller one
    while heads[top] is not None:
        yield top, at[top], known[top]
        i = at[top] + 1
        at[top] = i
        if i < len(runs[top]):
            heads[top], known[top] = head, p = runs[top][i], prefixes[top][i]
        else:
            heads[top], known[top] = head, p = None, -1
        node = (top + k) >> 1
        while node:                 # play(top, losers[node]), without a call where the prefixes decide
            rival = losers[node]
            q = known[rival]
            if q > p:
                losers[node], top, p = top, rival, q
                head = heads[top]
            elif q == p >= 0:
                other = heads[rival]
                n = _first_difference(head, other, p)
                if head[n:n + 1] <= other[n:n + 1]:
                    known[rival] = n
                else:
                    known[top] = n
                    losers[node], top, head = top, rival, other
            node >>= 1


def _common(words: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefixes of strings a and b whose first ``known`` bytes agree, and whether a is not after b."""
    at = known >> 3
    x, y = words[a, at], words[b, at]
    same = np.flatnonzero(x == y)
    while len(same):                                # mostly the first word decides
        at[same] += 1
        same = same[at[same] < words.shape[1]]
        x[same], y[same] = words[a[same], at[same]], words[b[same], at[same]]
        same = same[x[same] == y[same]]
    m, n = length[a], length[b]
    differ = x ^ y
    differ &= ~(differ >> np.uint64(1))             # its highest bit stays the highest when it is rounded
    bits = np.frexp(differ.astype(np.float64))[1]
    return np.minimum((at << 3) + (64 - bits >> 3), np.minimum(m, n)), (x < y) | (x == y) & (m <= n)


def merged_groups(words: np.ndarray, length: np.ndarray, prefix: np.ndarray, lo: np.ndarray,
                  hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``merged`` for many groups at once: strings in order, group by group, and their common prefixes with the last one out.

    Strings are rows of big-endian words, zeros after their end. Run r of group g is the strings
    from ``lo[g, r]`` to ``hi[g, r]``; every group has a loser tree of its own, and all trees
    put out a string, and play their matches of one level, together.
    """
    n = (hi - lo).sum(1)
    start = np.cumsum(n) - n
    out, common = np.empty(n.sum(), np.int64), np.empty(n.sum(), np.int64)
    by = np.argsort(-n, kind="stable")              # trees that still hold strings stay the first ones
    n, start = n[by], start[by]
    depth = max(lo.shape[1] - 1, 0).bit_length()
    k = 1 << depth
    at, end = np.zeros((2, len(by), k), np.int64)
    at[:, :lo.shape[1]], end[:, :lo.shape[1]] = lo[by], hi[by]
    base = np.arange(len(by)) * k
    known = np.where(at < end, 0, -1).ravel()
    at, end = at.ravel(), end.ravel()
    after = np.append(prefix, 0)

    def play(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p, q = known[a], known[b]
        wins = p > q
        even = np.flatnonzero((p == q) & (p >= 0))
        if len(even):
            x, y = a[even], b[even]
            c, wins[even] = _common(words, length, at[x], at[y], p[even])
            known[np.where(wins[even], y, x)] = c
        return np.where(wins, a, b), np.where(wins, b, a)

    losers = np.empty(len(by) * k, np.int64)
    top = (base[:, None] + np.arange(k)).ravel()    # of a tree's node at this level
    level = k
    while level > 1:
        level >>= 1
        top, lost = play(top[::2], top[1::2])
        losers[(base[:, None] + level + np.arange(level)).ravel()] = lost
    for step in range(int(n.max(initial=0))):
        m = int(np.searchsorted(-n, -step))         # trees with more than ``step`` strings
        top = top[:m]
        now = at[top]
        out[start[:m] + step], common[start[:m] + step] = now, known[top]
        now += 1
        at[top], known[top] = now, np.where(now < end[top], after[now], -1)
        node, tree = (top & k - 1) + k, base[:m]
        for _ in range(depth):
            node >>= 1
            top, losers[tree + node] = play(top, losers[tree + node])
    return out, common


def merged_runs(words: np.ndarray, length: np.ndarray, prefix: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of sorted runs, one run after another, in order, and their common prefixes with the one before.

    The first words are merged as numbers; strings that share them, from several runs, are a
    group, with a loser tree. Groups with about as many runs are merged together, but for the few
    longest, whose trees would outlast the others.
    """
    by = np.argsort(words[:, 0], kind="stable")     # merges the runs as they are
    out, common = by.copy(), prefix[by]
    new = np.ones(len(by), bool)
    new[1:] = words[by[1:], 0] != words[by[:-1], 0]
    cut = new.copy()
    cut[1:] |= run[by[1:]] != run[by[:-1]]
    first, part = np.flatnonzero(new), np.flatnonzero(cut)
    size, part_size = np.diff(np.append(first, len(by))), np.diff(np.append(part, len(by)))
    part_of = (np.cumsum(new) - 1)[part]
    runs = np.bincount(part_of)
    part_0 = np.cumsum(runs) - runs
    depth = np.frexp((runs - 1).astype(np.float64))[1]
    for d in np.unique(depth[runs > 1]).tolist():
        groups = np.flatnonzero(depth == d)
        groups = groups[np.argsort(-size[groups], kind="stable")]
        steps = _STEP_COST * d * size[groups]
        few = int(np.argmin(np.append(steps, 0) + np.append(0, np.cumsum(size[groups]))))
        for s in groups[:few].tolist():
            at = slice(part_0[s], part_0[s] + runs[s])
            lo, hi = by[part[at]], by[part[at]] + part_size[at]
            strings = [[w.tobytes()[:m] for w, m in zip(words[a:b].astype(">u8"), length[a:b].tolist())] for a, b in zip(lo, hi)]
            found = np.fromiter(merged(strings, [prefix[a:b].tolist() for a, b in zip(lo, hi)]), np.dtype((np.int64, 3)))
            at = slice(first[s], first[s] + size[s])
            out[at], common[at] = lo[found[:, 0]] + found[:, 1], found[:, 2]
        for i in range(few, len(groups), max(1, _TREES >> d)):
            some = groups[i:i + max(1, _TREES >> d)]
            lo = np.zeros((len(some), 1 << d), np.int64)
            hi = lo.copy()
            slot, nth = _ranges(np.zeros(len(some), np.int64), runs[some])
            mine = part_0[some][slot] + nth
            lo[slot, nth] = by[part[mine]]
            hi[slot, nth] = by[part[mine]] + part_size[mine]
            slot, nth = _ranges(first[some], size[some])
            out[nth], common[nth] = merged_groups(words, length, prefix, lo, hi)
    common[:1] = 0
    common[first[1:]] = _common(words, length, out[first[1:] - 1], out[first[1:]], np.zeros(len(first) - 1, np.int64))[0]
    return out, common


def _ranges(start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from every start on, ``n`` of them, one range after another: number of the range, number."""
    of = np.repeat(np.arange(len(n)), n)
    return of, np.arange(len(of)) - (np.cumsum(n) - n - start)[of]


def _merge_bucket(bucket: int, rows: list[dict]) -> list[dict]:
    prefix, length = (np.frombuffer(b"".join(pa.decompress(r[c], r["n"], "zstd", asbytes=True) for r in rows), np.uint8).astype(np.int64)
                      for c in ("prefix", "length"))
    count = np.array([r["n"] for r in rows])
    start = np.cumsum(count) - count
    width = (int(length.max()) >> 3) + 1 << 3       # at least a zero after every string
    chars = front_decoded_rows(prefix, length, b"".join(
        pa.decompress(r["tail"], r["tail_bytes"], "zstd", asbytes=True) if r["tail_bytes"] else b"" for r in rows), width)
    words = chars.view(">u8").astype(np.uint64)
    run_of = np.repeat(np.arange(len(rows)), count)
    slot, common = merged_runs(words, length, prefix, run_of)
    del words
    own = np.concatenate([decoded(r["least"], r["n"], np.int64) for r in rows])[slot]
    length = length[slot]
    new = np.ones(len(slot), bool)
    new[1:] = (common[1:] < length[1:]) | (length[1:] != length[:-1])
    gram = np.ones(len(slot), bool)
    gram[1:] = common[1:] < KEY
    head = np.flatnonzero(new)                      # first of every distinct suffix
    suffix = np.cumsum(new) - 1
    least = np.minimum.reduceat(own, head)
    group = np.cumsum(gram)[head] - 1
    several = np.bincount(group)[group] > 1
    # (suffix, first window, windows, smallest doc_id): all windows at once, or one by one
    plain = np.flatnonzero(~several)
    spans = [(plain, np.zeros(len(plain), np.int64), length[head[plain]] - KEY - WINDOW + 1, least[plain])]
    mixed = np.flatnonzero(several)
    begin = 0
    while begin < len(mixed):                       # whole grams, a megabyte at a time
        end = min(len(mixed), begin + 10_000)
        while end < len(mixed) and group[mixed[end]] == group[mixed[end - 1]]:
            end += 1
        some = mixed[begin:end]
        spans.append(_by_window(chars[slot[head[some]]], length[head[some]], some, group[some], least[some]))
        begin = end
    of, first, n, doc = map(np.concatenate, zip(*spans))
    by = np.argsort(of, kind="stable")
    of, first, n, doc = of[by], first[by], n[by], doc[by]
    lo, hi = np.searchsorted(of, suffix), np.searchsorted(of, suffix, side="right")
    entry = np.repeat(np.arange(len(slot)), hi - lo)
    at = np.arange(len(entry)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[entry]
    useful = doc[at] < own[entry]
    entry, at = entry[useful], at[useful]
    run = run_of[slot[entry]]
    number = slot[entry] - start[run]
    by = np.lexsort((first[at], number, run))
    run, number, at = run[by], number[by], at[by]
    return [{"block": rows[r]["block"], "bucket": bucket, "n": b - a, "entry": encoded_sorted(number[a:b].astype(np.uint64)),
             "windows": encoded(first[at[a:b]] << 8 | n[at[a:b]]), "least": encoded(doc[at[a:b]])}
            for r, a, b in slices(run)]


def _by_window(chars: np.ndarray, size: np.ndarray, number: np.ndarray, group: np.ndarray, least: np.ndarray):
    """Distinct suffixes, as rows -> runs of windows with their smallest doc_id, over all suffixes of a gram."""
    data = chars.ravel()
    start, n = np.arange(len(chars)) * chars.shape[1] + KEY, size - KEY - WINDOW + 1
    of = np.repeat(np.arange(len(chars)), n)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    hasher = _hasher(51)
    at = start[of] + nth
    window = hasher.runs(hasher.sums(data), at, at + WINDOW)
    by = np.argsort(window, kind="stable")      # by gram within a hash
    w, g = window[by], group[of][by]
    new = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (g[1:] != g[:-1])]))
    smallest = np.empty(len(of), np.int64)
    smallest[by] = np.repeat(np.minimum.reduceat(least[of][by], new), np.diff(np.append(new, len(of))))
    cut = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (smallest[1:] != smallest[:-1])]))
    return number[of[cut]], nth[cut], np.diff(np.append(cut, len(of))), smallest[cut]


def _remove(n_buckets: int, with_kept: bool):
    def run(block: Block, batch, row) -> list[dict]:
        own = Suffixes(block, n_buckets, batch, row)
        keys, _, size, entry, text, first = own.entries(_codes(own, batch.column("codes")[row].as_py()))
        edge = np.zeros(len(block.data) + 1, np.int32)
        if len(keys):
            doc = own.ids[text]
            least = np.full(len(keys), _NEVER)
            np.minimum.at(least, entry, doc)
            windows = size - WINDOW + 1
            base = {b: lo for b, lo, _ in own.by_bucket(keys)}
            # what holds for all windows of an entry in this block, then what the buckets know better
            of, at, n, known = [np.arange(len(keys))], [np.zeros(len(keys), np.int64)], [windows], [least]
            for r in batch.column("finds")[row].as_py() or ():
                of.append(decoded_sorted(r["entry"], r["n"]).astype(np.int64) + base[r["bucket"]])
                span = decoded(r["windows"], r["n"], np.int64)
                at.append(span >> 8)
                n.append(span & 255)
                known.append(decoded(r["least"], r["n"], np.int64))
            of, at, n, known = map(np.concatenate, (of, at, n, known))
            by = np.argsort(of, kind="stable")
            of, at, n, known = of[by], at[by], n[by], known[by]
            lo, hi = np.searchsorted(of, entry), np.searchsorted(of, entry, side="right")
            found = np.repeat(np.arange(len(entry)), hi - lo)
            which = np.arange(len(found)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[found]
            earlier = known[which] < doc[found]
            found, which = found[earlier], which[earlier]
            begin = first[found] + at[which]
            np.add.at(edge, begin, 1)
            np.add.at(edge, begin + n[which] + WINDOW - 1, -1)
        gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
        out = []
        for i, key in enumerate(block.ids.to_pylist()):
            a, b = int(block.off[i]), int(block.off[i + 1])
            mine = gone[a:b]
            removed = int(mine.sum())
            kept = block.data[a:b][~mine].tobytes() if removed else block.bytes[a:b]
            spans = int(mine[:1].sum() + (mine[1:] & ~mine[:-1]).sum()) if removed else 0
            out.append({"doc_id": key, "n_bytes": b - a, "n_removed": removed, "n_spans": spans,
                        "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept if with_kept else None})
        return out
    return over_blocks(run, RESULT)


def dedup(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes, or null)."""
    buckets = n_parts(docs.sparkSession)
    blocks = pinned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pack_with_runs, WITH_RUNS))
    repeat = over_buckets(_which_repeat, CODES)
    codes = pinned(by_bucket(blocks.mapInArrow(_send_grams(buckets), ddl(GRAMS))).mapInArrow(repeat, ddl(CODES)))
    runs = answered(blocks, codes=codes).mapInArrow(_send_runs(buckets), ddl(RUNS))
    finds = by_bucket(runs).mapInArrow(over_buckets(_merge_bucket, FINDS), ddl(FINDS))
    return answered(blocks, codes=codes, finds=finds).mapInArrow(_remove(buckets, with_kept), ddl(RESULT))


def op2_suffixes(spark, sf_dir):
    """What is left of every document of ``documents``."""
    return dedup(table(spark, sf_dir, "documents")).drop("kept")
