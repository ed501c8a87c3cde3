"""Vectorised passes over the bytes of many texts at once (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: An odd multiplier whose bits are well mixed.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Texts:
    """The UTF-8 bytes of a column of texts in one array; text i is ``data[off[i]:off[i + 1]]``. Null: empty."""

    def __init__(self, column: pa.Array, lower: bool = False):
        if lower:
            column = pa.array([(t or "").lower() for t in column.to_pylist()], pa.large_string())
        column = column.fill_null("").cast(pa.large_binary())
        off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        data = column.buffers()[2]
        self.data = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data else np.zeros(0, np.uint8)
        self.off = off - off[0]


def words(texts: Texts, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes, and the first word of every text (one more at the end)."""
    inside = is_word[texts.data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = texts.off[1:-1]
    cut = edge[(edge > 0) & (edge < len(inside))]   # a word never runs on into the next text
    starts[cut] |= inside[cut]
    ends[cut - 1] |= inside[cut - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, texts.off)


class Hasher:
    """64-bit hashes of byte runs: one prefix sum of weighted byte values, then a subtraction a run."""

    def __init__(self, seed: int, fold_case: bool = False):
        self.values = _byte_values(seed)
        if fold_case:
            self.values[65:91] = self.values[97:123]
        self.base = SPREAD
        self.inverse = np.uint64(pow(int(SPREAD), -1, 1 << 64))
        self.size = 0

    def _grow(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                up, down = np.full(self.size, self.base), np.full(self.size, self.inverse)
                up[0] = down[0] = 1
                self.up, self.down = np.cumprod(up), np.cumprod(down)

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:len(data)], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((sums[ends] - sums[starts]) * self.down[starts])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n neighbouring hashes (order counts); n - 1 fewer of them."""
    out = hashes[:len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = mixed(out * SPREAD + hashes[k:len(hashes) - n + 1 + k])
    return out


#: Bytes of words split at white space, and of words of ASCII letters, digits and non-ASCII characters.
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
PLAIN = np.zeros(256, bool)
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
