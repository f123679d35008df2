"""Vectorised word splitting and hashing on the UTF-8 bytes of an Arrow batch.

Every separator the contracts name is ASCII, so words are found on bytes: a
256-entry class table marks word bytes, another maps each byte to a random
64-bit value (upper-case A-Z share the value of a-z).  A wrapping prefix sum
``H[i] = sum value[b[j]] * BASE**j`` gives any span's hash as
``(H[end] - H[start]) * BASE**-start``, so a whole batch is hashed without a
Python loop.  All hashes are 64 bit; two different words share one with
probability about 2**-64 per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INV = pow(_BASE, -1, 1 << 64)


def _splitmix(n: int, seed: int) -> np.ndarray:
    x = (np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15)) + U(seed)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = _lower_table()
VALUE = _splitmix(256, 77)[LOWER]
#: Raw byte values, case kept.
VALUE_CASED = _splitmix(256, 77)

#: ``[^\x20\x09-\x0D]+``
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True

_pow_cache: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _pow_cache.get("p")
    if have is None or len(have) < n:
        m = 1 << max(16, (n - 1).bit_length())
        p = np.full(m, U(_BASE))
        p[0] = 1
        q = np.full(m, U(_INV))
        q[0] = 1
        _pow_cache["p"], _pow_cache["q"] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _pow_cache["p"], _pow_cache["q"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, int64 offsets of each row's start and the end); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind, column = np.int64, column
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, kind, n + 1 + column.offset)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def word_spans(raw: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row plus the total) for the words of each row."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    w = is_word[raw]
    begin = w.copy()
    begin[1:] &= ~w[:-1]
    cut = off[(off > 0) & (off < n)]
    begin[cut] = w[cut]
    last = w.copy()
    last[:-1] &= ~w[1:]
    last[cut - 1] = w[cut - 1]
    s = np.flatnonzero(begin)
    e = np.flatnonzero(last) + 1
    return s, e, np.searchsorted(s, off)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, value: np.ndarray = VALUE) -> np.ndarray:
    """One mixed 64-bit hash per span."""
    n = len(raw)
    if n == 0 or len(starts) == 0:
        return np.zeros(len(starts), U)
    p, q = _powers(n + 1)
    h = np.zeros(n + 1, U)
    np.cumsum(value[raw] * p[:n], out=h[1:])
    return mix((h[ends] - h[starts]) * q[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


#: Text that is worked on at once; a power of two less one, so that the table of powers has 16 MB.
SLICE = (1 << 20) - 1


def slices(column: pa.Array, most_bytes: int = SLICE, most_rows: int = 1 << 20):
    """(first row, end row) of pieces of about most_bytes of text; one row at least."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw, off = text_bytes(column)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most_bytes, "right")) - 1)
        j = min(j, n, i + most_rows)
        yield i, j
        i = j


def shingle_hashes(word_hash: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every k-word shingle; a row with 1 to k-1 words has its whole sequence as one."""
    n_rows = len(first) - 1
    count = np.diff(first)
    n = len(word_hash)
    if n == 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    out = np.zeros(n, U)
    for i in range(k):
        part = np.zeros(n, U)
        part[: n - i] = mix(word_hash[i:] + U((i + 1) * 0xA24BAED4963EE407 & _MASK)) if i < n else 0
        out = out * U(0x9FB21C651E98DF25) + part
    row = np.repeat(np.arange(n_rows), count)
    at = np.arange(n) - first[row]
    keep = at <= count[row] - k
    short = np.flatnonzero((count > 0) & (count < k))
    hashes, rows = mix(out[keep]), row[keep]
    if len(short):
        extra = np.array([_whole(word_hash[first[r] : first[r + 1]]) for r in short], U)
        hashes, rows = np.concatenate([hashes, extra]), np.concatenate([rows, short])
    return hashes, rows


def _whole(words: np.ndarray) -> int:
    x = 0x5851F42D4C957F2D + len(words)
    for w in words.tolist():
        x = (x * 0x9FB21C651E98DF25 + w) & _MASK
    return int(mix(np.array([x], U))[0])


def distinct_per_row(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (hash, row) by row, with the counts of each row."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        h, r = h[new], r[new]
    return h, r, np.bincount(r, minlength=n_rows) if n_rows else np.zeros(0, np.int64)


class HashIndex:
    """Places of known 64-bit keys, found by linear probing in numpy."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self.mask = U((1 << bits) - 1)
        self.key = np.zeros(1 << bits, U)
        self.place = np.full(1 << bits, -1, np.int32)
        left, step = np.arange(len(keys)), 0
        while len(left):
            slot = ((keys[left] + U(step)) & self.mask).astype(np.int64)
            free = self.place[slot] < 0
            _, one = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[one]
            self.key[slot[won]], self.place[slot[won]] = keys[left[won]], left[won]
            left, step = np.delete(left, won), step + 1
        self.steps = step

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash among the keys, -1 where unknown."""
        slot = (h & self.mask).astype(np.int64)
        out = np.where(self.key[slot] == h, self.place[slot], -1)
        open_ = np.flatnonzero((out < 0) & (self.place[slot] >= 0))
        step = 1
        while len(open_) and step < self.steps:
            slot = ((h[open_] + U(step)) & self.mask).astype(np.int64)
            hit = (self.key[slot] == h[open_]) & (self.place[slot] >= 0)
            out[open_[hit]] = self.place[slot[hit]]
            open_ = open_[~hit & (self.place[slot] >= 0)]
            step += 1
        return out


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ragged pieces values[start : start + length], joined."""
    total = np.cumsum(lengths)
    return values[np.repeat(starts - total + lengths, lengths) + np.arange(total[-1] if len(total) else 0)]
