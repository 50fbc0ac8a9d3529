"""Vectorised splitting and hashing of texts, one Arrow batch at a time.

All functions work on the UTF-8 bytes of a batch of texts laid end to end.
Memory is about 60 bytes a byte of ``CHUNK_BYTES`` (or of the longest text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are handled in runs of about so many bytes (a longer text is its own run).
CHUNK_BYTES = 1 << 19

#: Bytes of words split at ASCII white space: [^\x20\x09-\x0D].
SPACE_WORDS = np.ones(256, dtype=bool)
SPACE_WORDS[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words of ASCII letters, digits and all non-ASCII text.
PLAIN_WORDS = np.zeros(256, dtype=bool)
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    PLAIN_WORDS[_lo:_hi] = True

#: ASCII lower case by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: Word, piece and passage hashes are two polynomials over the bytes modulo the prime
#: 2^31 - 1, with different bases. A prime has none of the structured collisions
#: (Thue-Morse strings and the like) of arithmetic modulo a power of two.
_PRIME = np.uint64((1 << 31) - 1)
_BASES = (1_432_908_761, 776_531_401)
_BYTE = [np.random.default_rng(seed).integers(1, int(_PRIME), 256, dtype=np.uint64) for seed in (20240, 20241)]
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _modulo(x: np.ndarray) -> np.ndarray:
    """x mod 2^31 - 1 for x below 2^62."""
    x = (x & _PRIME) + (x >> np.uint64(31))
    return np.where(x >= _PRIME, x - _PRIME, x)


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n - 1) modulo the prime; kept up to the usual size."""
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        got = np.ones(1, dtype=np.uint64)
        while len(got) < max(n, 2 * CHUNK_BYTES):
            got = np.concatenate((got, _modulo(got * np.uint64(pow(base, len(got), int(_PRIME))))))
        if n <= 2 * CHUNK_BYTES:
            _POWERS[base] = got
    return got[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span [start, end), end > start."""
    n = len(data)
    if n == 0 or len(start) == 0:
        return np.zeros(len(start), dtype=np.uint64)
    out = (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    last = end - 1
    for k, base in enumerate(_BASES):
        up = _sums(_BYTE[k], data, _powers(base, n))
        # a span's sum, moved down to place 0 by the inverse power of its start
        part = up[last] - up[start]
        part += _BYTE[k][data[start]] * _powers(base, n)[start] % _PRIME
        part = _modulo(_modulo(part) * _powers(pow(base, -1, int(_PRIME)), n)[start])
        out ^= part << np.uint64(33 * k)
    return mix(out)


def _sums(value: np.ndarray, data: np.ndarray, powers: np.ndarray, block: int = 1 << 13) -> np.ndarray:
    """Running sums of value[byte] * power modulo the prime, block by block so that
    the steps stay in the processor's cache (below 2^32 a byte, so no sum overflows)."""
    up = np.empty(len(data), dtype=np.uint64)
    high = np.empty(block, dtype=np.uint64)
    carry = np.uint64(0)
    for lo in range(0, len(data), block):
        t = up[lo:lo + block]
        h = high[:len(t)]
        np.take(value, data[lo:lo + block], out=t, mode="clip")
        t *= powers[lo:lo + block]
        np.right_shift(t, np.uint64(31), out=h)
        t &= _PRIME
        t += h
        t[0] += carry
        np.cumsum(t, out=t)
        carry = t[-1]
    return up


def text_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets within the bytes) of runs of rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    n = len(col)
    if n == 0:
        return
    _, off, data = col.buffers()
    off = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to, data[off[at]:off[to]], off[at:to + 1] - off[at]
        at = to
    pa.default_memory_pool().release_unused()


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each row plus the total) of the words; no word
    crosses from one row into the next."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    w = is_word[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    start = w.copy()
    start[1:] &= ~w[:-1] | edge[1:n]
    end = w.copy()
    end[:-1] &= ~w[1:] | edge[1:n]
    start = np.flatnonzero(start)
    return start, np.flatnonzero(end) + 1, np.searchsorted(start, off)


_PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row offsets) of all k consecutive words within each row (first:
    word offsets of the rows); a shorter, non-empty row is one shingle of all its
    words."""
    n_words = np.diff(first)
    size = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    off = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(first[:-1] - off[:-1], size) + np.arange(off[-1])
    width = np.repeat(np.minimum(n_words, k), size)
    h = width.astype(np.uint64)
    for j in range(k):
        inside = width > j
        h[inside] += words[at[inside] + j] * _PLACE[j]
    return mix(h), off
