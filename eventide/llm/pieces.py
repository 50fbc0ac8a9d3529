"""Byte-level BPE pieces of whole batches, and a bounded cache from piece to ids.

A text is cut into the matches of the pre-tokenisation pattern; every match is
encoded on its own, so a piece that occurs again takes its ids from the cache.
Rows of ASCII and Latin letters (U+00C0 to U+02AF) are cut with array
operations; all others with the pattern itself. Both cut alike (tested).
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
import regex

from .words import span_hashes

#: White space as the pattern's own engine has it (White_Space property).
_SPACE = "[" + "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                               0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]"
_LETTER, _DIGIT, _BLANK, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
for _lo, _hi in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0xC0), (0xC3, 0xCB)):
    _CLASS[_lo:_hi] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[0x20, *range(0x09, 0x0E)]] = _BLANK
#: Lead bytes of text that the array form does not know.
_STRANGE = np.zeros(256, dtype=bool)
_STRANGE[0xC2] = True
_STRANGE[0xCA:] = True


def compiled(pattern: str) -> regex.Pattern:
    r"""The pattern with \s spelled out as White_Space."""
    inner = _SPACE[1:-1]
    out = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^" + inner + r"\p{L}\p{N}]").replace(r"(?!\S)", f"(?![^{inner}])")
    return regex.compile(out.replace(r"\s", _SPACE))


def piece_starts(data: np.ndarray, off: np.ndarray, pattern: regex.Pattern) -> np.ndarray:
    """Start offsets of all pieces of the rows (the pieces cover every byte)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    cls = _CLASS[data]
    # multiplication and division sign are no letters; their second byte follows the first
    sign = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    cls[sign] = _OTHER
    cls[sign + 1] = _OTHER
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    blank = cls == _BLANK
    change = np.ones(n, dtype=bool)
    change[1:] = (cls[1:] != cls[:-1]) | edge[1:n]
    start = change.copy()
    # white space before a word: the last character stands alone, or joins the word if it is a space
    last = blank.copy()
    last[:-1] &= ~blank[1:] & ~edge[1:n]
    last[-1] = False
    start |= last
    joins = np.flatnonzero(last & (data == 0x20))
    start[joins + 1] = False
    # contractions: an apostrophe that begins a piece and is followed at once by s t m d re ve ll
    quote = np.flatnonzero((data == 0x27) & start)
    quote = quote[quote + 1 < n]
    quote = quote[~edge[quote + 1] & (cls[quote + 1] == _LETTER)]
    if len(quote):
        a = data[quote + 1]
        two = quote + 2 < n
        b = np.where(two, data[np.minimum(quote + 2, n - 1)], 0)
        b[two & edge[np.minimum(quote + 2, n)]] = 0
        short = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        long = ((a == 0x72) & (b == 0x65)) | ((a == 0x76) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C))
        for at, width in ((quote[short], 2), (quote[long], 3)):
            start[at + 1] = False
            more = at + width
            more = more[more < n]
            start[more[(cls[more] == _LETTER) | edge[more]]] = True
    strange = _STRANGE[data]
    if strange.any():
        rows = np.unique(np.searchsorted(off, np.flatnonzero(strange), side="right") - 1)
        for r in rows:
            lo, hi = off[r], off[r + 1]
            size = [len(m.encode()) for m in pattern.findall(data[lo:hi].tobytes().decode())]
            start[lo:hi] = False
            start[lo + np.concatenate(([0], np.cumsum(size[:-1], dtype=np.int64)))] = True
    return np.flatnonzero(start)


class PieceCache:
    """Ids of pieces, looked up by the piece's 64-bit hash and filled by
    ``encode(list of pieces as bytes) -> list of id lists``. The bytes of every hit
    are compared with those held, so the ids are right whatever the hash. Held in
    arrays of about 45 bytes a piece and emptied at ``limit`` pieces or ``limit_bytes``
    of them, so memory is bounded whatever the vocabulary."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], limit: int = 1_000_000, limit_bytes: int = 1 << 25):
        self.encode, self.limit, self.limit_bytes = encode, limit, limit_bytes
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)  # ascending
        self.first = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(1 << 18, dtype=np.uint32)
        self.used = 0
        self.text_at = np.zeros(0, dtype=np.int64)
        self.text_size = np.zeros(0, dtype=np.int64)
        self.text = np.zeros(1 << 18, dtype=np.uint8)
        self.text_used = 0

    def _add(self, at: np.ndarray, keys: np.ndarray, pieces: list[bytes]) -> None:
        made = self.encode(pieces)
        size = np.fromiter(map(len, made), dtype=np.int64, count=len(made))
        flat = np.fromiter((i for ids in made for i in ids), dtype=np.uint32, count=int(size.sum()))
        text_size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        text = np.frombuffer(b"".join(pieces), np.uint8)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.text_used + len(text) > len(self.text):
            self.text = np.concatenate((self.text, np.zeros_like(self.text)))
        self.ids[self.used:self.used + len(flat)] = flat
        self.text[self.text_used:self.text_used + len(text)] = text
        self.first = np.insert(self.first, at, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.text_at = np.insert(self.text_at, at, self.text_used + np.cumsum(text_size) - text_size)
        self.text_size = np.insert(self.text_size, at, text_size)
        self.keys = np.insert(self.keys, at, keys)
        self.used += len(flat)
        self.text_used += len(text)

    def _same(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> bool:
        """Whether each piece has the bytes held at its place (the pieces cover data)."""
        size = end - start
        if (self.text_size[at] != size).any():
            return False
        return bool((self.text[np.repeat(self.text_at[at] - start, size) + np.arange(len(data))] == data).all())

    def _uncached(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids by piece) without hashes, for a run in which two pieces share one."""
        pieces = [data[i:j].tobytes() for i, j in zip(start.tolist(), end.tolist(), strict=True)]
        distinct = list(dict.fromkeys(pieces))
        made = {p: np.array(ids, np.uint32) for p, ids in zip(distinct, self.encode(distinct), strict=True)}
        return np.concatenate([made[p] for p in pieces]), np.array([len(made[p]) for p in pieces])

    def rows(self, data: np.ndarray, off: np.ndarray, pattern: regex.Pattern) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, id offsets by row) of a run of texts."""
        start = piece_starts(data, off, pattern)
        end = np.append(start[1:], len(data))
        keys, first, which = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit or self.text_used > self.limit_bytes:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), dtype=bool)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        if new.any():
            self._add(at[new], keys[new], [data[start[i]:end[i]].tobytes() for i in first[new].tolist()])
            at = np.searchsorted(self.keys, keys)
        at = at[which]
        if self._same(data, start, end, at):
            size = self.size[at]
            to = np.cumsum(size)
            total = int(to[-1]) if len(to) else 0
            ids = self.ids[np.repeat(self.first[at] - (to - size), size) + np.arange(total)]
        else:
            ids, size = self._uncached(data, start, end)
            to = np.cumsum(size)
        row = np.searchsorted(start, off)
        return ids, np.concatenate(([0], to))[row]


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """One object a Python worker process, kept from task to task."""
    home = sys.modules.setdefault("_eventide_llm_worker", types.ModuleType("_eventide_llm_worker"))
    got = getattr(home, name, None)
    if got is None:
        got = make()
        setattr(home, name, got)
    return got
