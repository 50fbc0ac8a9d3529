"""Byte-level BPE by prefix dynamic programming (operator 6).

For every prefix of a byte string there is exactly one token that the merge
order lets stand last. ``PrefixTable`` stores that token for each prefix: the
encoding is read off backwards, bytes can be appended without touching what is
there, and after an edit only the prefixes from the edit on are redone. Two
neighbouring tokens are valid if no merge across their border comes before the
merges that build them, which the chains of parts at the border decide.
``last_tokens`` fills the tables of many byte strings at once: a trie of the
reversed tokens gives the tokens that end at each byte, and one step extends all
strings by a byte.

Defined results: null or empty text gives no ids (digests of the empty text);
null ids and repeated rows pass through row by row; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import PieceCache, compiled, worker_cache
from .runtime import texts_of
from .words import text_chunks

_NEVER = 1 << 62
#: So few strings go on one by one, not by array operations.
_FEW = 48
#: Bytes of pieces whose tables are filled at once.
_BLOCK = 1 << 18
#: Borders held with their answer, as a power of two.
_HELD_BITS = 18


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


class Vocabulary:
    """Ranks with, made when first needed, the parts at either end of a token:
    (rank of the part, rank of the token that swallows it)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.bytes_of = {r: t for t, r in ranks.items()}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._ends: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._valid: dict[int, bool] = {}
        self._tables = False

    def _make_tables(self) -> None:
        """Arrays by token, of the trie of reversed tokens and of all pairs that merge."""
        if self._tables:
            return
        tokens = sorted(self.ranks.items(), key=lambda t: len(t[0]))
        top = 1 + max(self.bytes_of)
        self.size = np.zeros(top, dtype=np.int32)
        ids = np.array([i for _, i in tokens], dtype=np.int32)
        size = np.array([len(t) for t, _ in tokens], dtype=np.int64)
        self.size[ids] = size
        # nodes are numbered by level and, within it, by (parent, byte): their keys ascend as a whole
        data = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)
        end, node = np.cumsum(size), np.zeros(len(tokens), dtype=np.int64)
        keys, held, n = [], [np.full(1, -1, np.int32)], 1
        for depth in range(1, self.longest + 1):
            at = int(np.searchsorted(size, depth))
            key, which = np.unique(node[at:] << 8 | data[end[at:] - depth], return_inverse=True)
            node[at:] = n + which
            token = np.full(len(key), -1, dtype=np.int32)
            whole = size[at:] == depth
            token[which[whole]] = ids[at:][whole]
            keys.append(key)
            held.append(token)
            n += len(key)
        self._node_token = np.concatenate(held)
        keys = np.concatenate(keys)
        # the children of a node as a bit map of 256, with the number of the first one of each word
        self._child_bits = np.zeros(4 * n, dtype=np.uint64)
        np.bitwise_or.at(self._child_bits, keys >> 6, np.uint64(1) << (keys & 63).astype(np.uint64))
        count = np.bitwise_count(self._child_bits).astype(np.int64)
        self._child_first = (1 + np.cumsum(count) - count).astype(np.int32)
        pairs = {}
        get = self.ranks.get
        for t, rank in tokens:
            for i in range(1, len(t)):
                a, b = get(t[:i]), get(t[i:])
                if a is not None and b is not None:
                    pairs[a * top + b] = rank
        self._pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self._pair_ranks = np.array([pairs[k] for k in self._pair_keys.tolist()], dtype=np.int64)
        # parts of a token at its left and right end: -1 for none, -2 for not yet known
        self._parts = np.full((2, top), -2, dtype=np.int64)
        self._held = np.zeros(1 << _HELD_BITS, dtype=np.uint64)
        self._tables = True

    def endings(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first by byte plus the total, begins, tokens): the tokens that end at each
        byte and begin within its string, longest first."""
        self._make_tables()
        n = len(data)
        at, node = np.arange(n), np.zeros(n, dtype=np.int64)
        lowest = np.repeat(off[:-1], np.diff(off))
        ends, begins, tokens = [], [], []
        for depth in range(self.longest):
            byte = data[at - depth].astype(np.int64)
            word, bit = node << 2 | byte >> 6, (byte & 63).astype(np.uint64)
            rest = self._child_bits[word] >> bit
            go = (rest & np.uint64(1)).astype(bool)
            at, word, bit = at[go], word[go], bit[go]
            below = self._child_bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            node = self._child_first[word] + np.bitwise_count(below).astype(np.int64)
            token = self._node_token[node]
            is_token = token >= 0
            ends.append(at[is_token])
            begins.append(at[is_token] - depth)
            tokens.append(token[is_token])
            inside = at - depth > lowest[at]
            at, node = at[inside], node[inside]
            if not len(at):
                break
        ends = np.concatenate(ends[::-1])
        order = np.argsort(ends, kind="stable")
        first = np.concatenate(([0], np.cumsum(np.bincount(ends, minlength=n))))
        return first, np.concatenate(begins[::-1])[order], np.concatenate(tokens[::-1])[order]

    def _part(self, token: np.ndarray, side: int) -> np.ndarray:
        got = self._parts[side][token]
        if (got == -2).any():
            for t in np.unique(token[got == -2]).tolist():
                self._parts[:, t] = self.halves(t) or (-1, -1)
            got = self._parts[side][token]
        return got

    def neighbours_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``neighbours`` of many pairs; answers are held as far as there is room."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _HELD_BITS)
        held = self._held[slot]
        # the key, from 1 on, above the answer's bit
        out = (held & np.uint64(1)).astype(bool)
        new = np.flatnonzero(held >> np.uint64(1) != key + np.uint64(1))
        if len(new):
            out[new] = self._border(left[new].astype(np.int64), right[new].astype(np.int64))
            self._held[slot[new]] = (key[new] + np.uint64(1)) << np.uint64(1) | out[new].astype(np.uint64)
        return out

    def _border(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Takes the later made of the two parts at each border apart, again and again:
        no pair of parts on the way may merge before the token taken apart last."""
        out, at, limit = np.ones(len(a), dtype=bool), np.arange(len(a)), np.full(len(a), _NEVER)
        while len(at):
            key = a * self._parts.shape[1] + b
            k = np.minimum(np.searchsorted(self._pair_keys, key), len(self._pair_keys) - 1)
            merge = (self._pair_keys[k] == key) & (self._pair_ranks[k] < limit)
            out[at[merge]] = False
            from_a, from_b = self._part(a, 1), self._part(b, 0)
            split_a = (from_a >= 0) & ((a > b) | (from_b < 0))
            split_b = ~split_a & (from_b >= 0)
            # equal ranks merge from the left, so a border merge wins over one on its right only
            limit = np.where(split_a, a, b + 1)
            a, b = np.where(split_a, from_a, a), np.where(split_b, from_b, b)
            go = ~merge & (split_a | split_b)
            a, b, at, limit = a[go], b[go], at[go], limit[go]
        return out

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a single byte."""
        if token not in self._halves:
            parts = [bytes([b]) for b in self.bytes_of[token]]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
                if rank >= token:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def _chain(self, token: int, side: int) -> list[tuple[int, int]]:
        got = self._ends.get((token, side))
        if got is None:
            got, whole, part = [(token, _NEVER)], token, self.halves(token)
            while part is not None:
                got.append((part[side], whole))
                whole = part[side]
                part = self.halves(whole)
            self._ends[token, side] = got
        return got

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes is just these two tokens."""
        pair = left << 32 | right
        got = self._valid.get(pair)
        if got is None:
            got = True
            for a, a_until in self._chain(left, 1):
                for b, b_until in self._chain(right, 0):
                    merge = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
                    # equal ranks merge from the left, so a border merge wins over one on its right only
                    if merge is not None and merge < a_until and merge <= b_until:
                        got = False
                        break
                if not got:
                    break
            if len(self._valid) > 100_000:
                self._valid.clear()
            self._valid[pair] = got
        return got


class PrefixTable:
    """The last token of every prefix of one byte string."""

    def __init__(self, vocab: Vocabulary, text: bytes = b""):
        self.vocab, self.text, self.last = vocab, b"", [-1]
        self.append(text)

    def append(self, more: bytes) -> None:
        """Extend the string; what is stored for its present prefixes stays."""
        for lo in range(0, len(more), _BLOCK):
            part = more[lo:lo + _BLOCK]
            near = self.text[-self.vocab.longest:]
            data = np.frombuffer(near + part, np.uint8)
            first, begins, tokens = self.vocab.endings(data, np.array([0, len(data)]))
            first = first[len(near):]
            _extend(self.vocab, self.last, first, begins[first[0]:] + (len(self.text) - len(near)), tokens[first[0]:])
            self.text += part

    def edit(self, at: int, removed: int, inserted: bytes) -> None:
        """Replace ``removed`` bytes at ``at``; prefixes before the edit are kept."""
        after = self.text[at + removed:]
        self.text, self.last = self.text[:at], self.last[:at + 1]
        self.append(inserted + after)

    def ids(self, end: int | None = None) -> list[int]:
        """Encoding of the whole string, or of its first ``end`` bytes."""
        end = len(self.text) if end is None else end
        out = []
        while end:
            out.append(self.last[end])
            end -= len(self.vocab.bytes_of[out[-1]])
        return out[::-1]


def _extend(vocab: Vocabulary, last: list[int], first: np.ndarray, begins: np.ndarray, tokens: np.ndarray) -> None:
    """Append to a table (``last`` of prefix 0, 1, ...) the last tokens of the next
    prefixes, given the tokens that may end there."""
    ok = vocab.neighbours
    begins, tokens, first = begins.tolist(), tokens.tolist(), (first - first[0]).tolist()
    for i, j in zip(first, first[1:]):
        for begin, token in zip(begins[i:j], tokens[i:j]):
            if begin == 0 or ok(last[begin], token):
                last.append(token)
                break
        else:
            raise ValueError("the vocabulary lacks a byte")


def last_tokens(vocab: Vocabulary, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """By byte, the last token of the prefix of its string that ends there."""
    first, begins, tokens = vocab.endings(data, off)
    size = np.diff(off)
    if (first[1:] == first[:-1]).any():
        raise ValueError("the vocabulary lacks a byte")
    last = np.full(len(data), -1, dtype=np.int32)
    order = np.argsort(-size, kind="stable")
    base, size = off[:-1][order], size[order]
    longer = len(size) - np.searchsorted(size[::-1], np.arange(1 + (int(size[0]) if len(size) else 0)), side="right")
    done = 0  # bytes of each string that are filled
    while done < len(longer) - 1 and longer[done] >= _FEW:
        left = base[:longer[done]]
        at = left + done
        k = first[at]
        while len(at):
            begin, token = begins[k], tokens[k]
            good = begin == left
            inner = np.flatnonzero(~good)
            good[inner] = vocab.neighbours_of(last[begin[inner] - 1], token[inner])
            last[at[good]] = token[good]
            at, left, k = at[~good], left[~good], k[~good] + 1
            if (k >= first[at + 1]).any():
                raise ValueError("the vocabulary lacks a byte")
        done += 1
    for lo, n in zip(base[:longer[done]].tolist(), size[:longer[done]].tolist()):
        table = [-1, *last[lo:lo + done].tolist()]
        mine = first[lo + done:lo + n + 1]
        _extend(vocab, table, mine, begins[mine[0]:mine[-1]] - lo, tokens[mine[0]:mine[-1]])
        last[lo + done:lo + n] = table[done + 1:]
    return last


def _read_off(vocab: Vocabulary, last: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether a token of its string's encoding ends at a byte."""
    mark = np.zeros(len(last), dtype=bool)
    at, left = off[1:] - 1, off[:-1]
    while len(at) >= _FEW:
        mark[at] = True
        at = at - vocab.size[last[at]]
        more = at >= left
        at, left = at[more], left[more]
    for i, lo in zip(at.tolist(), left.tolist()):
        while i >= lo:
            mark[i] = True
            i -= len(vocab.bytes_of[int(last[i])])
    return mark


def encode_pieces(vocab: Vocabulary, pieces: list[bytes]) -> list[list[int]]:
    ranks = vocab.ranks
    out = [[ranks[p]] if p in ranks else [] for p in pieces]
    rest = [k for k, ids in enumerate(out) if not ids and pieces[k]]
    ends = np.cumsum([len(pieces[k]) for k in rest], dtype=np.int64)
    at = 0
    while at < len(rest):
        # whole pieces up to a block of bytes; a longer piece has a table of its own
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _BLOCK, side="right"))
        if to == at:
            out[rest[at]] = PrefixTable(vocab, pieces[rest[at]]).ids()
            at += 1
            continue
        run = rest[at:to]
        data = np.frombuffer(b"".join([pieces[k] for k in run]), np.uint8)
        off = np.concatenate(([0], ends[at:to] - (ends[at - 1] if at else 0)))
        last = last_tokens(vocab, data, off)
        marked = np.flatnonzero(_read_off(vocab, last, off))
        ids, cut = last[marked].tolist(), np.searchsorted(marked, off).tolist()
        for k, i, j in zip(run, cut, cut[1:]):
            out[k] = ids[i:j]
        at = to
    return out


def _vocabulary(content: bytes) -> Vocabulary:
    return worker_cache("vocab_" + hashlib.md5(content).hexdigest(), lambda: Vocabulary(read_ranks(content)))


def task_cache(content: bytes) -> PieceCache:
    """The pieces of one task; its memory is given back when the task ends."""
    vocab = _vocabulary(content)
    return PieceCache(lambda p: encode_pieces(vocab, p), limit=500_000)


def encode_batches(cache: PieceCache, pattern: str, col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, offsets by row) of runs of an Arrow column of texts."""
    cut = compiled(pattern)
    for lo, hi, data, off in text_chunks(col):
        yield (lo, hi, *cache.rows(data, off, cut))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int): the whole text of every row, encoded."""
    content = _shared(docs, ranks_path)

    def run(batches):
        cache = task_cache(content.value)
        for b in batches:
            for lo, hi, ids, off in encode_batches(cache, pattern, b.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), lists], ["doc_id", "ids"])

    d = texts_of(docs, id_col, text_col)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, text_bytes (binary) of rows with doc_id and ids."""
    content = _shared(encoded, ranks_path)

    def run(batches):
        table = _vocabulary(content.value).bytes_of
        for b in batches:
            out = [b"".join(table[i] for i in ids or ()) for ids in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(out, pa.binary())], ["doc_id", "text_bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text_bytes binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode every text, decode
    the ids, and give digests of both, without shipping the ids to the JVM."""
    content = _shared(docs, ranks_path)

    def run(batches):
        table, cache = _vocabulary(content.value).bytes_of, task_cache(content.value)
        names = worker_cache("decimals", lambda: [str(i) for i in range(1 + max(table))])
        for b in batches:
            for lo, hi, ids, off in encode_batches(cache, pattern, b.column(1)):
                ids, off = ids.tolist(), off.tolist()
                rows = [ids[i:j] for i, j in zip(off, off[1:])]
                a = [hashlib.sha256(" ".join([names[i] for i in r]).encode()).hexdigest() for r in rows]
                d = [hashlib.sha256(b"".join([table[i] for i in r])).hexdigest() for r in rows]
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array([len(r) for r in rows], pa.int64()),
                                       pa.array(a, pa.string()), pa.array(d, pa.string())],
                                      ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    d = texts_of(docs)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
                             "ids_sha256 string, decoded_sha256 string")


def _shared(df: DataFrame, path: str):
    """The vocabulary file (a few MB at most) as a broadcast, read by the driver."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())
