"""Cross-tokenizer alignment by products of token-byte incidence matrices (operator 12).

A text is encoded by two tokenizers, A (byte-level BPE of space + text) and B (a
sentence-piece model, which adds the space itself). Row i of a tokenizer's incidence
matrix has a one for every byte of its token i. The matrices are hand-built CSR
(row pointers, column numbers); Gustavson's row-by-row product A * B^T gives the
overlap links with their bytes. Where neither token of an overlap goes on, both
end: that cuts the text into groups, and the links whose tokens end together are
the linked pairs. The product of the two token-group incidence matrices gives the
shared-group links.

How often an id pair is linked is counted over the corpus. Documents are handled
in blocks of some MB of text; a block names its distinct id pairs once, so pairs are
counted, joined with their counts and sent back by block, not by document: the most
frequent pair is one row a block.

Defined results: a text that is null or empty, or that the joined token bytes of A
or B do not give back (B normalises some characters), has no tokens: all numbers 0
and the digest ''. Null ids and repeated rows count one by one; an empty table gives
no rows; other columns are not read. Memory is about 100 bytes a byte of a run of
texts (half a MB, or one longer text), and 4 bytes a link of a block.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .idpack import _encoder
from .pieces import compiled, worker_cache
from .runtime import scope, stored, texts_of
from .words import text_chunks

#: Text bytes of the documents that name their id pairs together.
BLOCK_BYTES = 4 << 20


# --- incidence matrices ------------------------------------------------------

def incidence(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CSR (pointers, columns) of tokens of the given byte sizes laid end to end."""
    ptr = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
    return ptr, np.arange(ptr[-1])


def transposed(ptr: np.ndarray, col: np.ndarray, n_cols: int) -> tuple[np.ndarray, np.ndarray]:
    """CSR of the transpose."""
    row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    if len(col) > 1 and (col[1:] < col[:-1]).any():
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
    return np.searchsorted(col, np.arange(n_cols + 1)), row


def row_products(a_ptr: np.ndarray, a_col: np.ndarray, b_ptr: np.ndarray, b_col: np.ndarray, n_cols: int):
    """(rows, columns, values) of the product of two 0/1 matrices, ascending: every
    one of a row of the first adds the row of the second that it points to
    (Gustavson), for all rows at once."""
    row = np.repeat(np.arange(len(a_ptr) - 1), np.diff(a_ptr))
    first, more = b_ptr[a_col], np.diff(b_ptr)[a_col]
    if (more == 1).all():
        col = b_col[first]
    else:
        row = np.repeat(row, more)
        col = b_col[np.repeat(first - (np.cumsum(more) - more), more) + np.arange(int(more.sum()))]
    key = row * max(n_cols, 1) + col
    if len(key) > 1 and (key[1:] < key[:-1]).any():
        key.sort()
    new = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
    value = np.diff(np.append(new, len(key)))
    key = key[new]
    return key // max(n_cols, 1), key % max(n_cols, 1), value


@dataclass
class Alignment:
    """Overlap links (a token, b token, shared bytes) of two token sequences over
    the same bytes, the links that end together, and the group of every token."""

    a: np.ndarray
    b: np.ndarray
    shared: np.ndarray
    ends: np.ndarray  # places among the links
    group_a: np.ndarray
    group_b: np.ndarray

    def shared_group_links(self):
        """(a token, b token) of every pair within one group, by the product of the
        token-group incidence matrices; a generator by some groups at a time, since a
        group of n and m tokens has n * m of them."""
        n = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        for lo in range(0, n, 1024):
            i0, i1 = np.searchsorted(self.group_a, [lo, lo + 1024])
            j0, j1 = np.searchsorted(self.group_b, [lo, lo + 1024])
            ptr, col = transposed(np.arange(j1 - j0 + 1), self.group_b[j0:j1] - lo, 1024)
            i, j, _ = row_products(np.arange(i1 - i0 + 1), self.group_a[i0:i1] - lo, ptr, col, j1 - j0)
            yield i0 + i, j0 + j


def align(a_size: np.ndarray, b_size: np.ndarray) -> Alignment:
    """Alignment of two sequences of token sizes with equal sums."""
    a_ptr, a_col = incidence(a_size)
    b_ptr, b_col = incidence(b_size)
    a, b, shared = row_products(a_ptr, a_col, *transposed(b_ptr, b_col, int(a_ptr[-1])), len(b_size))
    if not len(a):
        none = np.zeros(0, np.int64)
        return Alignment(none, none, none, none, none, none)
    # links ascend by both tokens; a group begins where both tokens are new
    fresh = np.ones(len(a), dtype=bool)
    fresh[1:] = (a[1:] != a[:-1]) & (b[1:] != b[:-1])
    group = np.cumsum(fresh) - 1
    first_a = np.concatenate(([True], a[1:] != a[:-1]))
    first_b = np.concatenate(([True], b[1:] != b[:-1]))
    return Alignment(a, b, shared, np.flatnonzero(a_ptr[a + 1] == b_ptr[b + 1]), group[first_a], group[first_b])


# --- tokenizers --------------------------------------------------------------

class TokenBytes:
    """The bytes of every id, laid end to end."""

    def __init__(self, entries: list[bytes]):
        self.size = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries))
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        return self.data[np.repeat(self.at[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable
    Latin-1 characters for themselves, the others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


def byte_level_entries(content: bytes) -> list[bytes]:
    """Bytes of the ids of a tokenizers file of a byte-level BPE."""
    made, letters = json.loads(content), _byte_letters()
    names = dict(made["model"]["vocab"]) | {t["content"]: t["id"] for t in made["added_tokens"]}
    out = [b""] * (max(names.values()) + 1)
    for name, k in names.items():
        out[k] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
    return out


def piece_entries(sp) -> list[bytes]:
    """Bytes of the ids of a sentence-piece model."""
    return [bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode()
            for k in range(sp.get_piece_size())]


class _Pair:
    """Both tokenizers, their byte tables and the decimal ids with each separator."""

    def __init__(self, a_content: bytes, pattern: str, b_content: bytes):
        import sentencepiece
        self.cache, self.cut = _encoder(a_content), compiled(pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_content)
        self.a_bytes, self.b_bytes = TokenBytes(byte_level_entries(a_content)), TokenBytes(piece_entries(self.b))
        self.n_ids = max(len(self.a_bytes.size), len(self.b_bytes.size))
        self.written = [f"{k}{s}" for s in (",", "|", ";", "") for k in range(self.n_ids)]

    @staticmethod
    def here(shared) -> _Pair:
        a, pattern, b = shared.value
        return worker_cache("pair_" + hashlib.md5(a + b).hexdigest(), lambda: _Pair(a, pattern, b))


@dataclass
class Run:
    """A run of texts, aligned. Tokens and links of all rows are laid end to end;
    the offsets say which belong to a row."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_off: np.ndarray
    b_off: np.ndarray
    alignment: Alignment
    overlap_off: np.ndarray
    link_off: np.ndarray
    n_groups: np.ndarray

    def pairs(self) -> np.ndarray:
        """a id * 2^32 + b id of every link that ends together."""
        x = self.alignment
        return (self.a_ids[x.a[x.ends]].astype(np.int64) << 32) | self.b_ids[x.b[x.ends]].astype(np.int64)

    def groups_written(self, pair: _Pair) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of every row."""
        x = self.alignment
        where = np.concatenate((2 * x.group_a, 2 * x.group_b + 1))
        order = np.argsort(where, kind="stable")
        where = where[order]
        step = np.full(len(where), 3)
        step[:-1] = np.where(where[1:] == where[:-1], 0, np.where(where[1:] >> 1 == where[:-1] >> 1, 1, 2))
        off = self.a_off + self.b_off
        step[off[1:][off[1:] > off[:-1]] - 1] = 3
        entry = (np.concatenate((self.a_ids, self.b_ids))[order].astype(np.int64) + step * pair.n_ids).tolist()
        table = pair.written
        return ["".join([table[e] for e in entry[i:j]]) for i, j in zip(off.tolist(), off[1:].tolist())]


def align_run(pair: _Pair, data: np.ndarray, off: np.ndarray) -> Run:
    """Tokens and links of the rows of a run of texts."""
    n = len(off) - 1
    spaced = np.insert(data, off[:-1], 0x20)
    s_off = off + np.arange(n + 1)
    a_ids, a_at = pair.cache.rows(spaced, s_off, pair.cut)
    texts = [data[i:j].tobytes().decode() for i, j in zip(off.tolist(), off[1:].tolist())]
    made = pair.b.encode(texts, num_threads=1)
    b_at = np.concatenate(([0], np.cumsum([len(x) for x in made])))
    b_ids = np.fromiter(itertools.chain.from_iterable(made), dtype=np.uint32, count=int(b_at[-1]))

    good = off[1:] > off[:-1]
    for ids, at, table in ((a_ids, a_at, pair.a_bytes), (b_ids, b_at, pair.b_bytes)):
        own = np.concatenate((np.zeros(1, np.int64), np.cumsum(table.size[ids])))[at]
        good &= np.diff(own) == np.diff(s_off)
        live = np.repeat(good, np.diff(own))
        back = table.of(ids)[live] == spaced[np.repeat(good, np.diff(s_off))]
        if not back.all():  # same size, other bytes
            row = np.repeat(np.flatnonzero(good), np.diff(s_off)[good])
            good[np.unique(row[~back])] = False
    kept_a, kept_b = np.repeat(good, np.diff(a_at)), np.repeat(good, np.diff(b_at))
    a_ids, b_ids = a_ids[kept_a], b_ids[kept_b]
    offsets = lambda at: np.concatenate(([0], np.cumsum(np.where(good, np.diff(at), 0))))
    a_off, b_off = offsets(a_at), offsets(b_at)
    x = align(pair.a_bytes.size[a_ids], pair.b_bytes.size[b_ids])
    top = np.append(x.group_a, x.group_a[-1] + 1 if len(x.group_a) else 0)
    return Run(a_ids, b_ids, a_off, b_off, x, np.searchsorted(x.a, a_off), np.searchsorted(x.a[x.ends], a_off), np.diff(top[a_off]))


def _models(docs: DataFrame, a_path: str, pattern: str, b_path: str):
    """Both files, broadcast (their sizes do not depend on the data)."""
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        return docs.sparkSession.sparkContext.broadcast((f.read(), pattern, g.read()))


# --- operators ---------------------------------------------------------------

def aligned_documents(docs: DataFrame, a_path: str, pattern: str, b_path: str) -> DataFrame:
    """doc_id, a_ids, b_ids, overlaps (array of a token, b token, shared bytes, and
    whether both end there), groups (text) of every document."""
    shared = _models(docs, a_path, pattern, b_path)
    link = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32()), ("ends", pa.bool_())])

    def run(batches):
        pair = _Pair.here(shared)
        for batch in batches:
            for lo, hi, data, off in text_chunks(batch.column(1)):
                r = align_run(pair, data, off)
                x = r.alignment
                ends = np.zeros(len(x.a), bool)
                ends[x.ends] = True
                base_a = np.repeat(r.a_off[:-1], np.diff(r.overlap_off))
                base_b = np.repeat(r.b_off[:-1], np.diff(r.overlap_off))
                flat = pa.StructArray.from_arrays(
                    [pa.array((x.a - base_a).astype(np.int32)), pa.array((x.b - base_b).astype(np.int32)),
                     pa.array(x.shared.astype(np.int32)), pa.array(ends)], fields=list(link))
                lists = [pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), v) for o, v in (
                    (r.a_off, pa.array(r.a_ids.astype(np.int32))), (r.b_off, pa.array(r.b_ids.astype(np.int32))), (r.overlap_off, flat))]
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), *lists, pa.array(r.groups_written(pair), pa.string())],
                                      ["doc_id", "a_ids", "b_ids", "overlaps", "groups"])

    d = texts_of(docs)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, a_ids array<int>, b_ids array<int>, "
                             "overlaps array<struct<a:int,b:int,bytes:int,ends:boolean>>, groups string")


def _blocks(docs: DataFrame, shared, block_bytes: int) -> DataFrame:
    """Rows of documents (block, doc_id, counts, digest, links: for each link the
    number of its id pair within the block) and of blocks (block, pairs, times)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    columns = ["block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "pairs", "times"]

    def run(batches):
        pair = _Pair.here(shared)
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def out():
            keys = np.concatenate([h[-2] for h in held])
            distinct, number, times = np.unique(keys, return_inverse=True, return_counts=True)
            number, at = number.astype("<u4"), 0
            for ids, n_a, n_b, n_groups, digest, own, off in held:
                n = len(ids)
                links = [number[at + i:at + j].tobytes() for i, j in zip(off.tolist(), off[1:].tolist())]
                at += len(own)
                yield pa.record_batch([pa.array(np.full(n, block)), ids, pa.array(n_a), pa.array(n_b), pa.array(n_groups),
                                       pa.array(digest, pa.string()), pa.array(links, pa.binary()), pa.nulls(n, pa.binary()),
                                       pa.nulls(n, pa.binary())], columns)
            blank = [pa.nulls(1, t) for t in (held[0][0].type, *[pa.int64()] * 3, pa.string(), pa.binary())]
            yield pa.record_batch([pa.array([block], pa.int64()), *blank, pa.array([distinct.astype("<i8").tobytes()], pa.binary()),
                                   pa.array([times.astype("<i8").tobytes()], pa.binary())], columns)

        for b in batches:
            for lo, hi, data, off in text_chunks(b.column(1)):
                r = align_run(pair, data, off)
                digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in r.groups_written(pair)]
                held.append((b.column(0).slice(lo, hi - lo), np.diff(r.a_off), np.diff(r.b_off), r.n_groups, digest, r.pairs(), r.link_off))
                size += len(data)
                if size >= block_bytes:
                    yield from out()
                    block, held, size = block + 1, [], 0
        if held:
            yield from out()

    return docs.mapInArrow(run, f"block long, doc_id {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, "
                                "links binary, pairs binary, times binary")


def _pair_rows(batches):
    """(block, place, pair, times) of the blocks' pairs."""
    for b in batches:
        for block, pairs, times in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            pairs = np.frombuffer(pairs, "<i8")
            if len(pairs):
                yield pa.record_batch([pa.array(np.full(len(pairs), block)), pa.array(np.arange(len(pairs), dtype=np.int32)),
                                       pa.array(pairs), pa.array(np.frombuffer(times, "<i8"))], ["block", "place", "pair", "times"])


_OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _documents_of_block(docs: pa.Table, known: pa.Table) -> pa.Table:
    """The rows of a block's documents with the counts of their links' pairs."""
    count = np.zeros(known.num_rows, np.int64)
    best = np.zeros(known.num_rows, np.int64)
    place = known.column("place").to_numpy()
    count[place], best[place] = known.column("count").to_numpy(), known.column("best").to_numpy()
    links = [np.frombuffer(x, "<u4") for x in docs.column("links").to_pylist()]
    off = np.concatenate(([0], np.cumsum([len(x) for x in links]))).astype(np.int64)
    flat = np.concatenate(links) if links else np.zeros(0, np.uint32)
    total = lambda v: np.diff(np.concatenate((np.zeros(1, np.int64), np.cumsum(v[flat])))[off])
    return pa.table([docs.column("doc_id"), docs.column("n_a"), docs.column("n_b"), docs.column("n_groups"), pa.array(np.diff(off)),
                     pa.array(total(best)), pa.array(total(count)), docs.column("groups_sha256")], names=_OUT)


def alignment_digests(docs: DataFrame, a_path: str, pattern: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256."""
    d = texts_of(docs)
    id_type = d.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    with scope(docs.sparkSession):
        made = stored(_blocks(d, _models(docs, a_path, pattern, b_path), block_bytes), "aligned")
        pairs = (made.where("pairs is not null").select("block", "pairs", "times")
                 .mapInArrow(_pair_rows, "block long, place int, pair long, times long"))
        counts = stored(pairs.groupBy("pair").agg(F.sum("times").alias("count")), "pair-counts")
        b_id = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b_id")
        # one row an id of B's vocabulary, however large the corpus
        top = F.broadcast(counts.groupBy(b_id).agg(F.max("count").alias("top")))
        ranked = (counts.withColumn("b_id", b_id).join(top, "b_id")
                  .select("pair", "count", (F.col("count") == F.col("top")).cast("long").alias("best")))
        known = pairs.select("block", "place", "pair").join(ranked, "pair").select("block", "place", "count", "best")
        texts = made.where("links is not null").select("block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links")
        return stored(texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_documents_of_block, schema),
                      "alignment", outlives=True)
