"""Substring dedup by content-defined chunking (operator 4).

A gear rolling hash over the last 16 bytes picks the chunk borders, so a border
depends only on the bytes just before it and an insertion moves no other one. A
border falls at one word start in four, and elsewhere at one character in 128, or
after 16 bytes without a blank (Chinese, Japanese, Thai, long encoded strings) at
one in eight of three bytes, so that borders stand as close as in spaced text.
A passage is a sequence of consecutive chunks of at least ``MIN_RUN`` bytes; the
shortest such sequences from and up to every chunk are deduplicated by 64-bit
digest of their bytes: the occurrence with the smallest (doc_id, text digest,
place) stays, and every other one is removed. So what goes stands, in the same
order and in one place, earlier in the corpus; short common phrases stay, however
many of them stand side by side.

Repeats within one run of texts are settled there, which thins a passage that a
third of all documents share before it is shuffled; what is settled goes on
under a key of its own.

Defined results: null or empty text stays empty; rows with equal doc_id and
equal text are one document, treated alike; null ids come first in the order;
an empty table gives no rows; other columns, whatever their names, pass unread.
A text is held in memory some 60 times over while it is cut, however long it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import texts_of
from .words import mix, span_hashes, text_chunks

MIN_RUN = 100
_GEAR = np.random.default_rng(77).integers(0, 1 << 16, 256, dtype=np.uint16)
#: Hashes that make a border in stretches without blanks, by first byte of a character: one border in 24 bytes.
_DENSE = np.zeros(256, dtype=np.uint16)
for _lo, _hi, _size in ((0x00, 0x80, 1), (0xC0, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0x100, 4)):
    _DENSE[_lo:_hi] = (_size << 16) // 24
#: Texts whose repeats are settled together before the shuffle, in bytes.
_RUN_BYTES = 1 << 20


def chunk_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Start offsets of the chunks of all rows; every byte is in one chunk."""
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    gear = _GEAR[data]
    h = np.zeros(n, dtype=np.uint16)
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    for k in range(min(16, n)):  # byte i - k has moved up by k bits; the oldest has left after 16
        h[k:] += gear[:n - k] << np.uint16(k)
    # the border before byte i looks at bytes up to i - 1; near a row's start it also sees the row before,
    # so rows are told apart by leaving the first 16 bytes of a row without borders
    before = np.zeros(n, dtype=np.uint16)
    before[1:] = h[:-1]
    age = np.arange(n, dtype=np.int32) - np.repeat(off[:-1].astype(np.int32), np.diff(off))
    blank = (data == 0x20) | (data == 0x0A) | (data == 0x09) | (data == 0x0D)
    word = np.zeros(n, dtype=bool)
    word[1:] = blank[:-1] & ~blank[1:]
    cut = (word & (before >> 14 == 0)) | ((before >> 9 == 1) & ((data & 0xC0) != 0x80))
    place = np.arange(n, dtype=np.int32)
    near = np.maximum.accumulate(np.where(blank, place, np.int32(-17)))
    dense = place - near > 16  # this byte and the 16 before it; one byte over and over has no borders
    dense[1:] &= data[1:] != data[:-1]
    cut |= dense & (before < _DENSE[data])
    return np.flatnonzero((cut & (age >= 16)) | (age == 0))


def passages(start: np.ndarray, off: np.ndarray, min_run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin byte, end byte, row and place of the shortest sequences of chunks of
    at least ``min_run`` bytes that begin (place 2 k), or that end (2 k + 1), at
    chunk k of a row. Every longer sequence is the union of those inside it."""
    if not len(start):
        return start, start, start, start
    end = np.append(start[1:], off[-1])
    row = np.searchsorted(off, start, side="right") - 1
    k = np.arange(len(start)) - np.searchsorted(start, off[row])
    last = np.searchsorted(end, start + min_run)
    ahead = start + min_run <= off[row + 1]
    first = np.searchsorted(start, end - min_run, side="right") - 1
    back = (end - min_run >= off[row]) & (last[first] != np.arange(len(start)))  # not yet among those ahead
    return (np.concatenate((start[ahead], start[first[back]])), np.concatenate((end[last[ahead]], end[back])),
            np.concatenate((row[ahead], row[back])), np.concatenate((2 * k[ahead], 2 * k[back] + 1)))


def _thinned(begin: np.ndarray, end: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places in the arrays of fewer spans that cover the same bytes of each row."""
    at = np.lexsort((end, begin, row))
    for _ in range(4):
        drop = np.zeros(len(at), dtype=bool)
        x, y = at[:-2], at[2:]  # both neighbours stay and leave no gap
        drop[1:-1] = (row[x] == row[y]) & (begin[y] <= end[x]) & (end[at[1:-1]] <= end[y])
        drop[::2] = False
        at = at[~drop]
    return at


def _places(docs: DataFrame, min_run: int) -> DataFrame:
    """digest, doc_id, at of every passage; at is the text digest in the upper half,
    then twice the place, plus one if an earlier one stands in the same run of texts."""
    def run(batches):
        for b in batches:
            ids = b.column(0)
            # null ids first, in the order that Spark sorts by
            name = np.array([-(1 << 63) if x is None else x for x in ids.to_pylist()], dtype=np.int64)
            th = np.asarray(b.column(1)).astype(np.int64)
            for lo, hi, data, off in text_chunks(b.column(2), _RUN_BYTES):
                begin, end, row, place = passages(chunk_starts(data, off), off, min_run)
                if not len(begin):
                    continue
                digest = span_hashes(data, begin, end)
                at = (th[lo + row] << 32) | (place << 1)
                doc = name[lo + row]
                order = np.lexsort((at, doc, digest))
                d = digest[order]
                lead = np.ones(len(d), dtype=bool)
                lead[1:] = d[1:] != d[:-1]
                head = order[np.maximum.accumulate(np.where(lead, np.arange(len(d)), 0))]
                sure = np.zeros(len(d), dtype=bool)
                sure[order] = (doc[order] != doc[head]) | (at[order] != at[head])
                settled = np.flatnonzero(sure)
                settled = settled[_thinned(begin[settled], end[settled], row[settled])]
                new = np.flatnonzero(~sure)
                own = mix(digest[settled] + mix(at[settled].view(np.uint64) + row[settled].astype(np.uint64)))
                to = np.concatenate((new, settled))
                yield pa.record_batch(
                    [pa.array(np.concatenate((digest[new], own)).view(np.int64)), ids.take(pa.array(lo + row[to])),
                     pa.array(np.concatenate((at[new], at[settled] | 1)))], ["digest", "doc_id", "at"])

    return docs.select("doc_id", "th", "text").mapInArrow(run, "digest long, doc_id long, at long")


def repeated_passages(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, th, places of the passages that stand earlier in the corpus, for
    documents that have any (docs: doc_id, th, text)."""
    # equal rows have equal rank: one document, treated alike
    again = F.rank().over(Window.partitionBy("digest").orderBy("doc_id", "at")) > 1
    rows = _places(docs, min_run).withColumn("again", again).where("again or at & 1 = 1")
    place = F.shiftright(F.col("at").bitwiseAND(0xFFFFFFFF), 1).cast("int")
    # a document's own passages: bounded by its length
    return (rows.groupBy("doc_id", F.shiftright("at", 32).cast("int").alias("th"))
            .agg(F.collect_set(place).alias("places")))


def dedup_substrings(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """One row a document: doc (its other columns, a struct with doc_id), text
    without the removed runs, n_bytes, n_removed (bytes), spans (array of begin
    and end bytes of what was removed)."""
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       others.alias("doc")).withColumn("th", F.hash("text"))
    r = (repeated_passages(base.drop("doc"), min_run)
         .select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "places"))
    both = base.join(r, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            marked = b.column(2).to_pylist()
            for lo, hi, data, off in text_chunks(b.column(1)):
                out = [_without_spans(data[i:j], m, min_run) for i, j, m in zip(off, off[1:], marked[lo:hi])]
                yield pa.record_batch(
                    [b.column(0).slice(lo, hi - lo), pa.array([t for t, _ in out], pa.string()),
                     pa.array(np.diff(off)), pa.array([sum(y - x for x, y in s) for _, s in out], pa.int64()),
                     pa.array([[{"begin": x, "end": y} for x, y in s] for _, s in out], span)],
                    ["doc", "text", "n_bytes", "n_removed", "spans"])

    shape = T.StructType([both.schema["doc"]]).add("text", "string").add("n_bytes", "long").add("n_removed", "long").add(
        "spans", T.ArrayType(T.StructType().add("begin", T.IntegerType()).add("end", T.IntegerType())))
    return both.select("doc", "text", "places").mapInArrow(run, shape)


def _without_spans(row: np.ndarray, places: list[int] | None, min_run: int) -> tuple[str, list[tuple[int, int]]]:
    """A text's bytes without the passages at places, and the spans they cover."""
    if not places:
        return row.tobytes().decode(), []
    off = np.array([0, len(row)])
    begin, end, _, place = passages(chunk_starts(row, off), off, min_run)
    gone = np.isin(place, np.array(places))
    begin, end = begin[gone], end[gone]
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    gap = np.flatnonzero(begin[1:] > end[:-1])
    spans = list(zip(begin[np.append(0, gap + 1)].tolist(), end[np.append(gap, len(end) - 1)].tolist()))
    keep = np.ones(len(row), dtype=bool)
    for x, y in spans:
        keep[x:y] = False
    return row[keep].tobytes().decode(), spans
