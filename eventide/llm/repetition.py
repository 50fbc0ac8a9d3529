"""Quality rules with suffix-array repetition (operator 8).

The words of a text get a suffix array by prefix doubling, all texts of a batch
at once: after round r the ranks tell runs of 2**r words apart, and only ties go
on. The ranks of all rounds give the longest common prefix of neighbours in the
array. The deepest LCP interval that holds a suffix is the longest repeat that
begins there; the union of these spans is what maximal repeats cover.

Defined results: null or empty text has no words and fails the base rule; ties
and repeated rows are judged row by row; null ids pass through; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .runtime import texts_of
from .words import SPACE_WORDS, mix, span_hashes, text_chunks, word_spans

#: The method's limits: repeats of at least so many words count, may cover this
#: share of the words, and may be so long.
MIN_REPEAT, MAX_COVERED, MAX_LONGEST = 10, 0.25, 200

_ROW = np.uint64(0xD6E8FEB86659FD93)
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def longest_repeats(words: np.ndarray, row: np.ndarray, row_end: np.ndarray) -> np.ndarray:
    """For each word the length of the longest run of words that begins there and
    occurs elsewhere in the same row. row: row of each word; row_end: by word."""
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    _, which, size = np.unique(mix(words + row.astype(np.uint64) * _ROW), return_inverse=True, return_counts=True)
    rank = 1 + (np.cumsum(size) - size)[which]  # 1 + number of smaller ones; 0 stands past the end
    rounds, step = [rank], 1
    tied = np.flatnonzero(size[which] > 1)
    while len(tied):
        ahead = tied + step
        second = np.where(ahead < row_end[tied], rank[np.minimum(ahead, n - 1)], 0)
        first = rank[tied]
        key = first * (n + 2) + second
        order = np.argsort(key, kind="stable")
        key, first = key[order], first[order]
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        group = np.ones(len(key), dtype=bool)
        group[1:] = first[1:] != first[:-1]
        at = np.arange(len(key))
        begin = np.maximum.accumulate(np.where(fresh, at, 0))
        rank = rank.copy()
        rank[tied[order]] = first + begin - np.maximum.accumulate(np.where(group, at, 0))
        more = ~fresh
        more[:-1] |= ~fresh[1:]
        tied = tied[order][more]
        rounds.append(rank)
        step *= 2
    suffixes = np.argsort(rank)
    a, b = suffixes[:-1], suffixes[1:]
    # only neighbours that share their first word share anything
    pair = np.flatnonzero(rounds[0][a] == rounds[0][b])
    a, b = a[pair], b[pair]
    lcp = np.zeros(len(pair), dtype=np.int64)
    for r in range(len(rounds) - 1, -1, -1):
        i, j = a + lcp, b + lcp
        inside = (i < row_end[a]) & (j < row_end[b])
        same = inside & (rounds[r][np.minimum(i, n - 1)] == rounds[r][np.minimum(j, n - 1)])
        lcp += same.astype(np.int64) << r
    best = np.zeros(n, dtype=np.int64)
    np.maximum.at(best, a, lcp)
    np.maximum.at(best, b, lcp)
    return best


def covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n places the spans cover."""
    d = np.zeros(n + 1, dtype=np.int64)
    np.add.at(d, start, 1)
    np.add.at(d, start + length, -1)
    return np.cumsum(d[:n]) > 0


def by_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of flags between row offsets."""
    c = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return c[off[1:]] - c[off[:-1]]


def duplicate_lines(data: np.ndarray, off: np.ndarray, has_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By row: lines with a word, and those of them equal to an earlier line."""
    rows, n = len(off) - 1, len(data)
    if n == 0:
        return np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    brk = data == 0x0A
    start, end, _ = word_spans(data, off, np.array([b != 0x0A for b in range(256)]))
    words = np.concatenate(([0], np.cumsum(has_word & ~brk, dtype=np.int64)))
    live = words[end] > words[start]
    start, end = start[live], end[live]
    row = np.searchsorted(off, start, side="right") - 1
    # a row without bytes shares its offset with the next; the last such row is the line's own
    lines = np.bincount(row, minlength=rows)
    _, first = np.unique(mix(span_hashes(data, start, end) + row.astype(np.uint64) * _ROW), return_index=True)
    return lines, lines - np.bincount(row[first], minlength=rows)


def measures(data: np.ndarray, off: np.ndarray, min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """Counts of each row of a run of texts."""
    start, end, first = word_spans(data, off, SPACE_WORDS)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(n_words)), n_words)
    best = longest_repeats(span_hashes(data, start, end), row, first[1:][row])
    n = len(start)
    five, long = np.flatnonzero(best >= 5), np.flatnonzero(best >= min_repeat)
    in_word = SPACE_WORDS[data]
    longest = np.zeros(len(n_words), dtype=np.int64)
    np.maximum.at(longest, row, best)
    return {
        "n_words": n_words,
        "word_chars": by_row(in_word & ((data & 0xC0) != 0x80), off),
        "n_symbols": by_row(_SYMBOL[data], off),
        "n_dup_lines": duplicate_lines(data, off, in_word)[1],
        "n_repeat_words": by_row(covered(five, np.full(len(five), 5), n), first),
        "covered_words": by_row(covered(long, best[long], n), first),
        "longest_repeat": longest,
    }


def verdict(m: dict[str, np.ndarray], max_covered: float = MAX_COVERED,
            max_longest: int = MAX_LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) by row of measures."""
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    return failed, ~failed & (m["covered_words"] <= max_covered * m["n_words"]) & (m["longest_repeat"] <= max_longest)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that the rules keep."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            kept = [np.zeros(0, dtype=bool)]
            for _, _, data, off in text_chunks(b.column(at)):
                kept.append(verdict(measures(data, off))[1])
            yield b.filter(pa.array(np.concatenate(kept)))

    # under plain names meanwhile: Python functions do not take columns with a dot in their name
    plain = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema)])
    return docs.toDF(*plain.names).mapInArrow(run, plain).toDF(*docs.columns)


def quality_rules(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
                  max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row a document: the counts, base_failed, and kept."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]

    def run(batches):
        for b in batches:
            for lo, hi, data, off in text_chunks(b.column(1)):
                m = measures(data, off, min_repeat)
                failed, kept = verdict(m, max_covered, max_longest)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), *(pa.array(m[k]) for k in names),
                                       pa.array(failed), pa.array(kept)], ["doc_id", *names, "base_failed", "kept"])

    d = texts_of(docs)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, "
                             + ", ".join(f"{k} long" for k in names) + ", base_failed boolean, kept boolean")
