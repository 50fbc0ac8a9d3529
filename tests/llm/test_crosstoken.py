"""Operator 12 against both libraries and plain loops over every byte."""
import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers as P
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventide.llm import crosstoken
from eventide.llm.queries import op12_crosstoken

from .conftest import EDGE

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
LIB_A = Tokenizer.from_file(A_PATH)
LIB_A.encode_special_tokens = True
LIB_B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
LETTER = crosstoken._byte_letters()
STRANGE = [(20, "tabs\tand\nlines \n\n  spaces   "), (21, "▁ low line"), (22, "<|endoftext|> <s> </s> <unk>"), (23, "日本語のテキスト 🙂🙂 é"),
           (24, " "), (25, "a\x00b\x7f"), (26, "ﬁ ½ Ⅷ Å"), (27, "x" * 3000 + " " * 500)]


def a_bytes(i):
    return bytes(LETTER[c] for c in LIB_A.id_to_token(i))


def b_bytes(i):
    return bytes([int(LIB_B.id_to_piece(i)[3:5], 16)]) if LIB_B.is_byte(i) else LIB_B.id_to_piece(i).replace("▁", " ").encode()


def one(text):
    """(A ids, B ids, groups, links) of a text; None without tokens."""
    if not text:
        return None
    a, b = LIB_A.encode(" " + text, add_special_tokens=False).ids, LIB_B.encode(text)
    ba, bb = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
    if not b"".join(ba) == b"".join(bb) == (" " + text).encode():
        return None
    ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
    common = sorted(set(ea) & set(eb))
    groups = [([], []) for _ in common]
    for side, ids, ends in ((0, a, ea), (1, b, eb)):
        for x, e in zip(ids, ends):
            groups[bisect_left(common, e)][side].append(x)
    at_b = dict(zip(eb, b))
    return a, b, groups, [(x, at_b[e]) for x, e in zip(a, ea) if e in at_b]


def brute(rows):
    made = [(d, one(t)) for d, t in rows]
    count = Counter(p for _, m in made if m for p in m[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = Counter()
    for d, m in made:
        if m is None:
            out[d, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        a, b, groups, links = m
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[d, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(written.encode()).hexdigest()] += 1
    return out


def digests(df, **options):
    out = crosstoken.alignment_digests(df, A_PATH, P.PATTERN, B_PATH, **options)
    return Counter(tuple(r) for r in out.select(*crosstoken._OUT).collect())


def test_whole_table(spark, sf, texts):
    got = Counter(tuple(r) for r in op12_crosstoken(spark, sf).select(*crosstoken._OUT).collect())
    assert got == brute(texts.items())


def test_edges_and_small_blocks(frame):
    rows = EDGE + STRANGE + [(30, EDGE[0][1]), (None, "one")]
    want = brute(rows)
    assert digests(frame(rows)) == want
    assert digests(frame(rows).repartition(3), block_bytes=50) == want


def test_empty_table(nothing):
    assert digests(nothing) == Counter()


def test_aligned_documents(frame):
    rows = [(1, "Hello tokenizers, naïve café"), (2, None), (3, "ﬁ"), (4, "日本")]
    out = {r["doc_id"]: r for r in crosstoken.aligned_documents(frame(rows), A_PATH, P.PATTERN, B_PATH).collect()}
    for d, t in rows:
        m, r = one(t), out[d]
        if m is None:
            assert r["a_ids"] == r["b_ids"] == r["overlaps"] == [] and r["groups"] == ""
            continue
        assert r["a_ids"] == m[0] and r["b_ids"] == m[1]
        covers = [np.repeat(np.arange(len(ids)), [len(f(i)) for i in ids]) for ids, f in ((m[0], a_bytes), (m[1], b_bytes))]
        want = Counter(zip(covers[0].tolist(), covers[1].tolist()))
        assert {(x["a"], x["b"]): x["bytes"] for x in r["overlaps"]} == want
        assert [(m[0][x["a"]], m[1][x["b"]]) for x in r["overlaps"] if x["ends"]] == m[3]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), st.randoms())
def test_links_of_random_cuts(sizes, random):
    total = sum(sizes)
    cuts = sorted(random.sample(range(1, total), random.randint(0, total - 1))) if total > 1 else []
    other = np.diff([0, *cuts, total])
    x = crosstoken.align(np.array(sizes), other)
    a, b = np.repeat(np.arange(len(sizes)), sizes).tolist(), np.repeat(np.arange(len(other)), other).tolist()
    assert Counter(zip(a, b)) == {(i, j): n for i, j, n in zip(x.a.tolist(), x.b.tolist(), x.shared.tolist())}
    ends_a, ends_b = np.cumsum(sizes).tolist(), np.cumsum(other).tolist()
    assert [(x.a[k], x.b[k]) for k in x.ends] == [(i, ends_b.index(e)) for i, e in enumerate(ends_a) if e in ends_b]
    common = sorted(set(ends_a) & set(ends_b))
    group = lambda e: next(k for k, c in enumerate(common) if e <= c)
    assert x.group_a.tolist() == [group(e) for e in ends_a] and x.group_b.tolist() == [group(e) for e in ends_b]
    pairs = {(i, j) for s, t in x.shared_group_links() for i, j in zip(s.tolist(), t.tolist())}
    assert pairs == {(i, j) for i, e in enumerate(ends_a) for j, f in enumerate(ends_b) if group(e) == group(f)}


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 6), st.integers(1, 6), st.integers(1, 6), st.integers(0, 2**32 - 1))
def test_row_products_of_any_matrices(n, m, k, seed):
    r = np.random.default_rng(seed)
    x, y = r.integers(0, 2, (n, m)), r.integers(0, 2, (m, k))
    csr = lambda z: (np.concatenate(([0], np.cumsum(z.sum(axis=1)))), np.nonzero(z)[1])
    i, j, v = crosstoken.row_products(*csr(x), *csr(y), k)
    out = np.zeros((n, k), int)
    out[i, j] = v
    assert (out == x @ y).all()
    ptr, col = crosstoken.transposed(*csr(x), m)
    assert ptr.tolist() == csr(x.T)[0].tolist() and col.tolist() == csr(x.T)[1].tolist()
