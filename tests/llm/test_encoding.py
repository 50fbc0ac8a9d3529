"""Operators 2 and 6 against the tokenizer libraries themselves."""
import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventide.llm import bpe, idpack
from eventide.llm.pieces import PieceCache, compiled, piece_starts
from eventide.llm.queries import op2_idpack, op6_bpe

from .conftest import EDGE

RANKS = bpe.read_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read())
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
VOCAB = bpe.Vocabulary(RANKS)
TEXT = st.text(alphabet=st.one_of(st.sampled_from("aabcdestlrvm'' \n\t 019.,!éßñ×÷"), st.characters(codec="utf-8")), max_size=60)


def library():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_pieces_and_ids_equal_the_library(rows):
    raw = [r.encode() for r in rows]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    cut = compiled(P.PATTERN)
    ids, at = PieceCache(lambda p: bpe.encode_pieces(VOCAB, p)).rows(data, off, cut)
    for k, r in enumerate(rows):
        assert ids[at[k]:at[k + 1]].tolist() == ENC.encode_ordinary(r)
    starts = set(piece_starts(data, off, cut).tolist())
    want = set()
    for r, o in zip(rows, off.tolist()):
        for m in cut.findall(r):
            want.add(o)
            o += len(m.encode())
    assert starts == want


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=12), st.integers(0, 40), st.integers(0, 5))
def test_prefix_table_append_and_edit(text, more, at, removed):
    single = lambda b: ENC._core_bpe.encode_single_piece(b) if b else []
    t = bpe.PrefixTable(VOCAB, text)
    assert t.ids() == single(text)
    assert all(t.ids(k) == single(text[:k]) for k in range(len(text) + 1))
    t.append(more)
    assert t.ids() == single(text + more)
    at = min(at, len(text + more))
    t.edit(at, removed, b"the")
    assert t.text == (text + more)[:at] + b"the" + (text + more)[at + removed:]
    assert t.ids() == single(t.text)


def _odd_pieces(n):
    rng = np.random.default_rng(n)
    tokens = list(RANKS)
    out = [rng.integers(0, 256, rng.integers(1, 30)).astype(np.uint8).tobytes() for _ in range(n)]
    out += [b"".join(tokens[i] for i in rng.integers(0, len(tokens), 4)) for _ in range(n)]
    return out + [b"x" * 900, b" " * 300, b"ab" * 200, "漢字仮名".encode() * 20, b"a", b"the" * 100, b""]


@pytest.mark.parametrize("n", [2, 20, 800])
def test_pieces_of_all_lengths_equal_the_library(n):
    pieces = _odd_pieces(n)
    want = [ENC._core_bpe.encode_single_piece(p) if p else [] for p in pieces]
    assert bpe.encode_pieces(VOCAB, pieces) == want


def test_blocks_of_bytes_equal_the_library(monkeypatch):
    monkeypatch.setattr(bpe, "_BLOCK", 700)
    pieces = _odd_pieces(100)
    want = [ENC._core_bpe.encode_single_piece(p) if p else [] for p in pieces]
    assert bpe.encode_pieces(bpe.Vocabulary(RANKS), pieces) == want


def test_new_pieces_are_filled_together(monkeypatch):
    """Thousands of new pieces make no table, and hardly a border check, each."""
    pieces = [b"zq%dxk%d" % (k, k * k) for k in range(3000)]
    want = [ENC._core_bpe.encode_single_piece(p) for p in pieces]
    calls = []
    for kind, name in ((bpe.PrefixTable, "__init__"), (bpe.Vocabulary, "neighbours")):
        real = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda *a, real=real: calls.append(0) or real(*a))
    assert bpe.encode_pieces(VOCAB, pieces) == want
    assert len(calls) < len(pieces) / 2


def test_array_borders_equal_the_chains():
    rng = np.random.default_rng(3)
    ids = np.array(list(RANKS.values()))
    left, right = rng.choice(ids, (2, 4000))
    # the two parts of a token merge, so they are no neighbours
    halves = [VOCAB.halves(int(t)) for t in rng.choice(ids, 1000)]
    left = np.concatenate((left, [h[0] for h in halves if h]))
    right = np.concatenate((right, [h[1] for h in halves if h]))
    want = [VOCAB.neighbours(a, b) for a, b in zip(left.tolist(), right.tolist())]
    assert 1000 < sum(want) < len(want)
    for _ in range(2):  # answers as made, then as held
        VOCAB._make_tables()
        assert VOCAB.neighbours_of(left, right).tolist() == want


def test_vocabulary_without_a_byte_is_an_error():
    vocab = bpe.Vocabulary({b"a": 0, b"b": 1, b"ab": 2})
    assert bpe.encode_pieces(vocab, [b"abb"] * 60 + [b"ba"]) == [[2, 1]] * 60 + [[1, 0]]
    for n in (1, 60):
        with pytest.raises(ValueError, match="lacks a byte"):
            bpe.encode_pieces(vocab, [b"abc"] * n)


def test_cache_of_bounded_size_gives_the_same_ids():
    cache = PieceCache(lambda p: bpe.encode_pieces(VOCAB, p), limit=3)
    for text in ("a b c d e", "c d e f g", "a b"):
        raw = text.encode()
        ids, _ = cache.rows(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), compiled(P.PATTERN))
        assert ids.tolist() == ENC.encode_ordinary(text)


def test_op6_whole_table(spark, sf, texts):
    got = {r["doc_id"]: r for r in op6_bpe(spark, sf).collect()}
    assert len(got) == len(texts)
    for d, t in texts.items():
        ids = ENC.encode_ordinary(t)
        assert got[d]["n_tokens"] == len(ids)
        assert got[d]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[d]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_encode_and_decode_edges(edge, nothing):
    path = P.path("byte_bpe_50k.tiktoken")
    enc = bpe.encode(edge, path, P.PATTERN)
    rows = sorted((r["doc_id"] or -1, r["ids"]) for r in enc.collect())
    assert rows == sorted((d or -1, ENC.encode_ordinary(t or "")) for d, t in EDGE)
    back = sorted((r["doc_id"] or -1, bytes(r["text_bytes"]).decode()) for r in bpe.decode(enc, path).collect())
    assert back == sorted((d or -1, t or "") for d, t in EDGE)
    assert bpe.digests(edge, path, P.PATTERN).count() == len(EDGE)
    assert bpe.digests(nothing, path, P.PATTERN).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 24, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    raw = idpack.pack(ids, bits)
    assert len(raw) == -(-1001 * bits // 8)
    assert idpack.unpack(raw, 1001, bits).tolist() == ids.tolist()


def test_shard_random_access(temp):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 5000, n, dtype=np.uint32) for n in (0, 3, 700, 1, 64, 65, 0, 129)]
    uri = f"file://{temp}/one.ids"
    w = idpack.ShardWriter(uri, idpack.bits_for(5000), block=64)
    for k, d in enumerate(docs):
        w.add(None if k == 2 else k, d)
    w.close()
    r = idpack.ShardReader(uri)
    assert r.bits == 13 and r.n_docs == len(docs)
    assert r.names.to_pylist() == [0, 1, None, 3, 4, 5, 6, 7]
    for k, d in enumerate(docs):
        assert r.document(k).tolist() == d.tolist()
    whole = np.concatenate(docs)
    for lo, n in ((0, 1), (63, 2), (100, 300), (len(whole) - 1, 1)):
        assert r.ids(lo, n).tolist() == whole[lo:lo + n].tolist()


def _expected(rows):
    t, start, out = library(), 0, []
    for d, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op2_whole_table(spark, sf, texts):
    got = sorted(map(tuple, op2_idpack(spark, sf).collect()))
    assert got == _expected(texts.items())


def test_op2_edges(spark, edge, nothing):
    out, manifest = idpack.write_shards(edge, P.path("byte_bpe_50k.json"), P.PATTERN, 2)
    got = sorted(map(tuple, idpack.read_documents(spark, out, manifest).collect()), key=lambda r: r[1])
    assert got == _expected(EDGE)
    out, manifest = idpack.write_shards(nothing, P.path("byte_bpe_50k.json"), P.PATTERN, 2)
    assert idpack.read_documents(spark, out, manifest).count() == 0


def test_special_strings_are_ordinary_text(spark, frame):
    rows = [(1, "a<|endoftext|>b")]
    out, manifest = idpack.write_shards(frame(rows), P.path("byte_bpe_50k.json"), P.PATTERN, 2)
    assert [tuple(r) for r in idpack.read_documents(spark, out, manifest).collect()] == _expected(rows)


def test_ranks_file_holds_all_bytes():
    assert all(bytes([b]) in RANKS for b in range(256))
    assert base64.b64decode(base64.b64encode(b"a")) == b"a"
