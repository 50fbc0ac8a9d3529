"""Hashes of spans: no structured collisions; exact piece caches whatever the hash."""
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from eventide.llm import bpe, idpack, jaccard, pieces, repetition, words

RANKS_PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(open(RANKS_PATH, "rb").read())
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def thue_morse(n, letters="ab"):
    s = letters[0]
    swap = str.maketrans(letters, letters[::-1])
    while len(s) < n:
        s += s.translate(swap)
    return s, s.translate(swap)


def periodic():
    """Texts of one long word each: Thue-Morse strings and complements, periods, runs."""
    out = []
    for n in (1024, 2048, 4096):
        out += thue_morse(n) + thue_morse(n, "qz")
    out += [("ab" * n, "ba" * n) for n in (512, 1000)][0]
    out += ["a" * n for n in (1023, 1024, 1025)] + ["abc" * 400, "bca" * 400, "cab" * 400]
    return out


def test_periodic_words_have_different_hashes():
    texts = [t.encode() for t in periodic()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    off = np.cumsum([0, *map(len, texts)])
    h = words.span_hashes(data, off[:-1], off[1:])
    assert len(set(h.tolist())) == len(texts)
    # the same word has the same hash wherever it stands
    moved = np.frombuffer(b"xyz" + data.tobytes(), np.uint8)
    assert words.span_hashes(moved, off[:-1] + 3, off[1:] + 3).tolist() == h.tolist()


def test_many_random_spans_do_not_collide():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 123, 3_000_000).astype(np.uint8)
    start = np.arange(0, len(data) - 12, 6)
    end = start + 6 + np.arange(len(start)) % 7
    h = words.span_hashes(data, start, end)
    distinct = {data[i:j].tobytes() for i, j in zip(start.tolist(), end.tolist())}
    assert len(np.unique(h)) == len(distinct)


def test_op6_and_op2_of_periodic_words(frame):
    rows = list(enumerate(periodic()))
    out = bpe.digests(frame(rows), RANKS_PATH, P.PATTERN).collect()
    for r in out:
        ids = ENC.encode_ordinary(rows[r["doc_id"]][1])
        assert r["decoded_sha256"] == hashlib.sha256(rows[r["doc_id"]][1].encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_op3_and_op8_of_periodic_words(frame):
    rows = list(enumerate(periodic()))
    got = jaccard.jaccard_components(frame(rows)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got)
    both = thue_morse(1024)
    text = " ".join([*both, "x", "y", "z", both[1], both[0], "x", "y", "z"])
    r = repetition.quality_rules(frame([(1, text)])).first()
    assert r["n_repeat_words"] == 0


@pytest.mark.parametrize("shift", [0, 60])
def test_piece_cache_is_exact_whatever_the_hash(monkeypatch, shift):
    """Hashes of four bits, then of none at all: ids stay those of the library."""
    real = words.span_hashes
    monkeypatch.setattr(pieces, "span_hashes", lambda *a: real(*a) >> np.uint64(shift))
    rng = random.Random(1)
    vocab = bpe.Vocabulary(RANKS)
    cache = pieces.PieceCache(lambda p: bpe.encode_pieces(vocab, p), limit=50)
    cut = pieces.compiled(P.PATTERN)
    for _ in range(20):
        texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "x" * rng.randrange(1, 9), "1 2", "é"]) for _ in range(rng.randrange(30)))
                 for _ in range(5)]
        raw = [t.encode() for t in texts]
        off = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
        ids, at = cache.rows(np.frombuffer(b"".join(raw), np.uint8), off, cut)
        assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == [ENC.encode_ordinary(t) for t in texts]
    assert idpack.bits_for(50257) == 16
