"""Operator 4: only passages that stand contiguously in one earlier place go."""
import random

import numpy as np

from eventide.llm import chunkdedup

from .test_dedup import prose


def borders(raw):
    s = chunkdedup.chunk_starts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).tolist()
    return [*s, len(raw)]


def brute(rows, least=chunkdedup.MIN_RUN):
    """Removed spans of each (doc_id, text): the union of all byte spans between
    two borders, of at least ``least`` bytes, that stand at an earlier place."""
    seen, out = {}, {}
    for d, t in sorted(rows):
        raw = t.encode()
        cut, gone = borders(raw), np.zeros(len(raw) + 2, np.int8)
        for i, a in enumerate(cut):
            for j in range(i + 1, len(cut)):
                if cut[j] - a >= least and seen.setdefault(raw[a:cut[j]], (d, a)) != (d, a):
                    gone[a + 1:cut[j] + 1] = 1
                if cut[j] - a >= 3 * least:
                    break
        step = np.diff(gone)
        out[d] = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))
    return out


def removed(df):
    rows = chunkdedup.dedup_substrings(df).select("doc.doc_id", "spans").collect()
    return {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in rows}


def test_op4_equals_brute_force_on_contiguous_repeats(frame, texts):
    rows = sorted(texts.items())[:400]
    want = brute(rows)
    assert removed(frame(rows)) == want and any(want.values())


def test_op4_text_pieced_together_from_short_phrases_stays(frame):
    rng = random.Random(11)
    phrases = [prose(rng, 12) for _ in range(60)]
    assert max(map(len, phrases)) < chunkdedup.MIN_RUN
    rows = [(i, f"{prose(rng, 20)} {p} {prose(rng, 20)}") for i, p in enumerate(phrases)]
    rows.append((100, " ".join(phrases)))
    rows.append((101, " ".join(phrases[20:40])))  # stands in 100 as a whole
    got = removed(frame(rows))
    assert {d for d, s in got.items() if s} == {101}
    assert sum(b - a for a, b in got[101]) >= 0.9 * len(rows[-1][1])


def unspaced(rng, kind, n):
    """Text of about n bytes without blanks."""
    if kind == "han":
        return "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n // 3))
    if kind == "thai":
        return "".join(chr(rng.randrange(0xE01, 0xE2F)) for _ in range(n // 3))
    return "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))


def test_op4_finds_passages_in_unspaced_text(frame):
    rng = random.Random(12)
    for kind in ("han", "thai", "encoded"):
        planted = [unspaced(rng, kind, 300) for _ in range(100)]
        rows = [(i, unspaced(rng, kind, 600) + p + unspaced(rng, kind, 600)) for i, p in enumerate(planted * 2)]
        got = removed(frame(rows))
        assert not any(got[i] for i in range(100))
        hit = [i for i in range(100, 200) if got[i]]
        assert len(hit) >= 98, kind
        for i in hit:
            at = rows[i][1].encode().index(planted[i - 100].encode())
            assert at <= got[i][0][0] and got[i][-1][1] <= at + len(planted[i - 100].encode())
        # of what can be found, all but the part up to the first and from the last border
        assert sum(b - a for i in hit for a, b in got[i]) >= 0.75 * 300 * len(hit)


def test_borders_of_unspaced_text_are_as_close_as_in_spaced_text():
    rng = random.Random(13)
    for kind in ("han", "thai", "encoded"):
        raw = unspaced(rng, kind, 60000).encode()
        assert 18 <= len(raw) / len(borders(raw)) <= 32, kind
    assert len(borders(b"x" * 70000)) <= 3
