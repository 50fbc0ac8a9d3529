"""Operators 3 and 4, components and the pipeline against plain Python."""
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventide.llm import chunkdedup, jaccard
from eventide.llm.components import connected_components
from eventide.llm.queries import op3_jaccard, op4_chunkdedup
from eventide.llm.runtime import stored

from .conftest import EDGE

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = SPACED.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    """(doc_id, set size, smallest doc_id reachable) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= 75 * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)]


def key(r):
    return tuple((x is not None, x or 0) for x in r)


def same(df, rows):
    got = sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=key)
    assert got == sorted(components(rows), key=key)


def link_counts(rows):
    """(doc_id, documents linked to it, different sets linked to its own) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    holders, out = {}, []
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in holders[x]:
                if j != i:
                    common[j] = common.get(j, 0) + 1
        hit = [j for j, c in common.items() if 100 * c >= 75 * (len(s) + len(sets[j]) - c)]
        out.append((rows[i][0], len(hit), len({sets[j] for j in hit} - {s})))
    return out


def same_links(df, rows):
    got = sorted((tuple(r) for r in df.select("doc_id", "n_links", "n_linked_sets").collect()), key=key)
    assert got == sorted(link_counts(rows), key=key)


def test_op3_whole_table(spark, sf, texts):
    out = op3_jaccard(spark, sf)
    same(out, list(texts.items()))
    same_links(out, list(texts.items()))


@pytest.mark.parametrize("seed,block", [(0, 1024), (1, 4), (2, 11)])
def test_op3_links_of_families_and_chains(frame, seed, block):
    """Links inside components that are no cliques, in blocks smaller than a family,
    with copies, bands of sizes and sets far from the leader."""
    rng = random.Random(seed)
    rows = family(rng, 30, 6) + family(rng, 20, 2, 12, 100)
    chain = [f"c{i}" for i in range(150)]
    rows += [(200 + i, " ".join(chain[5 * i:5 * i + 60])) for i in range(15)]
    grow = [f"g{i}" for i in range(120)]
    rows += [(300 + i, " ".join(grow[:20 + 4 * i])) for i in range(25)]
    rows += [(400 + i, rows[rng.randrange(len(rows))][1]) for i in range(30)] + [(500, ""), (501, None), (None, rows[0][1]), (502, "one")]
    rng.shuffle(rows)
    out = jaccard.jaccard_join(frame(rows), block=block)
    same_links(out, rows)
    same(out, rows)


def test_op3_common_counts():
    rng = np.random.default_rng(2)
    for _ in range(20):
        pool = np.sort(rng.integers(0, 1 << 63, rng.integers(1, 60), dtype=np.uint64))
        one, two = ([np.unique(rng.choice(pool, rng.integers(0, 40))) for _ in range(rng.integers(1, 90))] for _ in "ab")
        got = jaccard._common([x.tobytes() for x in one], [x.tobytes() for x in two])
        assert got.tolist() == [[len(np.intersect1d(x, y)) for y in two] for x in one]


def test_op3_edges(edge, nothing):
    same(jaccard.jaccard_components(edge), EDGE)
    assert jaccard.jaccard_components(nothing).count() == 0
    same_links(jaccard.jaccard_join(edge), EDGE)
    assert jaccard.jaccard_join(nothing).count() == 0


def test_op3_ids_of_any_type(spark):
    rows = [("b", "one two three four five six"), ("a", "one two three four five six"), ("c", "other"), (None, "other")]
    out = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted((r["doc_id"] or "", r["component_id"], r["n_links"]) for r in out) == [("", "c", 1), ("a", "a", 1), ("b", "a", 1), ("c", "c", 1)]


def family(rng, n, edits, words=60, at=0):
    """n texts that differ from one original in a few words each."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append((at + i, " ".join(w)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_op3_families_chains_and_ties(frame, seed, monkeypatch):
    """Near copies around the limit, chains of links, shared passages, small
    blocks and a sketch that tells almost nothing apart."""
    rng = random.Random(seed)
    rows = family(rng, 40, 4) + family(rng, 30, 2, 12, 100)
    chain = [f"c{i}" for i in range(200)]
    rows += [(200 + i, " ".join(chain[5 * i:5 * i + 60])) for i in range(25)]
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(300 + i, passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(40)))) for i in range(40)]
    rows += [(400 + i, "a b c " * (i + 1)) for i in range(6)]
    rng.shuffle(rows)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    if seed == 1:
        monkeypatch.setattr(jaccard, "LEADERS", 1)
    same(jaccard.jaccard_components(frame(rows), sketch_bits=[18, 4, 1][seed]), rows)


def test_exact_limit(frame):
    # 7 shingles against 7 with 6 in common: 6 / 8 = 0.75 links; 5 / 9 does not
    a = "a b c d e f g h i j k".split()
    rows = [(1, " ".join(a)), (2, " ".join(a[:-1] + ["z"])), (5, " ".join(["y", *a[1:-1], "q"]))]
    same(jaccard.jaccard_components(frame(rows)), rows)
    assert sorted(c for _, _, c in components(rows)) == [1, 1, 5]


def test_bit_map_bounds_the_overlap():
    rng = np.random.default_rng(0)
    for _ in range(50):
        pool = rng.integers(0, 1 << 63, rng.integers(3, 900), dtype=np.uint64)
        x, y = (np.unique(rng.choice(pool, rng.integers(1, 900))) for _ in "ab")
        differ = jaccard.bits_differ(*(np.frombuffer(jaccard.set_bits(s), np.uint8) for s in (x, y)))
        both = len(np.intersect1d(x, y))
        assert len(x) + len(y) - differ >= 2 * both
        assert jaccard.may_link(len(x), len(y), differ) or not jaccard.linked(len(x), len(y), both)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000 + i, 5000 + i // 2) for i in range(1, 64)]
    nodes = {x: (0 if x <= 100 else 1000 if x < 5000 else 5000) for e in edges for x in e}
    name = {x: rng.randrange(-10**9, 10**9) for x in nodes}
    least = {}
    for x, c in nodes.items():
        least[c] = min(least.get(c, 10**10), name[x])
    df = spark.createDataFrame([(name[a], name[b]) for a, b in edges], "u long, v long")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert got == {name[x]: least[c] for x, c in nodes.items() if name[x] != least[c]}
    assert connected_components(df.limit(0)).count() == 0


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_op4_passages_go_and_clean_texts_stay(frame):
    rng = random.Random(3)
    passages = [prose(rng, 55) for _ in range(40)]
    line = prose(rng, 9)
    rows, planted = [], {}
    for i in range(400):
        parts = [line, prose(rng, rng.randrange(30, 200))]
        if i % 2:
            p = rng.randrange(40)
            planted[i] = p
            parts.insert(rng.randrange(3), passages[p])
        rows.append((i, "\n".join(parts) if i % 3 else " ".join(parts)))
    got = {r["doc_id"]: r for r in chunkdedup.dedup_substrings(frame(rows)).select("doc.*", "text", "n_removed", "n_bytes", "spans").collect()}
    first = {}
    for i, p in planted.items():
        first.setdefault(p, i)
    removed = [i for i in got if got[i]["n_removed"]]
    later = {i for i, p in planted.items() if first[p] != i}
    assert set(removed) <= later  # first occurrences and clean documents are left alone
    assert len(removed) >= 0.98 * len(later)
    assert got[0]["th"] == "x"
    for d, t in rows:
        raw, keep = t.encode(), np.ones(len(t.encode()), bool)
        for s in got[d]["spans"]:
            keep[s["begin"]:s["end"]] = False
        assert got[d]["text"] == bytes(np.frombuffer(raw, np.uint8)[keep]).decode()
        assert got[d]["n_bytes"] == len(raw) and got[d]["n_removed"] == int((~keep).sum())


def test_chunks_resist_shifts():
    rng = random.Random(8)
    text = prose(rng, 500).encode()
    moved = b"something new, " + text

    def chunks(raw):
        s = chunkdedup.chunk_starts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).tolist()
        return {raw[a:b] for a, b in zip(s, [*s[1:], len(raw)])}
    assert len(chunks(text) - chunks(moved)) <= 2
    s = chunkdedup.chunk_starts(np.frombuffer(text + text, np.uint8), np.array([0, len(text), 2 * len(text)]))
    half = s[s < len(text)]
    assert (s[len(half):] - len(text)).tolist() == half.tolist()


def test_op4_whole_table(spark, sf, texts):
    from .test_passages import brute
    want = brute([(d, t or "") for d, t in texts.items()])
    got = {r["doc_id"]: r for r in op4_chunkdedup(spark, sf).collect()}
    assert {d: [tuple(x) for x in r["spans"]] for d, r in got.items()} == want and any(want.values())
    assert all(r["n_removed"] == sum(y - x for x, y in want[d]) and r["n_spans"] == len(want[d]) for d, r in got.items())


def test_op4_edges(edge, nothing):
    got = chunkdedup.dedup_substrings(edge).select("doc.doc_id", "text", "n_removed").collect()
    assert len(got) == len(EDGE)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["text"] == "" and by[4]["text"] == "one" and by[None]["n_removed"] == 0
    assert chunkdedup.dedup_substrings(nothing).count() == 0
    # a document that repeats as a whole row is one document; another id with its text is a repeat
    rng = random.Random(1)
    long = prose(rng, 100)
    again = edge.sparkSession.createDataFrame([(1, long), (1, long), (2, long)], "doc_id long, text string")
    got = sorted((r["doc"]["doc_id"], len(r["text"])) for r in chunkdedup.dedup_substrings(again).collect())
    assert got == [(1, len(long)), (1, len(long)), (2, 0)]


def test_pipeline_stage_by_stage(spark, sf, texts):
    """Every stage against brute force on its own input."""
    from .test_passages import brute
    from .test_text_rules import rules, scan
    import pyarrow.parquet as pq
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    inputs, outputs = [], []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        inputs.append({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
        docs = stored(f(spark, docs, sf), f"test-stage{k}")
        assert k == 4 or docs.columns == columns
        outputs.append({r["doc_id"]: r for r in docs.collect()})
    good = {d for d, t in inputs[0].items() if not rules(t)[-1]}
    assert outputs[0].keys() <= good and len(outputs[0]) >= 0.99 * len(good)
    assert set(outputs[1]) == {d for d, _, c in components(list(inputs[1].items())) if d == c}
    lost = {d: sum(y - x for x, y in spans) for d, spans in brute(list(inputs[2].items())).items()}
    assert set(outputs[2]) >= {d for d in inputs[2] if not lost[d]}
    assert all(len(r["text"].encode()) == len(inputs[2][d].encode()) - lost[d] for d, r in outputs[2].items())
    assert all(r["n_chars"] == len(r["text"]) for d, r in outputs[2].items() if lost[d])
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    from .test_text_rules import LOW as low, PLAIN, windows_of
    wins = {v for _, t in items for v in windows_of(PLAIN.findall(t.translate(low)))}
    def leaks(t):
        w = PLAIN.findall(t.translate(low))
        return any(tuple(w[i:i + 10]) in wins for i in range(len(w)))
    assert set(outputs[3]) == {d for d, t in inputs[3].items() if not leaks(t)}
    assert set(outputs[4]) == set(inputs[4])
    assert scan("a", [(1, "a")])[1] == 1
    assert corpus_pipeline.run(spark, sf).count() == len(outputs[4])


def test_spark_frames_keep_their_columns(frame):
    df = frame([(1, "one two three four five six seven eight nine ten eleven")])
    assert corpus_pipeline.repetition.keep_good(df).select("token").first()[0] == "x"
    assert df.where(F.col("n") == "x").count() == 1
