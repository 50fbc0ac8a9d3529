"""Operators 7, 8, 9, 10 against plain Python."""
import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.llm import chat, decontam, licenses, repetition
from eventide.llm.queries import op7_chat, op8_repetition, op9_decontam, op10_licenses

from .conftest import EDGE

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rules(text):
    text = text or ""
    w = SPACED.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    many = Counter(windows)
    hit = {j for i, x in enumerate(windows) if many[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed)


def longest(words):
    n = len(words)
    return [max([next((k for k in range(n) if max(i, j) + k >= n or words[i + k] != words[j + k]), n)
                 for j in range(n) if j != i], default=0) for i in range(n)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=25), max_size=4))
def test_longest_repeats_by_brute_force(rows):
    flat = [w for r in rows for w in r]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ends = np.cumsum([len(r) for r in rows])
    got = repetition.longest_repeats(np.array([ord(w) for w in flat], np.uint64), row, ends[row] if len(rows) else row)
    assert got.tolist() == [x for r in rows for x in longest(r)]


def test_op8_whole_table(spark, sf, texts):
    got = {r["doc_id"]: r for r in op8_repetition(spark, sf).collect()}
    assert len(got) == len(texts)
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for d, t in texts.items():
        assert tuple(got[d][c] for c in cols) == rules(t), d
        assert not (got[d]["kept"] and got[d]["base_failed"])


def test_op8_edges(edge, nothing):
    got = repetition.quality_rules(edge).collect()
    want = sorted(((d if d is not None else -1), *rules(t)) for d, t in EDGE)
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["n_words"], r["word_chars"], r["n_symbols"],
                   r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    assert repetition.quality_rules(nothing).count() == 0


def test_op8_method_limits(frame):
    base = " ".join(f"w{i}" for i in range(4000))
    passage = " ".join(f"p{i}" for i in range(250))
    rows = {1: base, 2: f"{passage} {base} {passage}", 3: f"{base} " + " ".join(f"q{i}" for i in range(50))}
    got = {r["doc_id"]: r for r in repetition.quality_rules(frame(list(rows.items()))).collect()}
    assert got[1]["kept"] and got[3]["kept"]
    assert got[2]["longest_repeat"] == 250 and got[2]["covered_words"] == 500
    assert not got[2]["base_failed"] and not got[2]["kept"]
    kept = repetition.keep_good(frame(list(rows.items())))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3] and "token" in kept.columns


def windows_of(words):
    n = min(10, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def scan(text, items):
    w = PLAIN.findall((text or "").translate(LOW))
    hit, ids = set(), set()
    for name, item in items:
        for v in windows_of(PLAIN.findall((item or "").translate(LOW))):
            for i in range(len(w) - len(v) + 1):
                if tuple(w[i:i + len(v)]) == v:
                    hit |= set(range(i, i + len(v)))
                    ids |= {str(name)} if name is not None else set()
    ids = ",".join(sorted(ids))
    return len(w), len(hit), hashlib.sha256(ids.encode()).hexdigest()


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (12, "two three four five six seven eight nine TEN eleven!"),
         (3, "Short item"), (4, ""), (5, None), (None, "nameless item"), (2, "é漢 ß")]


@pytest.mark.parametrize("max_set", [100_000, 0])
def test_op9_edges_both_ways(frame, spark, max_set):
    rows = [*[(d, t) for d, t in EDGE if d != 6], (20, "say ONE two, three four five six seven eight nine ten eleven twelve"),
            (21, "short item short item"), (21, "short item short item"), (22, "a nameless item"), (23, "x É漢 ß é漢 ß"),
            (24, "one two three four five six seven eight nine")]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_hit"], r["items_sha256"])
                 for r in decontam.contamination(frame(rows), bench, max_set).collect())
    assert got == sorted((d if d is not None else -1, *scan(t, ITEMS)) for d, t in rows)
    kept = decontam.clean_documents(frame(rows), bench)
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == sorted(
        d if d is not None else -1 for d, t in rows if not scan(t, ITEMS)[1])


def test_op9_empty_inputs(frame, nothing, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = decontam.contamination(frame([(1, "a b")]), bench).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in got] == [(2, 0, False)]
    assert decontam.contamination(nothing, bench).count() == 0


def test_op9_is_native_and_removes_spans(spark, sf, frame):
    plan = op9_decontam(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = frame([(1, "Keep this. Short item! And this"), (2, "short item"), (3, "nothing here")])
    hits = decontam.find_hits(df, bench)
    got = {r["doc_id"]: r["t"] for r in df.select("doc_id", "text").join(hits, "doc_id")
           .select("doc_id", decontam.without_spans(F.col("text"), F.col("hit_words")).alias("t")).collect()}
    assert got == {1: "Keep this. ! And this", 2: "", 3: "nothing here"}


def base_phrases(text):
    w = PLAIN.findall((text or "").translate(LOW))
    at = [(i, name) for phrase, name in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
          for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in at]
    return (len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({n for _, n in at})))


def test_op10_whole_table(spark, sf, texts):
    got = {r["doc_id"]: r for r in op10_licenses(spark, sf).collect()}
    assert len(got) == len(texts)
    for d, t in texts.items():
        r = got[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base_phrases(t)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_op10_edges(edge, nothing, frame):
    rows = [*EDGE, (30, "MIT License, mit-license; Apache  LICENSE\nGNU General Public License"), (31, "mit licenses"),
            (32, "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0 WITH LLVM-exception")]
    got = {(r["doc_id"], r["n_words"]): r for r in licenses.license_scan(frame(rows)).collect()}
    for d, t in rows:
        want = base_phrases(t)
        r = got[d, want[0]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want
    spdx = got[32, base_phrases(rows[-1][1])[0]]
    assert spdx["labels"] == "permissive,spdx:apache-2.0,spdx:gpl-2.0-only,spdx:mit" and spdx["score"] == 0.9
    assert licenses.license_scan(nothing).count() == 0
    assert licenses.license_scan(edge).count() == len(EDGE)


def test_op10_score_and_labels_of_each_kind(frame):
    """Against the weights and the table of the docstring, one kind of evidence at a time."""
    tag = "SPDX-License-Identifier: "
    cases = {"MIT License": ("mit", 0.6), "all rights reserved": ("notice:rights-reserved", 0.3), tag + "ISC": ("permissive,spdx:isc", 0.9),
             tag + "NONE": ("spdx:none,unknown", 0.4), tag + "LicenseRef-A": ("spdx:licenseref-a,unknown", 0.4),
             tag + "see the file": ("bad-expression", 0.2), "Apache License " + tag + "Apache-2.0": ("apache,permissive,spdx:apache-2.0", 0.96),
             "BSD license, provided as is": ("notice:as-is,notice:bsd", 0.51), "no licence": ("", 0.0)}
    got = {r["doc_id"]: r for r in licenses.license_scan(frame(list(enumerate(cases)))).collect()}
    for k, want in enumerate(cases.values()):
        assert (got[k]["labels"], got[k]["score"]) == want


def test_op10_places_of_many_hits_in_linear_time(frame):
    import time
    text = "é x mit license, " * 60000
    start = time.perf_counter()
    r = licenses.license_scan(frame([(1, text)])).first()
    assert (r["n_base"], r["first_word"], r["last_word"]) == (60000, 2, 4 * 60000 - 2) and time.perf_counter() - start < 10


def test_expressions():
    p = licenses.parse_expression
    assert p("MIT OR GPL-2.0 AND Apache-2.0") == ["MIT", "GPL-2.0", "Apache-2.0", "and", "or"]
    assert p("(MIT OR GPL-2.0) AND ISC") == ["MIT", "GPL-2.0", "or", "ISC", "and"]
    assert p("GPL-2.0 WITH Classpath-exception-2.0 OR MIT") == ["GPL-2.0", "Classpath-exception-2.0", "with", "MIT", "or"]
    assert p("MIT -->") == ["MIT"] and p("MIT */") == ["MIT"] and p("MIT.") == ["MIT"] and p("Apache-2.0, see file") == ["Apache-2.0"]
    # prose is no licence
    assert p("MIT and then") == p("MIT and then some prose") == p("MIT (see LICENSE file)") == p("MIT License terms") == ["MIT"]
    assert p("see LICENSE file") is None and p("Proprietary") is None and p("GPL-2.0 WITH some-words") is not None
    assert p("MIT/Apache-2.0") == ["MIT", "Apache-2.0", "or"] and p("MIT // comment") == ["MIT"]
    assert p("MIT OR") is None and p("(MIT") is None and p("OR MIT") is None and p("MIT)") is None and p("") is None
    kind = lambda t: licenses.evaluate(p(t))[1]
    assert kind("CC-BY-NC-4.0") == "restricted" and kind("GPL-2.0+ OR CC-BY-NC-4.0") == "copyleft"
    assert kind("LicenseRef-Proprietary") == kind("NONE") == kind("NOASSERTION") == kind("MIT AND LicenseRef-x") == "unknown"
    assert kind("MIT OR LicenseRef-x") == kind("LGPL-2.1-only WITH Classpath-exception-2.0 OR 0BSD") == "permissive"
    assert licenses.evaluate(p("MIT AND GPL-3.0"))[1] == "copyleft" and licenses.evaluate(p("MIT OR GPL-3.0"))[1] == "permissive"


TURN = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", 'a"]\\ ']),
                 st.one_of(st.text(max_size=20), st.lists(st.sampled_from(
                     ["<s>", "</s>", "[INST]", " [/INST]", " </s>", "[SYS] ", " [/SYS]", "[TURN ", "[/TURN]", "\\", "<", "[", "<\\/s>", "ok", " "]),
                     max_size=6).map("".join)))


@settings(max_examples=400, deadline=None)
@given(st.lists(TURN, max_size=6))
def test_chat_round_trip(turns):
    formatted, spans = chat.format_turns(turns)
    assert [(r, t) for r, t, _, _ in chat.parse(formatted)] == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<[\\/sINSTYURN] >", max_size=30))
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text


def test_op7_whole_table(spark, sf):
    import pyarrow.parquet as pq
    convs = {}
    for r in pq.read_table(f"{sf}/conversations.parquet").to_pylist():
        convs.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    convs[-7] = [(k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    got = {r["conv_id"]: r for r in op7_chat(spark, sf).collect()}
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        turns = sorted(turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (
            len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c]["formatted_chars"] >= len(whole) - sum(len(r) + 2 for _, r, _ in turns)


def test_op7_edges(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (None, 1, None, "x"), (None, None, "assistant", "😀 ok"), (2, 0, "tool", "[/TURN]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got[1]["n_turns"] == 2 and got[None]["n_turns"] == 2 and got[None]["loss_chars"] == 4 and got[2]["n_turns"] == 1
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_words_of_arrow_slices():
    from eventide.llm.words import text_chunks
    col = pa.array(["a b", None, "", "cd"]).slice(1)
    assert [(lo, hi, d.tobytes(), o.tolist()) for lo, hi, d, o in text_chunks(col)] == [(0, 3, b"cd", [0, 0, 0, 2])]
