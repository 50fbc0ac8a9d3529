"""License scans (operator 10).

An Aho-Corasick automaton finds phrases of licences and notices among the words
of a text, and the places of identifier tags; a shunting-yard parser evaluates
the licence expression after a tag (and, or, with, parentheses; "/" between
licences is an or).

Labels: ``mit``, ``apache``, ``gpl`` from the base phrases; ``notice:...`` from
other phrases; ``spdx:...`` for each licence an expression names; and the class of
what a valid expression lets a user choose: ``permissive``, ``copyleft``,
``restricted`` (non-commercial, no derivatives, source available) or ``unknown``.
``or`` takes the freer side; ``and`` the stricter one, and an unknown side makes it
unknown; ``with`` needs a known exception and leaves the class. A licence that the
table does not have (LicenseRef-... among them), NONE and NOASSERTION are unknown.
``bad-expression`` stands where a tag's text can't be parsed. Prose after an
expression is no part of it: a plain word that is no licence ends it.

Score: 1 - product of (1 - weight) over the distinct kinds of evidence: base
phrase 0.6, notice 0.3, valid expression 0.9 (0.4 if it names no known licence),
bad expression 0.2.

Defined results: null or empty text has no words, no labels ("") and score 0; an
empty table gives no rows; null ids and repeated rows pass row by row; other
columns are not read. Time is linear in a text's length and hits, however long.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import worker_cache
from .runtime import texts_of
from .words import LOWER, PLAIN_WORDS, text_chunks, word_spans

BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {"all rights reserved": "notice:rights-reserved", "licensed under the": "notice:licensed-under",
           "permission is hereby granted": "notice:permission", "provided as is": "notice:as-is",
           "without warranty of any kind": "notice:no-warranty", "released into the public domain": "notice:public-domain",
           "creative commons": "notice:creative-commons", "licensed under cc": "notice:creative-commons",
           "this work is licensed": "notice:licensed-under", "bsd license": "notice:bsd",
           "mozilla public license": "notice:mpl", "redistribution and use in source": "notice:bsd"}
TAG = "spdx license identifier"
_TAG_TEXT = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\n\r*]*)", re.I)
_TOKEN = re.compile(r"\s*(\(|\)|/(?!/)|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_END = re.compile(r"\s*($|\*/|-->|[\"'`#;,.>\]}])")
_BINDS = {"or": 1, "and": 2, "with": 3}

# Licence identifiers of the public SPDX list, without versions where all versions are of one class.
PERMISSIVE = frozenset("""0bsd afl apache apache-1.0 apache-1.1 apache-2.0 artistic-2.0 blueoak-1.0.0 bsd bsd-1-clause bsd-2-clause
    bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-3-clause-lbnl bsd-4-clause bsl-1.0 cc0-1.0 cc-by-1.0 cc-by-2.0 cc-by-2.5
    cc-by-3.0 cc-by-4.0 cc-pddc curl ecl-2.0 eudatagrid fsfap ftl hpnd icu ijg isc libpng libpng-2.0 libtiff mit mit-0 mit-cmu
    mit-modern-variant ms-pl mulanpsl-2.0 ncsa odc-by-1.0 ofl-1.1 openldap-2.8 openssl pddl-1.0 php-3.01 postgresql psf-2.0 python-2.0 ruby
    tcl unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 w3c wtfpl x11 xnet zlib zlib-acknowledgement zpl-2.1""".split())
COPYLEFT = frozenset("""agpl-1.0-only agpl-1.0-or-later agpl-3.0 agpl-3.0-only agpl-3.0-or-later apsl-2.0 artistic-1.0 cc-by-sa-1.0
    cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0 cddl-1.0 cddl-1.1 cecill-2.1 cpal-1.0 cpl-1.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2
    gfdl-1.1-only gfdl-1.1-or-later gfdl-1.2-only gfdl-1.2-or-later gfdl-1.3-only gfdl-1.3-or-later gpl gpl-1.0 gpl-1.0-only
    gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later ipl-1.0 lgpl lgpl-2.0 lgpl-2.0-only
    lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later mpl-1.0 mpl-1.1 mpl-2.0
    mpl-2.0-no-copyleft-exception ms-rl odbl-1.0 osl-3.0 qpl-1.0 sleepycat""".split())
RESTRICTED = frozenset("""busl-1.1 cc-by-nc-1.0 cc-by-nc-2.0 cc-by-nc-2.5 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0
    cc-by-nc-sa-2.0 cc-by-nc-sa-2.5 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 elastic-2.0 json
    polyform-noncommercial-1.0.0 polyform-small-business-1.0.0 sspl-1.0""".split())
EXCEPTIONS = frozenset("""389-exception autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception
    classpath-exception-2.0 font-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 gpl-cc-1.0 i2p-gpl-java-exception
    libtool-exception linux-syscall-note llvm-exception lzma-exception ocaml-lgpl-linking-exception openjdk-assembly-exception-1.0
    openvpn-openssl-exception qt-gpl-exception-1.0 qt-lgpl-exception-1.1 swift-exception universal-foss-exception-1.0
    wxwindows-exception-3.1""".split())
NOTHING = frozenset(["none", "noassertion"])
CLASSES = ("permissive", "copyleft", "restricted", "unknown")  # freest first


def license_class(name: str) -> str:
    """The class of a licence identifier; "+" (or any later version) leaves it."""
    low = name.lower().rstrip("+")
    for known, kind in ((PERMISSIVE, "permissive"), (COPYLEFT, "copyleft"), (RESTRICTED, "restricted")):
        if low in known:
            return kind
    return "unknown"


def _operand(t: str) -> bool:
    """Whether a token can name a licence: one of the tables, or shaped like an identifier."""
    low = t.lower()
    return license_class(t) != "unknown" or low in NOTHING or low in EXCEPTIONS or any(c in "0123456789-.:+" for c in t)


def parse_expression(text: str) -> list[str] | None:
    """Postfix form of the longest licence expression that begins the text; None
    if there is none or it is ill-formed."""
    out: list[str] = []
    stack: list[str] = []
    operand, depth, at = True, 0, 0
    whole: list[str] | None = None  # of what is complete so far
    while m := _TOKEN.match(text, at):
        t = m[1]
        low = "or" if t == "/" else t.lower()
        if low in _BINDS:
            if operand:
                return None
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = True
        elif t == "(":
            if not operand:
                return whole  # prose in parentheses
            stack.append(t)
            depth += 1
        elif t == ")":
            if operand or not depth:
                return None
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        else:
            t = t.rstrip(".:-")
            exception = bool(stack) and stack[-1] == "with"
            if not operand or not t or not (t.lower() in EXCEPTIONS if exception else _operand(t)):
                return whole  # prose after the expression, if it was one
            out.append(t)
            operand = False
        if not operand and not depth:
            whole = out + stack[::-1]
        at = m.end()
    if operand or depth or not _END.match(text, at):
        return whole if not operand and not depth else None
    return whole


def evaluate(postfix: list[str]) -> tuple[set[str], str]:
    """(licences named, class that a user may choose)."""
    stack: list[tuple[set[str], str]] = []
    for t in postfix:
        if t not in _BINDS:
            stack.append(({t}, license_class(t)))
            continue
        (b, kb), (a, ka) = stack.pop(), stack.pop()
        if t == "with":
            stack.append((a, ka))
        else:
            choose = min if t == "or" else max
            stack.append((a | b, choose(ka, kb, key=CLASSES.index)))
    return stack[0]


def _automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE_PHRASES), ("notice", NOTICES), ("tag", {TAG: ""})):
        for phrase, label in phrases.items():
            made.add_word(f" {phrase} ", (kind, label, len(phrase.split())))
    made.make_automaton()
    return made


def scan(plain: str, text: str, automaton: ahocorasick.Automaton) -> tuple[list[int], set[str], set[str], float]:
    """(word places of base phrases, base labels, all labels, score). plain: the
    lower-cased words with one space before, between and after them."""
    places, base, labels, kinds = [], set(), set(), set()
    tagged = False
    words, seen = 0, 0  # words that end before place `seen`, counted on from hit to hit
    for end, (kind, label, size) in automaton.iter(plain):
        if kind == "tag":
            tagged = True
        else:
            labels.add(label)
            kinds.add((kind, label))
        if kind == "base":
            base.add(label)
            words, seen = words + plain.count(" ", seen, end), end
            places.append(words - size)
    if tagged:
        for m in _TAG_TEXT.finditer(text):
            postfix = parse_expression(m[1])
            if postfix is None:
                labels.add("bad-expression")
                kinds.add(("bad", ""))
                continue
            named, kind = evaluate(postfix)
            labels |= {"spdx:" + x.lower() for x in named} | {kind}
            kinds.add(("spdx" if any(license_class(x) != "unknown" for x in named) else "odd", ""))
    miss = 1.0
    for kind, _ in sorted(kinds):
        miss *= 1 - {"base": 0.6, "notice": 0.3, "spdx": 0.9, "odd": 0.4, "bad": 0.2}[kind]
    return places, base, labels, round(1 - miss, 6)


def _plain_rows(data: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(words of each row with single spaces around them, words by row)."""
    start, end, first = word_spans(data, off, PLAIN_WORDS)
    size = end - start + 1  # with the space after it
    place = np.cumsum(size) - size
    out = np.full(int(size.sum()), 0x20, dtype=np.uint8)
    src = np.repeat(start - place, size) + np.arange(len(out))
    live = np.ones(len(out), dtype=bool)
    live[place + size - 1] = False
    out[live] = LOWER[data[src[live]]]
    edge = np.append(place, len(out))[first]
    raw = out.tobytes()
    return [" " + raw[i:j].decode() for i, j in zip(edge.tolist(), edge[1:].tolist())], np.diff(first)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score."""
    def run(batches):
        automaton = worker_cache("license_phrases", _automaton)
        for b in batches:
            for lo, hi, data, off in text_chunks(b.column(1)):
                plain, n_words = _plain_rows(data, off)
                rows = []
                for k, p in enumerate(plain):
                    places, base, labels, score = scan(
                        p, data[off[k]:off[k + 1]].tobytes().decode() if TAG in p else "", automaton)
                    rows.append((len(places), min(places, default=None), max(places, default=None),
                                 ",".join(sorted(base)), ",".join(sorted(labels)), score))
                cols = list(zip(*rows))
                yield pa.record_batch(
                    [b.column(0).slice(lo, hi - lo), pa.array(n_words),
                     *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())))],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    d = texts_of(docs)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, "
                             "first_word long, last_word long, base_labels string, labels string, score double")
