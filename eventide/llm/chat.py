"""Chat formatting with a grammar round trip (operator 7).

Grammar of a rendered conversation, turn after turn:

    system     [SYS] text [/SYS]
    user       <s>[INST] text [/INST]
    assistant  space text </s>
    any other  [TURN role] text [/TURN]   (the role written as a JSON string)

Rendered text is parsed again by a deterministic parser. Where a turn does not
come back as it was, its text is escaped (a backslash after the first character
of each control string, one more where backslashes stand there already) and the
conversation is rendered again, until the turns read back are the source's.

Defined results: turns stand in the order (turn, role, text), null first; null
text is empty text, a null role is the empty role; rows with a null conv_id are
one conversation; repeated rows are turns of their own.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed strings of the template.
OPEN = {"system": "[SYS] ", "user": "<s>[INST] ", "assistant": " "}
CLOSE = {"system": " [/SYS]", "user": " [/INST]", "assistant": " </s>"}
_CONTROL = r"(?:/?s>|/?SYS\]|/?INST\]|TURN |/TURN\])"
_ESCAPE = re.compile(r"([<\[])(\\*)(?=" + _CONTROL + ")")
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(?=" + _CONTROL + ")")
_TURN = re.compile(r'\[TURN ("(?:[^"\\]|\\.)*")\] ')


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def _marks(role: str) -> tuple[str, str]:
    if role in OPEN:
        return OPEN[role], CLOSE[role]
    return f"[TURN {json.dumps(role)}] ", " [/TURN]"


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, possibly escaped text) turns, and the span
    of every text in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        a, b = _marks(role)
        spans.append((at + len(a), at + len(a) + len(text)))
        out += (a, text, b)
        at += len(a) + len(text) + len(b)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, unescaped text, span of the text as written) of every turn.
    Raises ValueError where the text is not of the grammar."""
    out, at = [], 0
    while at < len(formatted):
        for role in ("system", "user", "assistant"):
            if formatted.startswith(OPEN[role], at):
                begin, close = at + len(OPEN[role]), CLOSE[role]
                break
        else:
            m = _TURN.match(formatted, at)
            if not m:
                raise ValueError(f"no turn begins at {at}")
            role, begin, close = json.loads(m[1]), m.end(), " [/TURN]"
        end = formatted.find(close, begin)
        if end < 0:
            raise ValueError(f"the turn at {at} does not end")
        out.append((role, unescape(formatted[begin:end]), begin, end))
        at = end + len(close)
    return out


def _reads_back(turns: list[tuple[str, str]], formatted: str) -> bool:
    try:
        return [(r, t) for r, t, _, _ in parse(formatted)] == turns
    except ValueError:
        return False


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Render, read back, and escape what conflicts until both are identical.
    Returns the text and the spans under the loss mask (assistant texts)."""
    texts = [t for _, t in turns]
    formatted, spans = render(turns)
    if not _reads_back(turns, formatted):
        texts = [t if _reads_back([(r, t)], render([(r, t)])[0]) else escape(t) for r, t in turns]
        formatted, spans = render([(r, t) for (r, _), t in zip(turns, texts, strict=True)])
        if not _reads_back(turns, formatted):
            formatted, spans = render([(r, escape(t)) for r, t in turns])
            if not _reads_back(turns, formatted):
                raise ValueError("the template cannot hold these turns")
    return formatted, [s for s, (r, _) in zip(spans, turns, strict=True) if r == "assistant"]


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (array of begin and end, in code points) of
    rows (conv_id, turn, role, text). The turns of one conversation meet in one
    row, which is the operator's unit; nothing larger is gathered."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", role.alias("role"), text.alias("text")))).alias("turns"))

    @F.udf("struct<formatted:string,loss_spans:array<struct<begin:int,end:int>>>", useArrow=True)
    def run(turns):
        return format_turns([(t["role"], t["text"]) for t in turns])

    made = grouped.select("conv_id", run("turns").alias("f"))
    return made.select("conv_id", "f.formatted", "f.loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    all from the formatted text: turns by the parser, loss text by the mask."""
    import hashlib

    @F.udf("struct<n_turns:bigint,turns_sha256:string,loss_chars:bigint,loss_sha256:string,formatted_chars:bigint>",
           useArrow=True)
    def run(text, spans):
        turns = parse(text)
        under = "".join(unescape(text[s["begin"]:s["end"]]) for s in spans)
        whole = "".join(f"{r}\n{t}\n" for r, t, _, _ in turns)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, under)]
        return len(turns), digest[0], len(under), digest[1], len(text)

    out = formatted.select("conv_id", run("formatted", "loss_spans").alias("r"))
    return out.select("conv_id", "r.*")
