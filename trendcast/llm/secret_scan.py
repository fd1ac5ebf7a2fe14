"""Operator 4: secret scanning with assignment-aware lexing.

Two layers look at each whole text.

*Base patterns* (fixed by the contract): ``assign``, ``access`` and ``hex``.

*Assignment lexer*: lines that hold an assignment sign are lexed into names,
string literals, bare words and signs. The parser reads source and configuration
forms (``name = "..."``, ``name: ...``, ``"name": "..."``, ``export NAME=...``,
``name := ...``, ``name => ...``, keyword arguments, ``table["name"] = ...``,
``name: type = ...``, ``var name type = ...``) as name-literal pairs, joins
adjacent literals (``"ab" + "cd"``), goes on over the line end where a value or a
joined literal is still to come, and follows constants: a value that is an
earlier name (``x``, ``$x``, ``${x}``) stands for that name's literal. Each pair
gets a score from how sensitive its name is and how random its literal looks;
literals at or above the threshold are reported as kind ``literal``, at the
place of the literal itself.

One pass, no shuffle; memory is that of one Arrow batch of texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast.llm.common import table

# The contract's patterns and minimum lengths.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # whole runs
ASSIGN_MIN, ACCESS_MIN = 6, 20
KIND_ORDER = ["assign", "access", "hex", "literal"]

# How much a word of a name says that its value is secret.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.6, "authorization": 0.8, "bearer": 0.8, "private": 0.6,
    "access": 0.5, "key": 0.5, "api": 0.4, "signature": 0.5, "salt": 0.5, "cookie": 0.4, "session": 0.4,
    "connection": 0.3, "client": 0.2, "aws": 0.3, "ssh": 0.4, "webhook": 0.4, "encryption": 0.5,
}
# Values that stand for "no secret here".
PLACEHOLDERS = {"changeme", "example", "placeholder", "password", "secret", "none", "null", "true", "false", "todo", "xxxxxx"}
THRESHOLD = 1.0
LITERAL_MIN = 6

_SIGN = re.compile(r"[:=]")
_LEX = re.compile(r"""
    (?P<str>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
  | (?P<ref>\$\{[A-Za-z_]\w*\}|\$[A-Za-z_]\w*)
  | (?P<sign>:=|=>|==|!=|<=|>=|[:=])
  | (?P<plus>\+(?=\s*["']))
  | (?P<word>[A-Za-z0-9_+/.-]+(?:=+(?=\s|$))?)
  | (?P<gap>[\x20\t]+)
  | (?P<other>.)
""", re.VERBOSE | re.ASCII)
_SIGNS = {"=", ":", ":=", "=>"}
# What the end of a line leaves open, and what goes on with it at the start of the next.
# Their runs give nothing back, so a search takes time in proportion to the line.
_VALUE_DUE = re.compile(r"(?:(?<![=!<>:=])[:=]|:=|=>)[\x20\t]*+(\(?+)[\x20\t]*+(\\?+)[\x20\t\r]*+\Z")
_PART_DUE = re.compile(r"""["'][\x20\t]*+\+[\x20\t]*+\\?+[\x20\t\r]*+\Z""")
_PART_END = re.compile(r"""["'][\x20\t]*+(\\?+)[\x20\t\r]*+\Z""")
_IN_PARENS = re.compile(r"""[:=][\x20\t]*+\([\x20\t]*+["'][^()]*+\Z""")
_NEXT_LITERAL = re.compile(r"""[\x20\t]*(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')(?![\x20\t]*[:=])""")
_NEXT_PLUS = re.compile(r"""[\x20\t]*\+[\x20\t]*["']""")
_NEXT_WORD = re.compile(r"[\x20\t]+[A-Za-z0-9_+/.-]+=*[\x20\t\r]*(?=\n|\Z)", re.ASCII)
# Between a colon and an equals sign: a type.
_TYPE_SIGNS = set("[]<>|?&*!,()")
_NAME = re.compile(r"[A-Za-z_][\w.-]*", re.ASCII)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", re.ASCII)


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    name: str | None = None
    score: float | None = None


def base_spans(text: str) -> list[Span]:
    """The contract's spans: leftmost non-overlapping matches per kind, too short ones dropped."""
    found = [Span("assign", *m.span(), m.group(1).lower()) for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= ASSIGN_MIN]
    found += [Span("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    return found + [Span("hex", *m.span()) for m in HEX.finditer(text)]


def name_score(name: str) -> float:
    """0 to 1: the most telling word of a name, a little more for each further one."""
    words = [w.lower() for w in _WORDS.findall(name)]
    words += ["".join(words[i:i + 2]) for i in range(len(words) - 1)]
    weights = sorted((NAME_WEIGHTS[w] for w in words if w in NAME_WEIGHTS), reverse=True)
    return min(1.0, weights[0] + 0.25 * sum(weights[1:])) if weights else 0.0


def literal_score(value: str) -> float:
    """0 to 1: randomness of a literal, from its entropy, character classes and length."""
    if len(value) < LITERAL_MIN or value.lower() in PLACEHOLDERS or len(set(value)) < 4:
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))
    spaced = 0.3 if " " in value else 0.0
    return max(0.0, min(1.0, entropy / 5 + 0.1 * (classes - 1) + 0.1 * (n >= 20) - spaced))


def _lines(text: str) -> Iterator[tuple[int, str]]:
    """(start, line) of the lines that hold an assignment sign, with the lines that go on with them."""
    at = 0
    while (sign := _SIGN.search(text, at)) is not None:
        start = max(text.rfind("\n", 0, sign.start()) + 1, at)
        at = text.find("\n", sign.end())
        at = len(text) if at < 0 else at
        own, parens = start, False
        while at < len(text):
            tail = text[own:at]
            due = _VALUE_DUE.search(tail)
            end = _PART_END.search(tail)
            parens = parens or bool(due and due.group(1)) or bool(_IN_PARENS.search(tail))
            go_on = (due and (_NEXT_LITERAL.match(text, at + 1) or _NEXT_WORD.match(text, at + 1))
                     or _PART_DUE.search(tail) and _NEXT_LITERAL.match(text, at + 1)
                     or end and (_NEXT_PLUS.match(text, at + 1) or (parens or end.group(1)) and _NEXT_LITERAL.match(text, at + 1)))
            if not go_on:
                break
            own = at + 1
            at = text.find("\n", own)
            at = len(text) if at < 0 else at
        yield start, text[start:at]


def _typed(tokens: list, at: int) -> int:
    """The place of the colon whose type ends before the equals sign at ``at``; -1 without one.

    The way back ends at the sign before, so all the types of a line take one pass over it.
    """
    depth, word = 0, False
    for i in range(at - 1, 0, -1):
        kind, raw = tokens[i][:2]
        if kind == "sign" and raw == ":":
            return i if not depth and i < at - 1 else -1
        if kind == "word":
            if word:
                return -1
            word = True
        elif kind == "other" and raw in _TYPE_SIGNS:
            depth += (raw in "])>") - (raw in "[(<")
            if depth < 0 or raw == "," and not depth:
                return -1
            word = False
        else:
            return -1
    return -1


def _names(tokens: list, at: int) -> list[tuple[str, bool]]:
    """(name, constant?) of what the sign at ``at`` may assign to."""
    places = [at - 1]
    if tokens[at - 1][1] == "]" and at >= 3 and tokens[at - 2][0] == "str" and tokens[at - 3][1] == "[":
        return [(tokens[at - 2][1][1:-1], False)]
    if tokens[at][1] == "=":
        if (colon := _typed(tokens, at)) > 0:
            places.append(colon - 1)
        elif at >= 2 and tokens[at - 1][0] == tokens[at - 2][0] == "word" and (
                tokens[at - 1][1] == "string" or at >= 3 and tokens[at - 3][1] in ("var", "const")):
            places.append(at - 2)
    return [(raw[1:-1] if kind == "str" else raw, True) for kind, raw in (tokens[i][:2] for i in places) if kind in ("str", "word")]


def _joined(tokens: list, at: int) -> tuple[list, int]:
    """Literals that are joined to the one at ``at`` by ``+`` or by standing next to it."""
    parts, i = [tokens[at]], at + 1
    while i < len(tokens):
        j = i + 1 if tokens[i][0] == "plus" else i
        if j == i and tokens[i][1] == "\\" and i + 1 < len(tokens) and tokens[i + 1][0] == "str":
            j = i + 1  # a literal goes on behind a continued line
        if j < len(tokens) and tokens[j][0] == "str" and (j > i or tokens[at][0] == "str"):
            parts.append(tokens[j])
            i = j + 1
        else:
            break
    return parts, i


def pairs(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(name, literal, start, end) of each assignment; start and end are the literal's place.

    A value that names an earlier constant yields that constant's literal and
    place under the new name.
    """
    constants: dict[str, tuple[str, int, int]] = {}
    for base, line in _lines(text):
        tokens = [(m.lastgroup, m.group(), base + m.start(), base + m.end())
                  for m in _LEX.finditer(line) if m.lastgroup != "gap"]
        signs = [i for i in range(1, len(tokens) - 1) if tokens[i][0] == "sign" and tokens[i][1] in _SIGNS]
        types = {_typed(tokens, i) for i in signs if tokens[i][1] == "="}
        for i in signs:
            names = [] if i in types else [n for n in _names(tokens, i) if _NAME.fullmatch(n[0])]
            if not names:
                continue
            while i + 2 < len(tokens) and tokens[i + 1][1] in ("(", "\\"):
                i += 1
            kind, raw, start, end = tokens[i + 1]
            if kind == "str":
                parts, _ = _joined(tokens, i + 1)
                value, start, end = "".join(p[1][1:-1] for p in parts), start + 1, parts[-1][3] - 1
            elif kind == "ref" or (kind == "word" and raw in constants):
                known = constants.get(raw.strip("${}"))
                if known is None:
                    continue
                value, start, end = known
            elif kind == "word":
                value = raw
            else:
                continue
            for name, constant in names:
                if constant:
                    constants[name] = (value, start, end)
                yield name, value, start, end


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    best: dict[tuple[int, int], Span] = {}
    for name, value, start, end in pairs(text):
        sensitive = name_score(name)
        score = round(sensitive + literal_score(value), 4) if sensitive else 0.0
        if sensitive and literal_score(value) > 0 and score >= threshold:
            old = best.get((start, end))
            if old is None or score > old.score:
                best[start, end] = Span("literal", start, end, name, score)
    return list(best.values())


def scan_text(text: str | None, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text by start, then kind as listed; code points, end exclusive."""
    if not text:
        return []
    spans = base_spans(text) + literal_spans(text, threshold)
    return sorted(spans, key=lambda s: (s.start, KIND_ORDER.index(s.kind), s.end))


SPANS = "array<struct<kind: string, start: bigint, end: bigint, name: string, score: double>>"


def scan_secrets(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``secrets``: every span of the whole text, in order.

    A null or empty text has none. Other columns pass through; one called
    ``secrets`` is replaced.
    """
    @F.pandas_udf(SPANS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": s.kind, "start": s.start, "end": s.end, "name": s.name, "score": s.score}
                              for s in scan_text(t, threshold)] for t in texts])

    return docs.withColumn("secrets", scan(F.col(text_col)))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of ``secrets``; the literals come last so that base spans stay as they are."""
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(secrets, s -> s.kind != 'literal')"
    count = "cast(size(filter(secrets, s -> s.kind = '{}')) as bigint)"
    return found.select(
        id_col, *[F.expr(count.format(k)).alias(f"n_{k}") for k in KIND_ORDER],
        F.sha2(F.expr(joined.format(base)), 256).alias("base_sha256"), F.expr(joined.format("secrets")).alias("spans"))


def op4_secret_scan(spark, sf_dir):
    """Counts by kind, the digest of the base spans and all spans of every document."""
    return digest(scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")))


