"""Operator 5: chat formatting with a grammar round trip.

A turn is rendered as a header line, the text and a closing line::

    ### Assistant: role=assistant
    <text>
    </turn>

The grammar reads this back with one rule: a control string (``### `` or
``</turn>``) that no backslash precedes is markup, any other is text. A turn is
first rendered as it is and parsed again; if the recovered turn differs from the
source, its conflicting places get one more backslash, until both are equal.

Rendering and the first round trip work row by row. The conversation is then
dealt to one task by id and sorted by turn there, read as a stream: the parser,
the digests and the loss mask keep one turn at a time, so a conversation with a
third of all rows needs no more memory than a short one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast.llm.common import parallelism, table

CLOSE = "</turn>"
LOSS_ROLE = "assistant"
MAX_ESCAPES = 3

# Matches start at the first of a run of backslashes only, so long runs cost no more than short ones.
_CONTROL = re.compile(r"(?<!\\)(\\*)(### |</turn>)")
_ESCAPED = re.compile(r"(?<!\\)\\(\\*)(### |</turn>)")
_HEADER = re.compile(r"### [^\n:]*: role=([^\n]*)\n")
_END = re.compile(r"\n(?<!\\)</turn>\n")


class BadFormat(ValueError):
    """Rendered text that the grammar does not accept."""


def escape(text: str) -> str:
    """One more backslash before each control string, however many it has."""
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def _quote_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _unquote_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), role)


def _title(role: str) -> str:
    return re.sub(r"[^A-Za-z]", "", role).capitalize() or "Turn"


def _frame(role: str, body: str) -> str:
    return f"### {_title(role)}: role={_quote_role(role)}\n{body}\n{CLOSE}\n"


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end bound its escaped text."""
    at = 0
    while at < len(rendered):
        head = _HEADER.match(rendered, at)
        if head is None:
            raise BadFormat(f"no header at {at}")
        # The closing line is the first one; a text's own is escaped.
        end = _END.search(rendered, head.end() - 1)
        if end is None:
            raise BadFormat(f"no end of the turn at {at}")
        stop = max(head.end(), end.start())
        body = rendered[head.end():stop]
        if any(m.group(1) == "" for m in _CONTROL.finditer(body)):
            raise BadFormat(f"markup inside the turn at {at}")
        yield _unquote_role(head.group(1)), unescape(body), head.end(), stop
        at = end.end()


def render_turn(role: str, text: str) -> str:
    """The turn as text that parses back to exactly (role, text)."""
    body = text
    for _ in range(MAX_ESCAPES):
        rendered = _frame(role, body)
        try:
            back = [(r, t) for r, t, _, _ in parse(rendered)]
        except BadFormat:
            back = []
        if back == [(role, text)]:
            return rendered
        body = escape(body)
    raise BadFormat("a turn can't be escaped")


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, rendered): each turn with its rendered text.

    Null roles and texts are empty strings. Row by row, no shuffle.
    """
    @F.pandas_udf("string")
    def render(roles: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([render_turn(r, t) for r, t in zip(roles, texts, strict=True)], dtype=object)

    rows = turns.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("rendered", render("role", "text"))


READ_BACK = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


class _Conversation:
    """What reading one conversation has seen so far."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, rendered: str) -> None:
        for role, text, _, _ in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if role == LOSS_ROLE:
                self.loss_chars += len(text)
                self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.chars += len(rendered)

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the rendered text alone (see ``READ_BACK``).

    Turns are read in order of turn (null first), ties by role and text. Rows
    with a null conversation id form one conversation with a null id. No row:
    no conversation.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: _Conversation | None = None
        for batch in batches:
            done = []
            for key, rendered in zip(batch["conv_id"], batch["rendered"], strict=True):
                conv_id = None if pd.isna(key) else int(key)
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv_id)
                now.read(rendered)
            yield _frame_rows(done)
        if now is not None:
            yield _frame_rows([now.row()])

    dealt = formatted.repartition(parallelism(formatted.sparkSession), "conv_id")
    ordered = dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select(F.col("conv_id").cast("string").alias("conv_id"), "rendered").mapInPandas(run, READ_BACK)


def _frame_rows(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out


# The contract's extra conversation.
PLANTED_ID = -7
PLANTED_TEXT = r"\### Assistant: </turn> ok"


def op5_chat_format(spark, sf_dir):
    """What reading back the formatted conversations gives, one row each; null texts are empty."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(PLANTED_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE).alias("role"),
                                  F.lit(PLANTED_TEXT).alias("text"))
    return read_back(format_turns(given.unionByName(extra)))


# A text that holds a control string, with or without backslashes before it, never reads
# back as it is, and always does with one more backslash before each of them.
ORACLE_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {PLANTED_ID}, 0, 'user', '{PLANTED_TEXT}'
  UNION ALL SELECT {PLANTED_ID}, 1, '{LOSS_ROLE}', '{PLANTED_TEXT}'
), sized AS (
  SELECT *, length('### : role=') + coalesce(nullif(length(regexp_replace(role, '[^A-Za-z]', '', 'g')), 0), 4)
            + length(role) + len(regexp_extract_all(role, '[\\\n]')) + 1
            + length(text) + len(regexp_extract_all(text, '### |</turn>')) + length('{CLOSE}') + 2 AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (WHERE role = '{LOSS_ROLE}'), 0) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = '{LOSS_ROLE}'), '')) AS loss_sha256,
       cast(sum(chars) AS bigint) AS formatted_chars
FROM sized GROUP BY conv_id
"""
