"""Operator 11: repair of a conversation's turn structure at least cost.

A repair is a string of edits over a conversation's rows in order: K keeps a row,
R gives it another role, D deletes it, I inserts an empty turn. The cheapest
repair whose roles read ``(s?(ua)+)?`` is found by a dynamic programme over the
rows and the four states of that pattern; among equally cheap repairs the
ASCII-least string of edits wins.

*Persistent audits.* A partial repair is a linked node that shares its prefix with
the others. A node knows its ancestors at every power of two and a rolling hash of
its whole string, so two repairs are compared by searching for their longest
common prefix, in a logarithmic number of steps. Where hashes say "equal", the
letters are read to verify it.

*Scale.* No task holds a conversation's texts. A row's facts (role, digest, faults)
are dealt out by ranges of (conversation, turn), so one with a third of all rows is
cut into segments. A segment gives the best repair from each state to each state;
segments are joined in order, and the texts pass as one sorted stream.

Which row of a turn comes first where several rows share one: the one with the
smaller role, then the smaller text digest.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendcast.llm.common import materialize, parallelism, table

# Costs, and the pattern (s?(ua)+)? as an automaton over role initials.
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5
STATES = 4  # nothing yet, after s, after u, after a
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTING = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
# Where a turn goes that is inserted or gets a new role.
SPOKEN = {s: t for (s, i), t in NEXT.items() if i in ROLE}
MODULUS = (1 << 61) - 1
_BASE = 1_000_003


class Audit:
    """One edit after the edits of ``parent``; never changed, so prefixes are shared."""

    __slots__ = ("parent", "letter", "depth", "hash", "up")

    def __init__(self, parent: Audit | None, letter: str, modulus: int = MODULUS):
        self.parent, self.letter = parent, letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * _BASE + ord(letter)) % modulus
        up, at, j = [parent], parent, 0
        while j < len(at.up):
            at = at.up[j]
            up.append(at)
            j += 1
        self.up = tuple(up)

    def ancestor(self, depth: int) -> Audit:
        node, steps, j = self, self.depth - depth, 0
        while steps:
            if steps & 1:
                node = node.up[j]
            steps >>= 1
            j += 1
        return node

    def text(self) -> str:
        out, node = [], self
        while node.parent is not None:
            out.append(node.letter)
            node = node.parent
        return "".join(reversed(out))


def _same(x: Audit, y: Audit) -> bool:
    """Whether two strings of one length and hash are equal indeed."""
    while x is not y:
        if x.letter != y.letter:
            return False
        x, y = x.parent, y.parent
    return True


def less(a: Audit, b: Audit) -> bool:
    """Whether the string of ``a`` is less than that of ``b``."""
    depth = min(a.depth, b.depth)
    x, y = a.ancestor(depth), b.ancestor(depth)
    if x is y or x.hash == y.hash and _same(x, y):
        return a.depth < b.depth
    if x.hash != y.hash:
        for j in range(len(x.up) - 1, -1, -1):
            if j < len(x.up) and x.up[j].hash != y.up[j].hash:
                x, y = x.up[j], y.up[j]
        if _same(x.parent, y.parent):
            return x.letter < y.letter
    return a.text() < b.text()  # different strings had one hash


class Repair:
    """The best repair into each state of the rows seen so far, from one state on."""

    def __init__(self, start: int, modulus: int = MODULUS):
        self.modulus = modulus
        self.best: list[tuple[int, Audit] | None] = [None] * STATES
        self.best[start] = (0, Audit(None, ""))

    def _offer(self, into: list, state: int, cost: int, parent: Audit, letter: str) -> None:
        have = into[state]
        if have is None or cost < have[0]:
            into[state] = (cost, Audit(parent, letter, self.modulus))
        elif cost == have[0]:
            node = Audit(parent, letter, self.modulus)
            if less(node, have[1]):
                into[state] = (cost, node)

    def insert(self) -> None:
        """Allow inserted turns here; after two of them nothing is gained."""
        before = list(self.best)
        for state in (0, 1, 3):
            if before[state]:
                self._offer(self.best, 2, before[state][0] + COST["I"], before[state][1], "I")
        if self.best[2]:
            self._offer(self.best, 3, self.best[2][0] + COST["I"], self.best[2][1], "I")

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        self.insert()
        after: list[tuple[int, Audit] | None] = [None] * STATES
        stays = TRUNCATED_COST if truncated else 0
        for state, have in enumerate(self.best):
            if have is None:
                continue
            cost, audit = have
            self._offer(after, state, cost + COST["D"], audit, "D")
            if not must_go:
                kept = NEXT.get((state, initial))
                if kept is not None:
                    self._offer(after, kept, cost + COST["K"] + stays, audit, "K")
                self._offer(after, SPOKEN[state], cost + COST["R"] + stays, audit, "R")
        self.best = after


class Segment:
    """Neighbouring rows of one conversation: counts, and the best repair between any two states."""

    def __init__(self, starts: Iterator[int]):
        self.repairs = {s: Repair(s) for s in starts}
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = self.turns = 0
        self.first = self.last = ""
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, copies: int, blank: bool, truncated: bool, seen: bool) -> None:
        initial = role[:1]
        for i in range(copies):
            repeat = seen or i > 0
            if self.rows:
                self.illegal += self.last + initial not in LEGAL_PAIRS
            else:
                self.first = initial
            self.rows, self.last = self.rows + 1, initial
            self.blank += blank
            self.duplicate += repeat and not blank
            cut = truncated and not blank and not repeat
            self.truncated += cut
            for r in self.repairs.values():
                r.row(initial, blank or repeat, cut)
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def payload(self) -> str:
        steps = [[s, t, have[0], have[1].text()] for s, r in self.repairs.items() for t, have in enumerate(r.best) if have]
        return json.dumps([self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last,
                           self.turns, self.first_turn, self.last_turn, steps])


class Whole:
    """Segments of a conversation joined in order."""

    def __init__(self):
        self.counts = [0, 0, 0, 0]
        self.last, self.turns, self.first_turn, self.last_turn = None, 0, None, None
        self.best: dict[int, tuple[int, str]] = {0: (0, "")}

    def join(self, payload: str) -> None:
        *counts, first, last, turns, first_turn, last_turn, steps = json.loads(payload)
        self.counts = [a + b for a, b in zip(self.counts, counts, strict=True)]
        if self.last is not None:
            self.counts[3] += self.last + first not in LEGAL_PAIRS
        self.last = last
        if turns:
            self.turns += turns - (first_turn == self.last_turn)
            self.first_turn = first_turn if self.first_turn is None else self.first_turn
            self.last_turn = last_turn
        after: dict[int, tuple[int, str]] = {}
        for s, t, cost, audit in steps:
            if s in self.best:
                one = (self.best[s][0] + cost, self.best[s][1] + audit)
                after[t] = min(after.get(t, one), one)
        self.best = after

    def report(self) -> dict:
        ends = dict(self.best)
        for s, (cost, audit) in self.best.items():  # turns inserted at the end
            while s != 3 and SPOKEN.get(s) is not None:
                s, cost, audit = SPOKEN[s], cost + COST["I"], audit + "I"
                ends[s] = min(ends.get(s, (cost, audit)), (cost, audit))
        cost, audit = min(ends[s] for s in ACCEPTING if s in ends)
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        blank, duplicate, truncated, illegal = self.counts
        return {"gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal,
                "cost": cost, "audit": audit}


def _by_turn() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        yield from b.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 2000, chars: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r.get("text") or "") + len(r.get("report") or r.get("payload") or "")
        if len(held) >= size or n >= chars:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def facts(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copies, blank, truncated, seen) of the rows of ``turns``, without their texts.

    ``seen``: the conversation has the same role and text in an earlier turn.
    """
    body = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    one = turns.select("conv_id", "turn", "role", "digest", (body == "").alias("blank"),
                       (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    # Counted before anything is dealt out: a row that is repeated very often is one row from here on.
    rows = one.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.count(F.lit(1)).alias("copies"))
    when = F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("at"))
    first = rows.groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d")).agg(F.min(when).alias("_first"))
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    return rows.join(first, on).select("conv_id", "turn", "role", "digest", "copies", "blank", "truncated",
                                       (when != F.col("_first")).alias("seen"))


_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("payload", pa.string())])


def segments(rows: DataFrame, parts: int) -> DataFrame:
    """(conv_id, part, payload): the rows of :func:`facts` in ``parts`` ranges, one :class:`Segment` per conversation in each."""
    dealt = rows.repartitionByRange(parts, *_by_turn()).sortWithinPartitions(*_by_turn())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            now, conv = None, None
            for r in _rows(batches):
                part = r["part"]
                if now is None or r["conv_id"] != conv:
                    if now is not None:
                        yield {"conv_id": conv, "part": part, "payload": now.payload()}
                    # Only a range's first conversation may have begun in the range before.
                    now, conv = Segment(range(STATES) if now is None else [0]), r["conv_id"]
                now.add(r["turn"], r["role"], r["copies"], r["blank"], r["truncated"], r["seen"])
            if now is not None:
                yield {"conv_id": conv, "part": part, "payload": now.payload()}

        yield from _batches(each(), _SEGMENTS)

    marked = dealt.withColumn("part", F.spark_partition_id().cast("bigint"))
    return marked.mapInArrow(run, "conv_id bigint, part bigint, payload string")


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                       ("text", pa.string()), ("report", pa.string())])
REPAIRED = "conv_id bigint, at bigint, edit string, role string, text string, report string"


def _repair(rows: Iterator[dict]) -> Iterator[dict]:
    """Per conversation a row with its report, then its repaired turns."""
    blank = dict.fromkeys(_REPAIRED.names)
    conv, state = None, None

    def inserted(letters: Iterator[str]) -> Iterator[dict]:
        for letter in letters:
            initial = "u" if (state["at"] - state["odd"]) % 2 == 0 else "a"
            yield blank | {"conv_id": conv, "at": state["at"], "edit": letter, "role": ROLE[initial], "text": ""}
            state["at"] += 1

    def opened() -> Iterator[dict]:
        """The report, once all segments are joined."""
        if not state["audit_known"]:
            report = state["whole"].report()
            state.update(audit_known=True, audit=report["audit"], p=0, at=0,
                         odd=(len(report["audit"]) - report["audit"].count("D")) % 2)
            yield blank | {"conv_id": conv, "at": -1, "report": json.dumps(report)}

    def closed() -> Iterator[dict]:
        yield from opened()
        yield from inserted(state["audit"][state["p"]:])

    for r in rows:
        if state is None or r["conv_id"] != conv:
            if state is not None:
                yield from closed()
            conv, state = r["conv_id"], {"whole": Whole(), "audit_known": False}
        if r["kind"] == 1:
            state["whole"].join(r["payload"])
        elif r["kind"] == 2:
            yield from opened()
            audit, p = state["audit"], state["p"]
            while audit[p] == "I":
                p += 1
            yield from inserted(audit[state["p"]:p])
            state["p"] = p + 1
            if audit[p] != "D":
                initial = "u" if (state["at"] - state["odd"]) % 2 == 0 else "a"
                role = r["role"] if audit[p] == "K" else ROLE[initial]
                yield blank | {"conv_id": conv, "at": state["at"], "edit": audit[p], "role": role, "text": r["text"]}
                state["at"] += 1
    if state is not None:
        yield from closed()


def repair(turns: DataFrame, all_ids: DataFrame | None = None) -> DataFrame:
    """The repaired turns of ``turns`` (conv_id, turn, role, text), columns ``REPAIRED``.

    Each conversation has one row with ``at`` -1 and a ``report`` (JSON: gaps,
    blank, duplicate, truncated, illegal, cost, audit), then its turns after the
    repair with their ``edit`` (K, R or I), in order within a partition. Null
    roles and texts count as one space; rows without a conversation id form one
    conversation, rows without a turn come first in theirs. Ids in ``all_ids``
    (conv_id) that have no row get a report of zeros. Any role that does not begin
    with s, u or a can only be deleted or replaced. Other columns are not read.
    """
    spark = turns.sparkSession
    text = F.coalesce(F.col("text"), F.lit(" "))
    given = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                         F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"), F.sha2(text, 256).alias("digest"))
    # The range cuts are drawn from a sample of the rows, so these are written once.
    cut = materialize(segments(materialize(facts(given), "repair_facts"), parallelism(spark)), "repair_segments")

    none = {c: F.lit(None).cast("string") for c in ("role", "digest", "text", "payload")}
    ids = given if all_ids is None else given.select("conv_id").union(all_ids.select(F.col("conv_id").cast("bigint")))
    heads = ids.select("conv_id").distinct().withColumns({"kind": F.lit(0), "turn": F.lit(None).cast("bigint"), **none})
    joined = cut.withColumns({"kind": F.lit(1), "turn": F.col("part"), **{k: v for k, v in none.items() if k != "payload"}}).drop("part")
    texts = given.withColumns({"kind": F.lit(2), "payload": none["payload"]})
    stream = heads.unionByName(joined).unionByName(texts).repartition(parallelism(spark), "conv_id")
    ordered = stream.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_repair(_rows(batches)), _REPAIRED)

    return ordered.select("conv_id", "kind", "role", "text", "payload").mapInArrow(run, REPAIRED)


_REPORT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])
REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _report(rows: Iterator[dict]) -> Iterator[dict]:
    now, digest = None, None
    for r in rows:
        if r["at"] < 0:
            if now is not None:
                yield now | {"repaired_sha256": digest.hexdigest()}
            now, digest = {"conv_id": r["conv_id"], **json.loads(r["report"])}, hashlib.sha256()
        else:
            digest.update(("\n" if r["at"] else "").encode() + f"{r['role']}:{r['text']}".encode("utf-8", "surrogatepass"))
    if now is not None:
        yield now | {"repaired_sha256": digest.hexdigest()}


def reports(repaired: DataFrame) -> DataFrame:
    """One row per conversation, columns ``REPORT``, read from what :func:`repair` returns (without another shuffle)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_report(_rows(batches)), _REPORT)

    return repaired.mapInArrow(run, REPORT)


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage to (conv_id, turn, role, text): by the checksum of ``conv_id:turn`` modulo 20 rows are
    dropped (0), emptied (1), lose their sentence signs (2), occur twice (3) or are the user's (4). Null is one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                        (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20).alias("_k")).filter("_k != 0")
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_k") == 4, "user").otherwise(F.col("role"))
    twice = F.explode(F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), twice.alias("_i")).drop("_i")


def op11_conversation_repair(spark, sf_dir):
    """The report of every conversation's repair after the contract's damage."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return reports(repair(damaged(given), given.select("conv_id")))
