"""Operator 11 against exhaustive search on short conversations and a plain restatement of the contract."""

import hashlib
import itertools
import json
import random
import re
import zlib
from collections import defaultdict

import pytest

from trendcast.llm import conversation_repair as cr

TURNS = "conv_id bigint, turn bigint, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit) over every edit string with at most two inserts at a place; rows: (initial, must_go, truncated)."""
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        if any(x != "D" and r[1] for x, r in zip(letters, rows, strict=True)):
            continue
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * g + x for g, x in zip(gaps, [*letters, ""], strict=True))
            cost = sum(5 for x in audit if x == "I") + sum(
                {"K": 0, "R": 1, "D": 2}[x] + (5 if x != "D" and r[2] else 0) for x, r in zip(letters, rows, strict=True))
            if best is not None and (cost, audit) >= best:
                continue
            n = sum(x != "D" for x in audit)
            want = ("s" if n % 2 else "") + "ua" * (n // 2)
            if not PATTERN.fullmatch(want):
                continue
            at, fits = 0, True
            for x, r in zip(re.findall(r"I*[KRD]", audit), rows, strict=True):
                at += len(x) - 1
                if x[-1] == "K":
                    fits &= want[at] == r[0]
                elif x[-1] == "R":
                    fits &= want[at] in "ua"
                if x[-1] != "D":
                    fits &= all(c in "ua" for c in want[at - len(x) + 1:at])
                    at += 1
                else:
                    fits &= all(c in "ua" for c in want[at - len(x) + 1:at])
            if fits and all(c in "ua" for c in want[at:]):
                best = (cost, audit)
    return best


def by_segments(rows, cuts, modulus=cr.MODULUS):
    whole, start = cr.Whole(), 0
    for end in [*cuts, len(rows)]:
        seg = cr.Segment(range(4))
        seg.repairs = {s: cr.Repair(s, modulus) for s in range(4)}
        for initial, must_go, truncated in rows[start:end]:
            seg.add(None, initial, 1, must_go, truncated, False)
        if end > start:
            whole.join(seg.payload())
        start = end
    report = whole.report()
    return report["cost"], report["audit"]


@pytest.mark.parametrize("modulus", [cr.MODULUS, 3])
def test_cheapest_and_least_audit(modulus):
    """All rows at once or cut into segments, with sound hashes and with ones that collide all the time."""
    rng = random.Random(5)
    for _ in range(120):
        n = rng.randrange(5)
        rows = [(rng.choice("suaat "), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]
        rows = [(i, gone, cut and not gone) for i, gone, cut in rows]
        want = cheapest(rows)
        assert by_segments(rows, [], modulus) == want, rows
        assert by_segments(rows, sorted(rng.randrange(n + 1) for _ in range(2)), modulus) == want, rows


@pytest.mark.parametrize("modulus", [cr.MODULUS, 2, 5])
def test_audits_compare_like_their_strings(modulus):
    rng = random.Random(1)
    nodes = [cr.Audit(None, "")]
    for _ in range(300):
        nodes.append(cr.Audit(rng.choice(nodes[-20:]), rng.choice("DIKR"), modulus))
    for a, b in itertools.product(rng.sample(nodes, 60), repeat=2):
        assert cr.less(a, b) == (a.text() < b.text())
        assert a.ancestor(a.depth // 2).text() == a.text()[:a.depth // 2]


def plain(rows):
    """The contract on plain rows (conv_id, turn, role, text): {conv_id: report}."""
    after, ids = defaultdict(list), {r[0] for r in rows}
    spaced = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        role, text, k = spaced(role), spaced(text), zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        if k:
            after[conv] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = {}
    for conv in ids:
        got = sorted(after[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        turns = {t for t, _, _ in got if t is not None}
        seen, facts, counts = set(), [], [0, 0, 0]
        for _, role, text in got:
            body = text.rstrip(" \t\n\v\f\r")
            fault = 0 if not body.strip(" \t\n\v\f\r") else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            facts.append((role[:1], fault in (0, 1), fault == 2))
        # best[state] of the pattern's four states, as (cost, audit, roles)
        best = {0: (0, "", [])}
        step = lambda b, s, t, c, x, r: b.__setitem__(t, min(b.get(t, (1 << 60, "")), (s[0] + c, s[1] + x, s[2] + r)))
        speak = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}

        def inserts(b):
            for _ in range(2):
                for s, v in list(b.items()):
                    step(b, v, speak[s][0], 5, "I", [(speak[s][1], "")])
            return b

        for (initial, gone, cut), (_, role, text) in zip(facts, got, strict=True):
            new = {}
            for s, v in inserts(best).items():
                step(new, v, s, 2, "D", [])
                if not gone:
                    t, spoken = speak[s]
                    step(new, v, t, 1 + 5 * cut, "R", [(spoken, text)])
                    if initial == spoken[0] or (s == 0 and initial == "s"):
                        step(new, v, t if initial == spoken[0] else 1, 5 * cut, "K", [(role, text)])
            best = new
        cost, audit, repaired = min(v for s, v in inserts(best).items() if s in (0, 3))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(got, got[1:], strict=False)]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, sum(p not in ("su", "ua", "au") for p in pairs),
                     cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


def rows_of(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_query_matches_the_plain_restatement(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = cr.op11_conversation_repair(spark, sf_dir)
    got = rows_of(df)
    assert got == plain(rows) and len(got) == df.count() > 10


def test_nulls_ties_repeats_and_a_hot_conversation(spark):
    rng = random.Random(3)
    texts = ["", " \n", "Yes.", "No", "ok!", "tail ", "w " * 4000 + ".", None]
    rows = [(rng.choice([1, 2, None, 4, 4, 4, 4, 4]), rng.choice([None, *range(40)]), rng.choice(["system", "user", "assistant", "tool", None, ""]),
             rng.choice(texts)) for _ in range(600)]
    rows += [(4, 7, "user", "Yes.")] * 50 + [(5, None, "user", "Hi.")] + [(6, 2, "assistant", "Hi.")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS + ", audit string, kind int")
    want = plain(rows)
    got = rows_of(cr.reports(cr.repair(cr.damaged(df), df.select("conv_id"))))
    assert got == want


def test_repaired_turns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "Hello."), (1, 1, "user", "Why?"), (2, 0, "user", " ")], TURNS)
    got = sorted(tuple(r) for r in cr.repair(df).filter("at >= 0").select("conv_id", "at", "edit", "role", "text").collect())
    assert got == [(1, 0, "R", "user", "Hello."), (1, 1, "R", "assistant", "Why?")]
    reports = {r["conv_id"]: json.loads(r["report"]) for r in cr.repair(df).filter("at < 0").collect()}
    assert reports[2] == {"gaps": 0, "blank": 1, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 2, "audit": "D"}
    assert cr.reports(cr.repair(df.limit(0))).collect() == []
