"""Repaired conversations against a search over all edits."""

import hashlib
import heapq
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsift.llm import queries, repair

from ..conftest import SMALL

GOAL = re.compile(r"(s?(ua)+)?")
SHAPE = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind, role, text = crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        out.append((conv, turn, "user" if kind == 4 else role, text, {0: 0, 3: 2}.get(kind, 1)))
    return out


def cheapest(rows):
    """Cost and edits of rows (role, text, fault), by a search that takes the cheapest way so far, of equal ones the ASCII-least.

    Edits of one way are never the beginning of another equally cheap one's, so the first way that
    leaves the queue in this order is the wanted one.
    """
    todo, seen = [(0, "", 0, "")], set()
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    while todo:
        cost, edits, i, state = heapq.heappop(todo)
        if i == len(rows) and state in ("", "a"):
            return cost, edits
        if (i, state) in seen:
            continue
        seen.add((i, state))
        for kind in "ua":
            if (state, kind) in step:
                heapq.heappush(todo, (cost + 5, edits + "I", i, step[state, kind]))
        if i < len(rows):
            role, _, fault = rows[i]
            heapq.heappush(todo, (cost + 2, edits + "D", i + 1, state))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if (state, role[:1]) in step:
                    heapq.heappush(todo, (cost + extra, edits + "K", i + 1, step[state, role[:1]]))
                for kind in "ua":
                    if (state, kind) in step:
                        heapq.heappush(todo, (cost + extra + 1, edits + "R", i + 1, step[state, kind]))


def brute(rows):
    """conv_id -> the rest of the result, from damaged rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv for _ in range(r[4])]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256("\0".join((" " if conv is None else str(conv), r[2], r[3])).encode()).digest()))
        seen, marked = set(), []
        for _, _, role, text, _ in own:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
        cost, edits = cheapest(marked)
        lines, i, initials = [], 0, ""
        for e in edits:
            wanted = "assistant" if initials[-1:] == "u" else "user"
            role, text = ("", "") if e == "I" else marked[i][:2]
            i += e != "I"
            if e != "D":
                lines.append(f"{role if e == 'K' else wanted}:{text}")
                initials += lines[-1][0]
        assert GOAL.fullmatch(initials) and i == len(marked)
        turns = {r[1] for r in own} - {None}
        count = lambda f: sum(m[2] == f for m in marked)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count("blank"), count("duplicate"), count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(spark, rows):
    df = spark.createDataFrame(rows, SHAPE + ", times int").withColumns({c: F.lit(1) for c in ("digest", "flag", "part", "piece", "fault", "edits")}).repartition(3)
    got = repair.repair(df).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len(got) == len({r[0] for r in got})
    return {r[0]: tuple(r)[1:] for r in got}


def test_the_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in queries.op12_conversation_repair(spark, SMALL).collect()}
    assert got == brute(damaged(rows))


def talk(rng, n, conv=1, gap=1):
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Fine. ", "x"]
    return [(conv, rng.randrange(2 * n) if gap else i, rng.choice(["user", "assistant", "system", "tool", "", "u"]), rng.choice(texts) if rng.random() < 0.7 else f"Text {rng.randrange(10**6)}.", 1) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    rows = [r for c in range(60) for r in talk(rng, rng.randrange(1, 25), c, seed % 2)]
    assert repaired(spark, rows) == brute(rows)


def test_long_conversations_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE_ROWS", 7)
    monkeypatch.setattr(repair, "buckets_for", lambda *_: 9)
    rng = random.Random(8)
    rows = talk(rng, 700, 1) + talk(rng, 300, 2) + [r for c in range(3, 40) for r in talk(rng, rng.randrange(1, 9), c)]
    assert repaired(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long_ = "word " * 60_000 + "end."
    rows = [(None, None, None, None), (None, 1, "user", "Yes."), (1, None, "user", "Yes."), (1, None, "assistant", "No."), (1, 5, None, "Why?"), (1, 3, "user", None), (2, 0, "user", long_), (2, 1, "assistant", long_), (3, 1, "", ""), (4, 9, "user", "One."), (4, 9, "user", "One."), (4, 9, "assistant", "Two."), (5, -3, "system", "S."), (5, 4, "user", "Ä\u00a0"), (2**40, 2**40, "assistant", "A\x00b.")]
    rows = [(*r, 1) for r in [*rows, *rows]] + [(77, 1, "user", "gone", 0), (78, None, None, None, 0)]
    got = repaired(spark, rows)
    assert got == brute([(c, t, " " if r is None else r, " " if x is None else x, n) for c, t, r, x, n in rows])
    assert got[77] == got[78] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repaired(spark, rows[:0]) == {}


def test_grammar_changes_nothing(spark):
    """Sequences cost the same with rules as symbol by symbol, and rules shorten them."""
    rng = random.Random(4)
    sequences = [bytes(rng.choices(range(9), weights=[1, 1, 6, 6, 1, 1, 2, 2, 1], k=rng.randrange(60))) for _ in range(300)]
    grammar = repair.learn(spark.createDataFrame([(bytearray(s),) for s in sequences], "symbols binary"))
    plain = repair.Grammar([])
    short = grammar.compressed(sequences)
    assert len(grammar.rules) > 50 and sum(map(len, short)) < 0.6 * sum(map(len, sequences))
    for s, c in zip(sequences, short):
        assert repair.finish(grammar.after(repair.START, c)) == repair.finish(plain.after(repair.START, list(s)))


def test_runs_of_one_symbol_are_paired_from_the_left():
    grammar = repair.Grammar([(2, 2), (9, 9)])
    assert grammar.compressed([bytes([2] * n) for n in range(6)] + [bytes([2, 2, 3, 2, 2, 2])]) == [[], [2], [9], [9, 2], [10], [10, 2], [9, 3, 9, 2]]
    assert np.array_equal(repair.joined([b"\x01", b""]), [1, -1, -1])
