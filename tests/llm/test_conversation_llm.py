"""Conversation repair against enumeration of edits and a plain Python version."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from tidewater.llm import conversation_repair as cr

GOOD = re.compile(r"(s?(ua)+)?$")
ROWS = "conv_id long, turn long, role string, text string, key string, cost double"


def all_edits(symbols, inserts):
    """Every audit with at most so many inserts that gives roles in order, with its cost."""
    out = {}

    def go(i, left, roles, audit, cost):
        if i == len(symbols):
            if GOOD.match(roles):
                out[audit] = min(cost, out.get(audit, 99))
        if left:
            for r in "ua":
                go(i, left - 1, roles + r, audit + "I", cost + 2)
        if i < len(symbols):
            s = symbols[i]
            go(i + 1, left, roles, audit + "D", cost + 3)
            if s != cr.DROP:
                if s // 2 < 3:
                    go(i + 1, left, roles + "sua"[s // 2], audit + "K", cost + s % 2)
                for r in "ua":
                    go(i + 1, left, roles + r, audit + "R", cost + 2 + s % 2)

    go(0, inserts, "", "", 0)
    return min((c, a) for a, c in out.items())


@pytest.mark.parametrize("size", [0, 1, 2, 3])
def test_every_short_conversation(size):
    t = cr.tables()
    for symbols in itertools.product(range(9), repeat=size):
        assert t.repair(np.array(symbols, np.uint8)) == all_edits(symbols, 3), symbols


def plain_repair(symbols):
    """The same by a table of (cost, audit) over rows and states, one row at a time."""
    after = [(0, ""), (4, "II"), (2, "I"), (0, "")]
    for s in reversed(symbols):
        new = []
        for q in range(4):
            ways = [(after[q][0] + 3, "D" + after[q][1])]
            if s != cr.DROP:
                u = {0: 2, 1: 2, 2: 3, 3: 2}[q]
                ways.append((after[u][0] + 2 + s % 2, "R" + after[u][1]))
                to = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}.get((q, s // 2))
                if to:
                    ways.append((after[to][0] + s % 2, "K" + after[to][1]))
            new.append(min(ways))
        for _ in range(3):
            new = [min(new[q], (new[u][0] + 2, "I" + new[u][1])) for q, u in enumerate((2, 2, 3, 2))]
        after = new
    return after[0]


def test_long_conversations():
    rng, t = random.Random(1), cr.tables()
    assert len(t.vectors) < 40
    for _ in range(400):
        symbols = [rng.choice((0, 2, 2, 3, 4, 4, 5, 6, 8) if rng.random() < 0.9 else range(9)) for _ in range(rng.randrange(60))]
        assert t.repair(np.array(symbols, np.uint8)) == plain_repair(symbols)


def plain(rows, damaged=True):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20 if damaged else 9
        mine = out.setdefault(conv, [])
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            mine += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    result = {}
    for conv, mine in out.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, counts, symbols = set(), [0, 0, 0], []
        for _, role, text in mine:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not words else 1 if (role, text) in seen else 2 if words[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            symbols.append(8 if fault < 2 else 2 * ("sua".find(role[:1] or "x") % 4) + (fault == 2))
        initials = [r[1][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = plain_repair(symbols)
        left, at, made, state = list(mine), 0, [], 0
        for e in audit:
            if e in "IR":
                state = {0: 2, 1: 2, 2: 3, 3: 2}[state]
            if e == "I":
                made.append(("user" if state == 2 else "assistant") + ":")
                continue
            _, role, text = left[at]
            at += 1
            if e == "R":
                made.append(("user" if state == 2 else "assistant") + ":" + text)
            elif e == "K":
                state = "sua".index(role[0]) + 1
                made.append(f"{role}:{text}")
        result[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return result


def compare(spark, rows, damaged=True):
    frame = spark.createDataFrame([(*r, "k", 1.0) for r in rows], ROWS)
    got = cr.repair_conversations(cr.damage(frame) if damaged else frame)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = got.collect()
    assert len(found) == len({r[0] for r in rows})
    assert {r[0]: tuple(r)[1:] for r in found} == plain(rows, damaged)


def test_query_against_plain_python(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    found = E.queries()["op13_conversation_repair"](spark, sf).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == plain(rows)


def test_odd_conversations(spark):
    rng = random.Random(2)
    texts = ["Hello.", "No end", " ", "", None, "Why?\n", "a\t\x0b", "x" * 5000 + "!", "Hello.", "éü…", "日本."]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(["system", "user", "assistant", None, "", "tool", "User"]), rng.choice(texts))
            for c in [None, -1, 0, 1, 2, 3] for _ in range(rng.randrange(1, 14))]
    rows = sorted(set(rows), key=str)
    rows = [r for k, r in enumerate(rows) if not any(r[:3] == q[:3] for q in rows[:k])]  # order within a turn is by a hash
    compare(spark, rows, damaged=False)
    rows = [r for k, r in enumerate(rows) if not any(r[:2] == q[:2] for q in rows[:k])]  # damage changes roles
    compare(spark, rows)
    compare(spark, rows + rows[:9])  # repeated rows


def test_one_long_conversation(spark):
    rng = random.Random(3)
    rows = [(7, t, "user" if t % 2 == 0 or rng.random() < 0.1 else "assistant", f"Turn {rng.randrange(4000)}" + rng.choice("..!?a")) for t in range(6000)]
    compare(spark, rows + [(8, 0, "user", "Only this")])


def test_no_conversations(spark):
    frame = spark.createDataFrame([], ROWS)
    assert cr.repair_conversations(cr.damage(frame)).count() == 0
