"""Conversation repair against a plain search over whole edit sequences."""

import hashlib
import random
import zlib

import pytest
from helpers import SMALL, rows_of

from shelfwise.llm import conversations as conv
from shelfwise.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
STEP = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
MADE = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def plain(rows):
    """The figures of one conversation's (turn, role, text), in order: of every state the best
    (cost, audit, lines) of what is left, from the last row to the first."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen
                      else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    def with_inserts(best):
        for _ in range(4):
            for q, (n, role) in MADE.items():
                if n in best:
                    cost, audit, lines = best[n]
                    made = (cost + 3, "I" + audit, (role + ":", *lines))
                    best[q] = min(best.get(q, made), made)
        return best

    best = with_inserts({0: (0, "", ()), 3: (0, "", ())})
    for (_, role, text), fault in zip(reversed(rows), reversed(faults)):
        before = {}
        for q in range(4):
            cost, audit, lines = best[q]
            options = [(cost + 4, "D" + audit, lines)]
            extra = 3 if fault == "truncated" else 0
            if fault not in ("blank", "duplicate"):
                if role[:1] in STEP[q]:
                    cost, audit, lines = best[STEP[q][role[:1]]]
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                n, name = MADE[q]
                cost, audit, lines = best[n]
                options.append((cost + extra + 3, "R" + audit, (f"{name}:{text}", *lines)))
            before[q] = min(options)
        best = with_inserts(before)
    cost, audit, lines = best[0]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost,
            audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def order(row):
    turn, role, text = row
    digest = hashlib.md5(f"{role}:{text}".encode()).hexdigest()
    return turn is not None, turn or 0, int(digest[:15], 16)


def plain_repair(rows):
    """From (key, turn, role, text)."""
    found = {}
    for key, turn, role, text in rows:
        own = found.setdefault(key, [])
        own.append((turn, " " if role is None else role, " " if text is None else text))
    return sorted(((k, *plain(sorted(v, key=order))) for k, v in found.items()), key=repr)


def made_up(seed, conversations, longest):
    lot = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None]
    texts = ["Yes.", "No", "why?", " \t", "", "a!\n", "b c.", "é", None]
    return [
        (key, lot.choice([None, *range(30)]), lot.choice(roles),
         lot.choice(texts) if lot.random() < 0.5 else f"{lot.random()}{lot.choice(['.', ''])}")
        for key in conversations for _ in range(lot.randint(1, longest))
    ]


def test_block_tables_follow_single_rows():
    tables = conv.Tables()
    lot = random.Random(3)
    for _ in range(300):
        marks = bytes(lot.randrange(conv.SYMBOLS) for _ in range(lot.randint(0, 11)))
        vector, cost = 0, 0
        for mark in reversed(marks):
            cost += int(tables.row_cost[vector, mark])
            vector = int(tables.row_next[vector, mark])
        assert tables.backward(marks, 0)[1:] == (vector, cost)


def test_equals_brute_force(spark):
    rows = made_up(1, range(400), 12)
    found = conv.repair(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(found) == plain_repair(rows)


@pytest.mark.parametrize("chunk", [3, 50])
def test_a_conversation_with_most_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(conv, "CHUNK_ROWS", chunk)
    rows = made_up(2, [5] * 120 + [None] * 40 + list(range(20)), 9)
    found = conv.repair(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert rows_of(found) == plain_repair(rows)


def test_edges(spark):
    empty = conv.repair(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["conv_id", *conv.FIGURE_NAMES] and empty.count() == 0
    rows = [
        (1, None, None, None), (2, 0, "user", "x" * 300_000 + "."), (2, 0, "user", "x" * 300_000 + "."),
        (None, None, "system", "."), (3, 7, "assistant", "?"), (4, 1, "s", "a."), (4, 1, "s", "b."),
    ]
    extra = [(*r, "audit", 1.0) for r in rows]
    frame = spark.createDataFrame(extra, SCHEMA + ", audit string, `a.b` double")
    assert rows_of(conv.repair(frame)) == plain_repair(rows)
    nothing = spark.createDataFrame([(9, 1, "user", "a.", False)], SCHEMA + ", present boolean")
    got = rows_of(conv.repair(nothing, present="present"))
    assert got == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    odd = frame.toDF("a.b", "audit", "cost", "role", "x", "y")
    clash = conv.repair(odd, conv="cost", turn="audit", role="role", text="x")
    assert clash.columns == ["cost", *(c + "_" * (c == "cost") for c in conv.FIGURE_NAMES)]


def test_query_equals_brute_force(spark):
    kept, keys = [], set()
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        key, turn, role, text = r.conv_id, r.turn, r.role, r.text
        keys.add(key)
        lot = zlib.crc32(f"{key}:{turn}".encode()) % 20
        role = "user" if lot == 4 else role
        text = "" if lot == 1 else text.translate({ord(c): None for c in ".!?"}) if lot == 2 else text
        kept += [(key, turn, role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = plain_repair(kept) + [(k, *nothing) for k in keys - {r[0] for r in kept}]
    assert rows_of(queries.op12_conversations(spark, SMALL)) == sorted(want, key=repr)
