"""Conversation repair against a search over all edit sequences, and its LR automaton."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from starloom.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, blank string, kind int"
ACCEPT = re.compile(r"(s?(ua)+)?\Z")
PREFIX = re.compile(r"(s?(ua)*u?)?\Z")


def cheapest(rows):
    """(cost, audit, text) by Dijkstra's search; rows are (role, text, must go, truncated)."""
    heap = [(0, "", 0, "", ())]
    seen = set()
    while heap:
        cost, audit, i, spelt, lines = heapq.heappop(heap)
        if i == len(rows) and ACCEPT.match(spelt):
            return cost, audit, "\n".join(lines)
        # what may follow depends on the last letter alone
        if (i, audit) in seen:
            continue
        seen.add((i, audit))
        if audit.count("I") < 2 * len(rows) + 2:
            for role in ("user", "assistant"):
                if PREFIX.match(spelt + role[0]):
                    heapq.heappush(heap, (cost + 2, audit + "I", i, spelt + role[0], (*lines, role + ":")))
        if i < len(rows):
            role, text, must_go, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, spelt, lines))
            if not must_go:
                if role[:1] and PREFIX.match(spelt + role[0]):
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, spelt + role[0], (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if PREFIX.match(spelt + new[0]):
                        heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, spelt + new[0], (*lines, f"{new}:{text}")))


def brute(rows):
    """conv_id -> the result row, from (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in kept if t is not None]
        seen, parsed, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in kept:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else \
                "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            parsed.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        letters = [r[:1] for _, r, _ in kept]
        cost, audit, text = cheapest(parsed)
        out[conv] = {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **faults,
                     "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(letters)),
                     "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)


def results(df):
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in df.collect()}


def some_rows(n, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "admin", None, "user", "assistant"]
    texts = ["Yes.", "no", "Well?\n", " \t\x0b", "", None, "Ja!", "Wait. \r", "é", "Good.\xa0", "0", "?"]
    return [(conv, rng.choice([None, 0, 1, 2, 3, 5, 8]), rng.choice(roles), rng.choice(texts))
            for conv in range(n) for _ in range(rng.randint(1, 5))]


def test_repair_equals_search(spark):
    rows = some_rows(220, 3) + [(None, 1, "user", "Hi."), (None, None, None, None)]
    got = results(C.repaired(C.damaged(frame(spark, rows))))
    want = brute(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == want[k], (k, [r for r in rows if r[0] == k])


def test_given_conversations(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = results(C.query(spark, d))
    want = brute(rows)
    assert got == want and len(got) == len({r[0] for r in rows})


def test_every_row_dropped_and_empty_table(spark):
    conv, turn = next((c, t) for c in range(500) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = results(C.repaired(C.damaged(frame(spark, [(conv, turn, "user", "Hi.")]))))
    assert got == {conv: {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                          "repaired_sha256": hashlib.sha256(b"").hexdigest()}}
    assert C.repaired(C.damaged(frame(spark, []))).count() == 0


def test_long_conversation():
    """A hundred thousand rows: a handful of tops, a byte per row and top."""
    talk = C.Conversation(C.Repair())
    n = 100_000
    for i in range(n):
        talk.row("assistant" if i % 2 else "user", "x" * 50 + ".", False, False)
        assert len(talk.tops) < 8
    cost, audit, _ = talk.result()
    assert (cost, audit) == (0, "K" * n)
    assert sum(map(len, talk.steps)) < 8 * n


@pytest.mark.parametrize("text", ["".join(x) for k in range(6) for x in itertools.product("sua", repeat=k)])
def test_automaton_accepts_the_grammar(text):
    repair = C.Repair()
    cell = repair.bottom
    for letter in text:
        cell = cell and repair.shifted(cell, letter)
    assert (cell is not None and repair.complete(cell)) == bool(ACCEPT.match(text))
