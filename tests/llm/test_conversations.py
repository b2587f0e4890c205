"""Conversation repair against trying every sequence of edits, and its edge cases."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest
from llm_helpers import table_of
from pyspark.sql import functions as F

from clickweir.llm import conversations as c
from clickweir.llm import queries as registered

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def legal(initials: str) -> bool:
    body = initials.removeprefix("s")
    return initials == "" or (body != "" and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))


def tried_out(symbols: bytes, inserts: int = 2) -> tuple[int, str]:
    """Every choice of an edit for each row and of up to so many insertions before each."""
    best = None
    gaps = [
        [g for n in range(inserts + 1) for g in itertools.product("ua", repeat=n)]
        for _ in range(len(symbols) + 1)
    ]
    for edits in itertools.product("DKua", repeat=len(symbols)):
        if any(e != "D" and s == c.DELETED for e, s in zip(edits, symbols)):
            continue
        if any(e == "K" and s // 2 == 3 for e, s in zip(edits, symbols)):
            continue
        for put in itertools.product(*gaps):
            initials, audit, cost = [], [], 0
            for place in range(len(symbols) + 1):
                for letter in put[place]:
                    initials.append(letter)
                    audit.append("I")
                    cost += 5
                if place == len(symbols):
                    break
                edit, symbol = edits[place], symbols[place]
                if edit == "D":
                    audit.append("D")
                    cost += 2
                    continue
                cost += 5 * (symbol % 2)
                if edit == "K":
                    audit.append("K")
                    initials.append("sua"[symbol // 2])
                else:
                    audit.append("R")
                    initials.append(edit)
                    cost += 1
            if legal("".join(initials)):
                best = min(best or (cost, "".join(audit)), (cost, "".join(audit)))
    return best


def test_every_short_conversation():
    for size in range(3):
        for symbols in itertools.product(range(9), repeat=size):
            assert c.cheapest_edits(bytes(symbols)) == tried_out(bytes(symbols)), symbols


def test_random_conversations():
    pick = random.Random(5)
    for _ in range(25):
        symbols = bytes(pick.choice((0, 2, 2, 3, 4, 4, 5, 6, 8)) for _ in range(3))
        assert c.cheapest_edits(symbols) == tried_out(symbols), symbols


def row_by_row(symbols: bytes) -> tuple[int, str]:
    """The cheapest (cost, audit) of each state, one row after another."""
    states = {0: (0, "")}

    def put(into, state, value):
        into[state] = min(into.get(state, value), value)

    def inserted(states):
        for _ in range(2):
            more = dict(states)
            for state, (cost, audit) in states.items():
                put(more, c.DUE[state], (cost + 5, audit + "I"))
            states = more
        return states

    for symbol in symbols:
        after: dict = {}
        for state, (cost, audit) in inserted(states).items():
            put(after, state, (cost + 2, audit + "D"))
            if symbol != c.DELETED:
                more = 5 * (symbol % 2)
                put(after, c.DUE[state], (cost + 1 + more, audit + "R"))
                if (state, symbol // 2) in c.KEPT:
                    put(after, c.KEPT[state, symbol // 2], (cost + more, audit + "K"))
        states = after
    return min(v for s, v in inserted(states).items() if s in (0, 3))


@pytest.mark.parametrize("seed", range(6))
def test_long_runs_and_blocks(seed, monkeypatch):
    monkeypatch.setattr(c, "RUNS", 7)  # several blocks of runs
    pick = random.Random(seed)
    symbols = b"".join(bytes([pick.randrange(9)]) * pick.choice((1, 1, 2, 3, 40)) for _ in range(30))
    assert c.cheapest_edits(symbols) == row_by_row(symbols)


def plain_repair(rows):
    """The contract, spelled out for one conversation's damaged rows (turn, role, text)."""
    blanks = " \t\n\x0b\f\r"
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(blanks)
        if not body:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif body[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))
    symbols = bytes(
        8 if f in ("blank", "duplicate") else 2 * ("sua".find(r[:1]) if r[:1] in set("sua") else 3)
        + (f == "truncated")
        for (_, r, _), f in zip(rows, faults)
    )
    cost, audit = row_by_row(symbols)
    lines, state, left = [], 0, iter(zip(rows, symbols))
    for edit in audit:
        if edit == "I":
            lines.append(c.DUE_ROLE[state] + ":")
            state = c.DUE[state]
            continue
        (_, role, text), symbol = next(left)
        if edit == "K":
            lines.append(f"{role}:{text}")
            state = c.KEPT[state, symbol // 2]
        elif edit == "R":
            lines.append(f"{c.DUE_ROLE[state]}:{text}")
            state = c.DUE[state]
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def plainly_damaged(rows):
    """conv_id -> rows in order, and all conversations."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(name.encode()) % 20
        out[conv] += []
        if fate == 1:
            text = ""
        elif fate == 2:
            text = "".join(x for x in text if x not in ".!?")
        elif fate == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {
        k: sorted(
            v, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(
                f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest())
        )
        for k, v in out.items()
    }


def expected(rows):
    return {k: plain_repair(v) for k, v in plainly_damaged(rows).items()}


def found(frame):
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in frame.collect()}


def test_query_equals_the_rules_spelled_out(spark, sf_dir):
    rows = [tuple(r) for r in registered.table(spark, sf_dir, "conversations").collect()]
    assert found(registered.op11_conversation_repair(spark, sf_dir)) == expected(rows)


def test_nulls_ties_repeats_and_clashing_names(spark, tmp_path):
    pick = random.Random(3)
    texts = ["Yes.", "no", None, "", " \t", "Why?\n", "a. b", "Ünï!", "x\x0b", "End. \r\n"]
    rows = [
        (
            pick.choice([None, 1, 2, 3, 4, -5]), pick.choice([None, 0, 1, 2, 3, 7]),
            pick.choice(["user", "assistant", "system", None, "", "tool", "User", "über"]),
            pick.choice(texts),
        )
        for _ in range(150)
    ]
    rows += [(9, t, "user" if t % 2 else "assistant", "word " * 30000 + str(t) + ".") for t in range(6)]
    rows += [(10, t, None, None) for t in range(3)] + [(11, 1, "user", "A."), (11, 1, "user", "A.")]
    names = "kind symbol fault name present digest again body_bytes ended position edit audit".split()
    path = table_of(spark, tmp_path, "conversations", rows, SCHEMA, names)
    assert found(registered.op11_conversation_repair(spark, path)) == expected(rows)


def test_small_arrow_batches_give_the_same(spark, sf_dir):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    whole = found(registered.op11_conversation_repair(spark, sf_dir))
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        assert found(registered.op11_conversation_repair(spark, sf_dir)) == whole
    finally:
        spark.conf.set(name, before)


def test_no_rows_and_conversations_without_rows(spark, tmp_path):
    path = table_of(spark, tmp_path, "conversations", [], SCHEMA)
    assert registered.op11_conversation_repair(spark, path).collect() == []
    rows = [(i, 0, "user", "Hi.") for i in range(60)]
    dropped = [i for i, *_ in rows if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    path = table_of(spark, tmp_path / "more", "conversations", rows, SCHEMA)
    got = found(registered.op11_conversation_repair(spark, path))
    assert len(got) == 60 and dropped
    nothing = dict(gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0)
    for i in dropped:
        assert got[i] == {**nothing, "audit": "", "repaired_sha256": EMPTY}


def test_repaired_rows_have_the_digest(spark, sf_dir):
    rows = c.damaged(registered.table(spark, sf_dir, "conversations"))
    lines = defaultdict(list)
    for r in c.repaired(rows, present=F.col("present")).collect():
        lines[r["conv_id"]].append((r["position"], f"{r['role']}:{r['text']}"))
        assert r["edit"] in "KRI"
    for r in c.repair(rows, present=F.col("present")).collect():
        own = [text for _, text in sorted(lines.get(r["conv_id"], []))]
        assert hashlib.sha256("\n".join(own).encode()).hexdigest() == r["repaired_sha256"]
        assert legal("".join(x[:1] for x in own))
