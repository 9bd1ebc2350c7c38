"""Repair of conversations against a search over all edits, row by row."""

import hashlib
import heapq
import os
import random
import re
import zlib
from collections import defaultdict

import pytest

from sitewell.llm import conversations

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "conv_id long, turn long, role string, text string, place int, conv string, block string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def kinds(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        if bare:
            seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Dijkstra over (cost, edits, rows used, roles so far by their end)."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, edits, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, edits, "\n".join(f"{r}:{t}" for r, t in out)
        if (i, state) in done:
            continue
        done.add((i, state))
        then = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
        given = {"u": "user", "a": "assistant"}
        ways = [(2, "I", i, letter, (given[letter], "")) for letter in then if letter in given]
        if i < len(rows):
            _, role, text = rows[i]
            late = faults[i] == "truncated"
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, state, out))
            if faults[i] not in ("blank", "duplicate"):
                ways += [(late, "K", i + 1, letter, (role, text)) for letter in then if role[:1] == letter]
                ways += [(2 + late, "R", i + 1, letter, (given[letter], text)) for letter in then if letter in given]
        for more, edit, j, letter, line in ways:
            heapq.heappush(heap, (cost + more, edits + edit, j, then[letter], (*out, line)))


def wanted(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in damage(rows):
        groups[conv].append((turn, role, text))
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = kinds(mine)
        cost, edits, text = cheapest(mine, faults)
        turns = {t for t, _, _ in mine if t is not None}
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(k) for k in ("blank", "duplicate", "truncated")],
                    sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])), cost, edits,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def results(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(parts)
    got = conversations.query(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, got.collect()), key=repr)


def some(seed, conversations_, most):
    rng = random.Random(seed)
    texts = ["a b.", "a b", "", " \n", "q?", "c! \t", "d", None, "é日。", "x" * 5000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "s"]
    return [(conv, rng.choice([t, t, t, t + 3, None, -t]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"t{rng.random()}.")
            for conv in range(conversations_) for t in range(rng.randint(1, most))]


@pytest.mark.parametrize("bits", [0, 1, 7])
def test_equals_the_search(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = some(5, 60, 12) + [(None, t, "user", f"n{t}.") for t in range(4)] + [(10**17 + 1, None, None, None)]
    rows += [(777, t, "user" if t % 2 else "assistant", "w.") for t in range(40)]  # repeats of one text
    assert results(spark, rows) == wanted(rows)


def test_one_conversation_holds_most_rows(spark):
    rows = some(8, 10, 6) + [(3, 100 + t, ("user", "assistant", "user", "tool")[t % 4], f"t{t % 700}" + "." * (t % 3)) for t in range(1500)]
    rows += [(4, 7, "user", "the same.")] * 500
    assert results(spark, rows, 8) == wanted(rows)


def test_on_the_tables(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, conversations.query(table).collect()), key=repr) == wanted(rows)


def test_nothing_and_everything_dropped(spark):
    assert results(spark, []) == []
    dropped = [(c, t, "user", "a.") for c in range(300) for t in range(2) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert dropped and results(spark, dropped) == wanted(dropped)
    assert {r[6:8] for r in results(spark, dropped)} == {(0, "")}


def test_repaired_rows_follow_the_grammar(spark):
    rows = some(9, 40, 9)
    table = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    got = defaultdict(list)
    for r in conversations.repaired(table).orderBy("place").collect():
        assert r["text"] is not None and r["edit"] in "KRI" and (r["edit"] != "I" or r["text"] == "")
        got[r["conv_id"]].append(r["role"][:1])
    assert got and all(re.fullmatch("s?(ua)+", "".join(letters)) for letters in got.values())


def test_shared_ends_are_solved_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    plain = conversations.node

    def counted(symbol, rest):
        made.add(1)
        return plain(symbol, rest)

    monkeypatch.setattr(conversations, "node", counted)
    words = ["ua", "sua", "uua", "aua", "Uua", "xua", "uaua", "u"]
    signatures = spark.createDataFrame([(w,) for w in words * 50], "signature string").coalesce(1)
    got = {r["signature"]: r for r in conversations.automaton(signatures).coalesce(1).collect()}
    assert set(got) == set(words)
    assert made.value <= len({w[i:] for w in words for i in range(len(w))}) + 8  # ends at partition borders only


def test_no_task_holds_a_hot_conversation(spark):
    rows = spark.range(20_000).selectExpr("1 conv_id", "id turn", "'user' role", "concat('t', id, '.') text")
    at = conversations.placed(rows)
    assert conversations.blocks(conversations.faults(at)).selectExpr("max(length(signature))").first()[0] <= 128
