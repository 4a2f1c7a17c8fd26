"""Conversation repair against brute force: costs and audits by dynamic programming over all edits."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import pytest

from __spark_entry__ import queries
from hourboard.llm import conversations

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def brute_damage(rows):
    for conv, turn, role, text in rows:
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if what == 1:
            text = ""
        if what == 2:
            text = re.sub("[.!?]", "", text)
        if what == 4:
            role = "user"
        yield from [(conv, turn, role, text, what != 0)] * (2 if what == 3 else 1)


def cheapest(rows):
    """Cost, audit and output of ``rows`` (role, text, fault)."""
    n, best = len(rows), {}
    accepted, follow = {"": "su", "s": "u", "u": "a", "a": "u"}, {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    for k in range(n, -1, -1):
        found = {state: [] for state in accepted}
        for state in accepted:
            if k == n and state in ("", "a"):
                found[state].append((0, "", []))
            if k < n:
                role, text, fault = rows[k]
                cost, audit, out = best[k + 1, state]
                found[state].append((2 + cost, "D" + audit, out))
                if fault not in ("blank", "duplicate"):
                    more = 5 if fault else 0
                    new = follow[state]
                    cost, audit, out = best[k + 1, new]
                    found[state].append((1 + more + cost, "R" + audit, [f"{names[new]}:{text}", *out]))
                    if role[:1] and role[0] in accepted[state]:
                        cost, audit, out = best[k + 1, role[0]]
                        found[state].append((more + cost, "K" + audit, [f"{role}:{text}", *out]))
        for _ in range(4):
            for state in accepted:
                for cost, audit, out in found[follow[state]][:]:
                    if len(audit) < 3 * n + 4:
                        found[state].append((5 + cost, "I" + audit, [f"{names[follow[state]]}:", *out]))
            found = {state: sorted(ways)[:1] for state, ways in found.items()}
        for state in accepted:
            best[k, state] = found[state][0]
    return best[0, ""]


def brute(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text, there in rows:
        by_conv[conv] += [(turn, role, text)] if there else []
    for conv, found in by_conv.items():
        found.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))
        seen, faulty = set(), []
        for _, role, text in found:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [turn for turn, _, _ in found if turn is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:]))
        counts = [sum(f == name for _, _, f in faulty) for name in ("blank", "duplicate", "truncated")]
        cost, audit, out = cheapest(faulty)
        yield conv, gaps, *counts, bad, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def rows_of(frame):
    assert frame.columns == NAMES
    return sorted((tuple(row) for row in frame.collect()), key=str)


def invented(seed, conversations_, rows, roles=("system", "user", "user", "assistant", "assistant", "tool", "", "u")):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "Why?", " \n", "", "Well then! ", "é…", "So be it.\t"]
    return [
        (rng.randrange(conversations_), rng.choice([None, *range(rows)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"t{k}.")
        for k in range(conversations_ * rows)
    ]


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert rows_of(queries()["op11_conversation_repair"](spark, SMALL)) == sorted(brute(brute_damage(map(tuple, rows))), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_invented(spark, seed):
    rows = invented(seed, 60, 7)
    expected = sorted(brute(brute_damage(rows)), key=str)
    assert rows_of(conversations.repair(conversations.damaged(spark.createDataFrame(rows, SCHEMA)))) == expected


@pytest.mark.parametrize("long, seed", [(3, 0), (5, 1), (5, 2), (1, 3)])
def test_long_conversations_in_segments(spark, monkeypatch, long, seed):
    rows = invented(seed, 4, 30) + [(9, k, "user", "Yes.") for k in range(40)] + [(8, 5, "user", "same.")] * 20 + [(None, None, "assistant", "x.")] * 9
    rows += [(11, k, "assistant", None) for k in range(12)]
    expected = sorted(brute(brute_damage(rows)), key=str)
    monkeypatch.setattr(conversations, "LONG", long)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(conversations.repair(conversations.damaged(docs))) == expected


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, None, "x."), (None, None, None, None), (2, None, "user", "a."), (2, None, "user", "a."),
        (3, 7, "assistant", "End. \x0b"), (3, -7, "assistant", "End.\x85"), (4, 1, "user", "long " * 300_000), (5, 2, "System", "a."),
        (6, 1, "", "."), (7, 0, "system", "s."), (8, 0, "system", "s."), (8, 1, "system", "t."), (8, 2, "user", "u."),
        *[(20 + k, 0, "user", "Hi.") for k in range(60)],
    ]
    frame = spark.createDataFrame([(*row, "x", None) for row in rows], SCHEMA + ", key string, there string")
    expected = sorted(brute(brute_damage(rows)), key=str)
    assert any(row[7] == "" and row[8] == hashlib.sha256(b"").hexdigest() for row in expected)
    assert rows_of(conversations.repair(conversations.damaged(frame))) == expected


def test_empty(spark):
    assert conversations.repair(conversations.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


@pytest.mark.parametrize("seed", range(40))
def test_auction_against_dynamic_programming(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["system", "user", "assistant", "x"]), "t", rng.choice([None, None, None, "blank", "truncated"])) for _ in range(rng.randint(0, 30))]
    sketch = "".join(conversations.encoded(role[:1], fault) for role, _, fault in rows)
    assert conversations.repaired(sketch) == cheapest(rows)[:2]


@pytest.mark.parametrize("seed", range(6))
def test_blocks_of_segments(monkeypatch, seed):
    """Borders priced block by block are those of one lattice."""
    monkeypatch.setattr(conversations, "BLOCK", 3)
    rng = random.Random(seed)
    pieces = ["".join(rng.choice(["sk", "uk", "ak", "xk", "ud", "at"]) for _ in range(rng.randint(1, 4))) for _ in range(40)]
    found = conversations.priced([conversations.transfers(piece) for piece in pieces], [0], conversations.TAIL_COST)
    assert len(found) == len(pieces) + 1
    for k in (0, 7, 20, 40):
        rest = "".join(pieces[k:])
        lattice = conversations.lattice_of(rest, {0: 0, 3: 0}, True)
        for state, price in found[k].items():
            assert lattice.auction(state) == price
    assert found[0][0] == conversations.repaired("".join(pieces))[0]


def test_worst_conversation_is_solved_soon():
    start = time.perf_counter()
    for sketch in ("uk" * conversations.LONG, "ak" * conversations.LONG, "ukukatsk" * (conversations.LONG // 4)):
        conversations.repaired(sketch)
    assert time.perf_counter() - start < 20
