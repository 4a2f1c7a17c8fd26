"""Substring dedup against brute force over all windows."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from __spark_entry__ import queries
from hourboard.llm import repeats
from hourboard.llm.near_dedup import words_of

SMALL = "/root/testdata/sf0.001"


def brute(rows, width=13):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, words in texts:
        for k in range(len(words) - width + 1):
            if i is not None:
                key = tuple(words[k : k + width])
                least[key] = min(least.get(key, i), i)
    found = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - width + 1):
            if i is not None and least[tuple(words[k : k + width])] < i:
                gone |= set(range(k, k + width))
        found.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(found, key=str)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(rows)]
    assert sum(row[2] for row in expected) > 0
    assert rows_of(queries()["op12_substring_dedup"](spark, SMALL)) == sorted(expected, key=str)


def passages(seed, words, alphabet):
    """Texts that share passages, some of them with themselves, over few words."""
    rng = random.Random(seed)
    parts = [[rng.choice(alphabet) for _ in range(rng.randint(1, 30))] for _ in range(12)]
    rows = []
    for _ in range(60):
        text = []
        while len(text) < words:
            text += rng.choice(parts) if rng.random() < 0.6 else [rng.choice(alphabet)] * rng.randint(1, 20)
        rows.append((rng.randint(-5, 40), rng.choice([" ", "\n", "  \t"]).join(text[: rng.randint(0, words)])))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_passages_and_runs(spark, monkeypatch, seed):
    monkeypatch.setattr(repeats, "UNIT_BYTES", 300)
    alphabet = ["a", "b", "É", "ccc"][: 2 + seed] if seed < 3 else [f"w{k}" for k in range(400)]
    rows = passages(seed, 90, alphabet)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(repeats.without_repeats(docs)) == brute(rows)
    assert rows_of(repeats.without_repeats(docs, width=4, rounds=(1, 2))) == brute(rows, 4)


def test_odd_rows(spark):
    shared = " ".join(f"word{k}" for k in range(40))
    rows = [
        (1, shared), (1, shared), (2, shared), (None, shared), (None, None), (3, None), (4, ""), (5, " \t\n\x0b\x0c\r "),
        (6, f"x {shared} y z\x85 日本"), (-9, "lead " + shared[:200]), (7, "same " * 5000), (8, "same " * 13),
        (9, "same " * 12), (10, "same " * 20_000 + shared), (11, "a" * 300_000),
    ]
    schema = "doc_id long, text string, unit string, place string, kind string, id string, mark string"
    docs = spark.createDataFrame([(*row, None, "1", None, "x", "y") for row in rows], schema)
    assert rows_of(repeats.without_repeats(docs)) == brute(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.without_repeats(docs).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_symbols_follow_from_the_words_in_their_reach(seed):
    """Equal words in reach have equal symbols, wherever they are; that is what windows are closed by."""
    rng = random.Random(seed)
    alphabet = "ab" if seed % 2 else "abcdefgh"
    texts = [" ".join(rng.choice(alphabet) * rng.choice([1, 1, 1, 2]) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    texts += [rng.choice(texts) + " a b " + rng.choice(texts) for _ in range(40)]
    words, rows = words_of(pa.array(texts), repeats.AS_IT_IS)
    spans = defaultdict(list)
    found = list(repeats.levels(words, rows, 4))
    for level, (name, low, high) in enumerate(found):
        inside = (low >= 0) & (high <= len(words))
        for n, a, b in zip(name[inside].tolist(), low[inside].tolist(), high[inside].tolist()):
            spans[level, tuple(words[a:b])].append((n, a))
    for (level, piece), symbols in spans.items():
        wanted = {n for n, _ in symbols}
        at = np.flatnonzero(words == piece[0])
        for a in at[at + len(piece) <= len(words)].tolist():
            if rows[a] == rows[a + len(piece) - 1] and tuple(words[a : a + len(piece)]) == piece:
                assert wanted <= {n for n, b in symbols if b == a}
