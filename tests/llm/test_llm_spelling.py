"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from __spark_entry__ import queries
from hourboard.llm import spelling

SMALL = "/root/testdata/sf0.001"
ASCII = str.maketrans(spelling.UPPER, spelling.LOWER)


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_variants(words):
    links = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(links[w]), words[form[w]] if form[w] else None))
    return rows


def rows_of(frame):
    found = [tuple(row) for row in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(queries()["op13_spelling"](spark, SMALL)) == brute_variants(brute_words(rows))


def test_odd_rows(spark):
    text = "Straße  naïve NAÏVE É×÷élan abcdef ABCDEF abcdeg xabcdef ÀÀÀÀÀÀ ààààÀÀ 日本語abcdefĀabcdef"
    rows = [(n % 7 or None, text, "x") for n in range(40)] + [(1, None, "x"), (2, "", None), (None, "abcdefg " * 9000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    found = spelling.runs(docs)
    words = spelling.vocabulary(found.select(spelling.misspelt(found.id, found.run).alias("word")))
    expected = brute_words([row[:2] for row in rows])
    assert {row.word: row.n for row in words.collect()} == expected
    assert rows_of(spelling.variants(words)) == brute_variants(expected)


def test_empty(spark):
    words = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(words).collect() == []


def test_chains_ties_and_repeated_letters(spark):
    words = {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaaaa": 200, "aaaaaaaaa": 1001, "aaaaab": 30, "aaaaba": 30, "ababab": 7, "bababa": 7}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = rows_of(spelling.variants(frame))
    assert found == brute_variants(words)
    assert ("aaaaaa", "aaaaaaa", "aaaaaaaaa", 5, 3, 30) in found


def test_all_near_words_of_short_alphabets(spark):
    """Few letters and all edits: grams that repeat, at both ends, and words that are near in several ways."""
    rng = random.Random(5)
    words = {}
    for _ in range(250):
        word = "".join(rng.choice("ab") for _ in range(rng.randint(6, 9)))
        at, letter = rng.randrange(len(word)), rng.choice("abc")
        for other in (word, word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]):
            if len(other) >= 6:
                words[other] = rng.choice([5, 6, 40, 41, 300])
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(spelling.variants(frame)) == brute_variants(words)


@pytest.mark.parametrize("word", ["abcdef", "aaaaaa", "abcabcabc"])
def test_pivots_are_the_rarest_disjoint_pair_of_the_prefix(word):
    ranks = {g: r for r, g in enumerate(sorted({word[p : p + 2] for p in range(len(word) - 1)}, key=lambda g: zlib.crc32(g.encode())))}
    prefix, pivots = spelling.prefix_and_pivots(word, ranks)
    cost = {p: ranks[word[p : p + 2]] for p in prefix}
    best = min(cost[p] + cost[q] for p in prefix for q in prefix if q - p >= 2)
    a, b = sorted(pivots)
    assert b - a >= 2 and cost[a] + cost[b] == best


def test_words_are_not_broadcast(spark, monkeypatch):
    """Neither what is looked up nor the words themselves, whatever size Spark takes them for."""
    plans = []

    def plan_of(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return frame

    monkeypatch.setattr(spelling, "stored", lambda frame, name, stored=spelling.stored: stored(plan_of(frame), name))
    words = spark.createDataFrame([("lantern", 900), ("lantrn", 100), ("lanern", 5), ("garden", 7)], "word string, n long")
    found = plan_of(spelling.variants(words)).collect()
    assert {r.word: r.root for r in found} == {"lantern": "lantern", "lantrn": "lantern", "lanern": "lantern", "garden": "garden"}
    assert sum(p.count("SortMergeJoin") for p in plans) >= 4 and not any("Broadcast" in p for p in plans)
