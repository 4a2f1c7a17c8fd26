"""Groups of spelling variants: words that differ by one edit, found by pivotal grams.

Words are counted over all texts. Every word has its bigrams in an order common to all words, rare ones
first. Its *prefix* are the first three of them (with all that equal the third), its *pivots* two of these that
share no character and are rarest together, chosen by dynamic programming. One edit leaves at
least one pivot of either word alone; of two near words, at least one has a pivot that the other has in its
prefix. So pivots are indexed and other words look them up by their prefixes, and nothing else is compared.

Positions narrow the search: with one edit, all to the left of a gram that is left alone or all to the right
of it is equal, and of the side with the edit one half is. So a gram is looked up together with one whole side
and half of the other, in words of a length that differs by one at most. What that finds is confirmed by the edit
distance.

The only table held by every task are the counts of bigrams, at most 8,100 of an alphabet of 90 letters. Joins
shuffle both sides: a look-up table has twelve rows for one of the file it is made from.

Defined results: null and empty texts have no words, a null id counts as an empty text in the rule
that misspells. Repeated rows are counted as often as they are there. Other columns are not looked at; an empty
table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.llm.shared import on_workers, read, shuffled, stored, text_or_empty

#: A run of letters.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shortest word, and fewest occurrences of one.
MIN_LETTERS, MIN_COUNT = 6, 5
#: How many times as frequent as a word its form has to be.
RATIO = 5
#: One run in so many is misspelt by :func:`misspelt`.
TYPO_SHARE = 199
#: Letters in a gram, and grams in a prefix: one edit spoils two grams at most.
GRAM, PREFIX = 2, 3


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, run)``: each run of letters, its A-Z lower-cased; ids as text."""
    lower = F.translate(text_or_empty(text_col), UPPER, LOWER)
    return docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lower, F.lit(LETTERS), F.lit(0))).alias("run"),
    )


def misspelt(identifier: Column, run: Column) -> Column:
    """``run``, or ``run`` without one letter where a checksum of both says so."""
    h = F.crc32(F.concat(identifier, F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % TYPO_SHARE == 0, cut).otherwise(run)


def vocabulary(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the ``words`` (column ``word``, one row an occurrence) that are long and frequent enough."""
    long_enough = words.where(F.length("word") >= min_letters)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """Place of each gram in the common order; as many as the alphabet has pairs of letters."""
    at = F.sequence(F.lit(1), F.length("word") - GRAM + 1)
    grams = words.where(F.length("word") >= GRAM).select(
        F.explode(F.transform(at, lambda i: F.substring("word", i, F.lit(GRAM)))).alias("gram")
    )
    counts = grams.groupBy("gram").agg(F.count("*").alias("n")).collect()
    return {row["gram"]: rank for rank, row in enumerate(sorted(counts, key=lambda row: (row["n"], row["gram"])))}


def prefix_and_pivots(word: str, ranks: dict[str, int]) -> tuple[list[int], set[int]]:
    """Positions of the grams in the prefix of ``word``, and of the two among them that are its pivots."""
    found = sorted((ranks[word[p : p + GRAM]], p) for p in range(len(word) - GRAM + 1))
    last = found[min(PREFIX, len(found)) - 1][0]
    prefix = sorted((p, rank) for rank, p in found if rank <= last)
    # From left to right: the rarest single gram that ended before p, then the rarest pair that ends at p.
    best, single, waiting = None, None, []
    for p, rank in prefix:
        while waiting and waiting[0][1] + GRAM <= p:
            single = min(filter(None, (single, waiting.pop(0))))
        if single and (best is None or single[0] + rank < best[0]):
            best = (single[0] + rank, single[1], p)
        waiting.append((rank, p))
    return [p for p, _ in prefix], set(best[1:]) if best else set()


def grams_of(words: DataFrame) -> DataFrame:
    """``(word, n, p, pivot)``: the position of each gram in the prefix of a word."""
    ranks = gram_ranks(words)

    def run(batches):
        for batch in batches:
            at, places, pivot = [], [], []
            for row, word in enumerate(batch.column(0).to_pylist()):
                prefix, pivots = prefix_and_pivots(word, ranks)
                at += [row] * len(prefix)
                places += prefix
                pivot += [p in pivots for p in prefix]
            rows = batch.take(pa.array(at, pa.int32()))
            yield pa.record_batch(
                [*rows.columns, pa.array(places, pa.int32()), pa.array(pivot, pa.bool_())], ["word", "n", "p", "pivot"]
            )

    return words.select("word", "n").mapInArrow(run, "word string, n long, p int, pivot boolean")


def keyed(grams: DataFrame, word: str, n: str, own: str, other: str) -> DataFrame:
    """``(key, own, other, word, n)``: what each gram is looked up by, for a partner of ``other`` letters.

    A gram at ``p`` leaves ``m`` letters to its right in the shorter of the two words, ``q`` to its left. With the
    edit to the right, the letters up to the gram are equal, and with them the first half of the ``m`` letters or
    the last; with the edit to the left, all from the gram on, and half of the ``q``.
    """
    around = F.explode(F.array(*[F.length("word") + d for d in (-1, 0, 1)]))
    rows = grams.withColumn("other", around).withColumn("own", F.length("word"))
    short = F.least("own", "other")
    m, q, text, p = short - F.col("p") - GRAM, short - F.col("own") + F.col("p"), F.col("word"), F.col("p")
    first, last = (m / 2).cast("int"), (q / 2).cast("int")

    def start(length: Column) -> Column:
        return F.substring(text, F.lit(1), length)

    def end(length: Column) -> Column:
        return F.substring(text, F.col("own") - length + 1, length)

    bar = F.lit("|")
    right = [F.concat(F.lit("a"), start(p + GRAM + first)), F.concat(F.lit("b"), start(p + GRAM), bar, end(m - first))]
    left = [
        F.concat(F.lit("c"), start(last), bar, end(F.col("own") - p)),
        F.concat(F.lit("d"), end(F.col("own") - p + q - last)),
    ]
    nothing = F.array().cast("array<bigint>")
    keys = F.concat(
        F.when(m >= 0, F.array(*map(F.xxhash64, right))).otherwise(nothing),
        F.when(q >= 0, F.array(*map(F.xxhash64, left))).otherwise(nothing),
    )
    return rows.select(F.explode(keys).alias("key"), F.col("own").alias(own), F.col("other").alias(other), F.col("word").alias(word), F.col("n").alias(n))


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)``: all pairs of ``words`` (``word``, ``n``) that are one edit apart, both ways."""
    grams = stored(grams_of(words), "grams")
    pivots = keyed(grams.where("pivot"), "word", "n", "own", "other")
    prefixes = keyed(grams, "near", "near_n", "other", "own")
    maybe = pivots.join(shuffled(prefixes), ["key", "own", "other"]).where(
        (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)
    )
    one = maybe.select("word", "n", "near", "near_n")
    other = maybe.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return one.unionByName(other).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms`` (``word``, ``form``): the last of the forms from a word on.

    Each round doubles the steps taken. Forms are RATIO times as frequent, so there are few.
    """
    ups = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        nexts = ups.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = ups.join(shuffled(nexts), "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        jumped = stored(jumped, "roots")
        if not jumped.where("moved").limit(1).count():
            return jumped.select("word", "root")
        ups = jumped.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of all ``words`` (``word``, ``n``)."""
    words = stored(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    fits = -F.col("best.less") >= ratio * F.col("n")
    near = stored(
        near.select("word", "n_near", F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")),
        "near",
    )
    ends = roots(near.where(F.col("form").isNotNull()))
    return (
        words.join(shuffled(near), "word", "left")
        .join(shuffled(ends), "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_workers(spark)
    found = runs(read(spark, sf_dir, "documents"))
    return variants(vocabulary(found.select(misspelt(F.col("id"), F.col("run")).alias("word"))))
