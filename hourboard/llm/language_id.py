"""Language identification by cross-parsing entropy.

The labelled text of each language is kept as a suffix automaton, which knows every string that
occurs in it. A text is parsed greedily: from where the last phrase ended, the longest string that
the language knows is the next phrase. The fewer phrases, the more alike text and language are; a
phrase costs the logarithm of the language's size, and costs are divided by the letters parsed. The
language with the least cost wins, of equals the first by name.

Phrases do not cross words, and a word is read with the space before and after it. So a text costs
what its words cost, each distinct word of a batch is parsed once per language, and an automaton
needs each learned word once only. Words are parsed side by side, a letter of each at a time.

The model is fitted on a bounded sample of the labelled rows: about MAX_DOCS documents a language,
those with the smallest hash of their id, and of them the MAX_WORDS commonest words. All of every text is
predicted from.

Defined results: ``und`` with score 0 for a text that is null, or has no letter, or if nothing could
be learned. The score is by how much the winner beats the runner-up, as a share of the latter's
cost (1 if there is no other language). Rows with a null label or text teach nothing. Null ids are
neither learned from nor held out. Other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourboard.llm.shared import read
from hourboard.llm.word_ids import slices

#: Documents a language is learned from, about.
MAX_DOCS = 1000
#: Distinct words of a language that are learned.
MAX_WORDS = 6000
#: Texts that are parsed at once: their words and what these cost are held.
PORTION = 512
#: Letters of the longest words that are parsed side by side; longer ones are parsed one by one.
LONGEST = 64
#: Documents whose id has this checksum remainder are held out.
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

CHARACTERS = 0x110000
IS_LETTER = np.zeros(CHARACTERS, bool)
IS_LETTER[[ord(c) for c in regex.findall(r"\p{L}", "".join(map(chr, range(CHARACTERS))))]] = True


class SuffixAutomaton:
    """All strings that occur in a text."""

    def __init__(self, text: str):
        nexts, links, lengths = [{}], [-1], [0]
        last = 0
        for letter in text:
            state = len(nexts)
            nexts.append({})
            lengths.append(lengths[last] + 1)
            links.append(0)
            at = last
            while at >= 0 and letter not in nexts[at]:
                nexts[at][letter] = state
                at = links[at]
            if at >= 0:
                other = nexts[at][letter]
                if lengths[other] == lengths[at] + 1:
                    links[state] = other
                else:
                    clone = len(nexts)
                    nexts.append(dict(nexts[other]))
                    lengths.append(lengths[at] + 1)
                    links.append(links[other])
                    while at >= 0 and nexts[at].get(letter) == other:
                        nexts[at][letter] = clone
                        at = links[at]
                    links[other] = links[state] = clone
            last = state
        self.nexts = nexts

    def phrases(self, text: str) -> int:
        """How many phrases ``text`` is parsed into; an unknown letter is a phrase."""
        nexts = self.nexts
        start = state = nexts[0]
        found = 0
        for letter in text:
            following = state.get(letter)
            if following is None:
                found += state is not start
                following = start.get(letter)
                found += following is None
            state = start if following is None else nexts[following]
        return found + (state is not start)

    def table(self, columns: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What follows a state and a letter: sorted ``state * width + column``, the states that follow, and the start's row."""
        keys = [state * width + columns[ord(c)] for state, following in enumerate(self.nexts) for c in following]
        targets = [target for following in self.nexts for target in following.values()]
        keys, targets = np.array(keys, np.int64), np.array(targets, np.int64)
        order = np.argsort(keys)
        keys, targets = keys[order], targets[order]
        firsts = np.zeros(width, np.int64)
        firsts[keys[keys < width]] = targets[keys < width]
        return keys, targets, firsts


def phrases_of(
    table: tuple[np.ndarray, np.ndarray, np.ndarray], letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray, space: int
) -> np.ndarray:
    """As :meth:`SuffixAutomaton.phrases`, of words at ``starts`` in ``letters`` (columns), the longest first, and spaces around them."""
    keys, targets, firsts = table
    states, found = np.full(len(starts), firsts[space]), np.zeros(len(starts), np.int64)

    def step(count: int, column: np.ndarray) -> None:
        wanted = states[:count] * len(firsts) + column
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        known = keys[at] == wanted
        again = firsts[column]
        # State 0, the start, follows on nothing.
        found[:count] += np.where(known, 0, (states[:count] > 0).astype(np.int64) + (again == 0))
        states[:count] = np.where(known, targets[at], again)

    for place in range(int(sizes[0]) if len(sizes) else 0):
        count = int(np.searchsorted(-sizes, -place))
        step(count, letters[starts[:count] + place])
    step(len(starts), np.full(len(starts), space))
    return found + (states > 0)


class CrossParser:
    """The languages learned, and what texts cost in each."""

    def __init__(self, learned: dict[str, list[str]]):
        self.names = sorted(learned)
        joined = {name: f" {' '.join(learned[name])} " for name in self.names}
        self.automata = [SuffixAutomaton(joined[name]) for name in self.names]
        self.prices = np.array([math.log2(max(2, len(joined[name]))) for name in self.names])
        alphabet = sorted(set(" ".join(joined.values())) | {" "})
        self.columns = np.zeros(CHARACTERS, np.int64)  # 0 for what no language has
        self.columns[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.tables = [automaton.table(self.columns, len(alphabet) + 1) for automaton in self.automata]

    def costs(self, words: list[str]) -> np.ndarray:
        """For each word, its letters and its phrases in each language."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        rows = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        solid = IS_LETTER[points]
        joins = solid[1:] & solid[:-1] & (rows[1:] == rows[:-1])
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~joins
        ends[:-1] &= ~joins
        starts = np.flatnonzero(begins)
        sizes = np.flatnonzero(ends) + 1 - starts
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        long = int(np.searchsorted(-sizes, -LONGEST))
        parts = [points[a : a + n].tobytes().decode("utf-32-le") for a, n in zip(starts[:long], sizes[:long], strict=True)]
        letters = self.columns[points]
        of = rows[starts]
        counts = [np.bincount(rows[solid], minlength=len(words))]
        for automaton, table in zip(self.automata, self.tables, strict=True):
            one_by_one = [automaton.phrases(f" {part} ") for part in parts]
            found = phrases_of(table, letters, starts[long:], sizes[long:], self.columns[ord(" ")])
            counts.append(np.bincount(of, np.concatenate([one_by_one, found]), len(words)).astype(np.int64))
        return np.stack(counts, 1)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        words = pc.utf8_split_whitespace(pc.utf8_lower(texts))
        flat = words.flatten().dictionary_encode()
        if isinstance(flat, pa.ChunkedArray):
            flat = flat.combine_chunks()
        costs = self.costs(flat.dictionary.to_pylist())
        sums = np.zeros((len(flat) + 1, costs.shape[1]), np.int64)
        np.cumsum(costs[flat.indices.to_numpy()], axis=0, out=sums[1:])
        edges = words.offsets.to_numpy() - words.offsets[0].as_py()
        totals = np.diff(sums[edges], axis=0)
        known = totals[:, 0] > 0
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        rates = totals[:, 1:] * self.prices / np.maximum(1, totals[:, :1])
        best = np.argmin(rates, axis=1)
        names = [self.names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        if len(self.names) == 1:
            return names, known.astype(float)
        first, second = np.partition(rates, 1, axis=1)[:, :2].T
        return names, np.where(known, (second - first) / np.where(known, second, 1), 0.0)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, list[str]]:
    """The commonest words of each language's sample; at most MAX_WORDS rows a language come to the driver."""
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    usable = usable.where(~held_out(id_col)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("key")
    )
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"))
    sample = usable.join(F.broadcast(sizes), "lang").where(  # one row a language
        F.pmod("key", F.lit(1 << 20)) < F.lit(float(MAX_DOCS << 20)) / F.col("n")
    )
    words = (
        sample.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
        .where("word <> ''")
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word")))
        .where(F.col("rank") <= MAX_WORDS)
        .select("lang", "word")
    )
    learned: dict[str, list[str]] = {}
    for lang, word in words.collect():
        learned.setdefault(lang, []).append(word)
    return {lang: sorted(found) for lang, found in learned.items()}


def identify(
    docs: DataFrame, learned: dict[str, list[str]], text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with the prediction and its score in two columns of these ``names``, which replace any there are."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)  # at most MAX_WORDS words a language
    text_at = docs.columns.index(text_col)
    others = [k for k, column in enumerate(docs.columns) if column not in names]
    schema = docs.select(*[docs.columns[k] for k in others], F.lit("").alias(names[0]), F.lit(0.0).alias(names[1])).schema

    def predict(batches):
        parser = None
        portions = (batch.slice(at, PORTION) for batch in slices(batches) for at in range(0, batch.num_rows, PORTION))
        for batch in portions:
            parser = parser or CrossParser(shared.value)
            predicted, scores = parser.predict(batch.column(text_at))
            yield pa.record_batch(
                [*(batch.column(k) for k in others), pa.array(predicted, pa.string()), pa.array(scores, pa.float64())],
                schema.names,
            )

    return docs.mapInArrow(predict, schema)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id_col, held_out, lang_pred, score)`` of every row."""
    learned = learn(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"), held_out(id_col).alias("held_out"))
    found = identify(rows, learned)
    return found.select(id_col, "held_out", "lang_pred", "score")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read(spark, sf_dir, "documents"))
