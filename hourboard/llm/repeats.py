"""Substring dedup: words of passages that an earlier document has too, found by recompression.

A window is ``width`` consecutive words of a document. It is a repeat if its words also start in
a document of a smaller id; the words of repeats are removed. All is judged on the input.

Recompression rewrites the sequence of words level by level. At each level the symbols are split in two
halves by a hash; a symbol of the one half followed by one of the other becomes a pair, and a run of equal
symbols that are left becomes one symbol. A name is a 64-bit hash of what it stands for, so all tasks name
alike. Equal passages thus have equal symbols inside; only at their borders does what lies
outside matter. Each symbol comes with its *reach*: the words that have to be there for it to be there.

Rounds of Spark jobs find the symbols that are shared, from level to level (:data:`ROUNDS`): every unit (some
megabyte of texts) names the symbols of what is still open, a shuffle by name tells which ones another document
has, and a window that holds the whole reach of a symbol nobody else has is no repeat. What is left is
verified: a shuffle by digest (96 bits) of the windows' bytes finds the smallest id of each.

Texts are moved once only, into a table bucketed by unit; what the rounds find comes back to it by unit. A name
goes out once a unit, or twice where documents of it share it, so the rows of a frequent one are
as many as the units at most. Of equal texts only the one with the smallest id takes part; the
others have all their words removed, if they have a window.

Defined results: null, empty and wordless texts have no words. A null id is not smaller or larger than any: such
rows keep all and take nothing. Repeated rows (same id) do not count as other documents. Other columns are
not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourboard.llm.near_dedup import EVEN, mixed, words_of
from hourboard.llm.shared import join_unique, on_workers, read, shared_path, shuffle_partitions, stored

#: Words in a window.
WIDTH = 13
#: Levels of symbols that are looked up, a round each.
ROUNDS = (3, 4)
#: Bytes of text in a unit, if more than one text.
UNIT_BYTES = 1 << 20
AS_IT_IS = np.arange(256, dtype=np.uint8)
FAR = 1 << 40
#: What comes back to a unit: texts to judge, copies of others, shared names of a level (on top), windows to remove.
JUDGED, COPY, REMOVED, SHARED = 0, 1, 2, 10
SIDE = "unit long, kind int, value long, at binary"


def levels(words: np.ndarray, rows: np.ndarray, last: int):
    """``(name, first, last)`` arrays of the symbols of each level up to ``last``: names and the words in reach, [first, last).

    ``rows`` says which text a word is from; a reach beyond the ends of a text lies at or beyond +-FAR.
    """
    name, row = words, rows
    low = np.arange(len(words), dtype=np.int64)
    high = low + 1
    for level in range(1, last + 1):
        size = len(name)
        same = np.zeros(size + 1, bool)  # symbol k is of the text that symbol k - 1 is of
        same[1:size] = row[1:] == row[:-1]
        left = (mixed(name + np.uint64(level * int(EVEN) % (1 << 64))) & np.uint64(1)).astype(bool)
        pair = np.zeros(size, bool)
        pair[:-1] = left[:-1] & ~left[1:] & same[1:size]
        second = np.zeros(size, bool)
        second[1:] = pair[:-1]
        free = ~pair & ~second
        equal = np.zeros(size + 1, bool)
        equal[1:size] = same[1:size] & (name[1:] == name[:-1])
        # Of a symbol left over, the neighbours say that it is, and their neighbours if equal.
        before, after = np.full(size, -FAR), np.full(size, FAR)
        before[1:] = np.where(same[1:size], low[:-1], -FAR)
        after[:-1] = np.where(same[1:size], high[1:], FAR)
        before = np.where(equal[:size], np.concatenate([[-FAR], before[:-1]]), before)
        after = np.where(equal[1:], np.concatenate([after[1:], [FAR]]), after)
        low_of = np.where(free, np.minimum(low, before), low)
        high_of = np.where(free, np.maximum(high, after), high)
        new = name.copy()
        at = np.flatnonzero(pair)
        new[at] = mixed(mixed(name[at] + EVEN) + name[at + 1] * np.uint64(3))
        inner = equal[:size] & free & np.concatenate([[False], free[:-1]])
        starts = np.flatnonzero(~second & ~inner)
        counts = np.diff(np.concatenate([starts, [size]]))
        name = new[starts]
        run = (counts > 1) & free[starts]
        name[run] = mixed(name[run] ^ mixed(counts[run].astype(np.uint64) * EVEN))
        low, high = np.minimum.reduceat(low_of, starts), np.maximum.reduceat(high_of, starts)
        row = row[starts]
        yield name, low, high


class Unit:
    """The judged texts of a unit as words, and which windows may still be repeats."""

    def __init__(self, texts: pa.Table, side: pa.Table, width: int):
        self.texts = texts.combine_chunks().sort_by("place")
        self.number = self.texts.column("unit")[0].as_py() if len(texts) else None
        self.kinds, self.values = side.column("kind").to_numpy(), side.column("value").to_numpy()
        self.judged = np.isin(np.arange(len(texts)), self.values[self.kinds == JUDGED])
        self.width = width
        words, rows = words_of(self.texts.column("text").combine_chunks(), AS_IT_IS)
        taken = self.judged[rows]
        self.words, self.rows = words[taken], rows[taken]
        self.open = np.zeros(len(self.words), bool)
        if len(self.words) >= width:
            self.open[: len(self.words) - width + 1] = self.rows[: len(self.words) - width + 1] == self.rows[width - 1 :]

    def around(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """How many of the spans [first, last) of words the window at each word holds."""
        change = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(change, np.maximum(last - self.width, 0), 1)
        np.add.at(change, first + 1, -1)
        return np.cumsum(change)[:-1]

    def close(self, last: int, rounds) -> tuple[np.ndarray, np.ndarray]:
        """Closes windows by the names found shared; ``(name, row)`` of the symbols of level ``last`` in open ones."""
        names, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if not self.open.any():
            return names, rows
        for level, (name, low, high) in enumerate(levels(self.words, self.rows, max((last, *rounds))), 1):
            if level != last and level not in rounds:
                continue
            fits = (high - low <= self.width) & (low >= 0) & (high <= len(self.words))
            name, low, high = name[fits], low[fits], high[fits]
            if level in rounds:
                shared = np.unique(self.values[self.kinds == SHARED + level])
                alone = ~np.isin((name >> np.uint64(32)).astype(np.int64), shared)
                self.open &= self.around(low[alone], high[alone]) == 0
            if level == last:
                total = np.concatenate([[0], np.cumsum(self.open)])
                near = total[low + 1] > total[np.maximum(high - self.width, 0)]
                names, rows = name[near], self.rows[low[near]]
        return names, rows


def by_unit(texts: DataFrame, side: DataFrame, run, schema: str) -> DataFrame:
    """``run(texts, side)`` of every unit, as Arrow tables."""
    return texts.groupBy("unit").cogroup(side.groupBy("unit")).applyInArrow(run, schema)


def units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(unit, place, id, mark, text)``: the texts in units, bucketed by unit; ``mark`` is a digest of the text."""
    spark = docs.sparkSession

    def run(batches):
        unit, count, held = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            numbers, places = [], []
            for size in sizes:
                if count and (held + size > UNIT_BYTES or count >= 4096):
                    unit, count, held = unit + 1, 0, 0
                numbers.append(unit)
                places.append(count)
                count, held = count + 1, held + size
            marks = [hashlib.sha256((text.as_py() or "").encode()).digest() for text in batch.column(1)]
            columns = [pa.array(numbers, pa.int64()), pa.array(places, pa.int64()), batch.column(0), pa.array(marks, pa.binary())]
            yield pa.record_batch([*columns, batch.column(1)], ["unit", "place", "id", "mark", "text"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.mapInArrow(run, "unit long, place long, id long, mark binary, text string")
    table = f"repeats_{uuid.uuid4().hex}"
    writer = rows.write.format("parquet").option("compression", "zstd").option("path", shared_path(spark, "units"))
    writer.bucketBy(shuffle_partitions(spark), "unit").saveAsTable(table)
    return spark.table(table)


def standing(texts: DataFrame) -> DataFrame:
    """As SIDE: which texts are judged, and which are copies of one with a smaller id."""
    rows = texts.select("unit", "place", "id", "mark")
    classes = stored(rows.groupBy("mark").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "texts")
    found = join_unique(rows, classes, ["mark"], "copies", rows.count()).where("id is not null")
    kind = F.when(F.col("id") == F.col("least"), JUDGED).otherwise(COPY)
    return found.select("unit", kind.alias("kind"), F.col("place").alias("value"), F.lit(None).cast("binary").alias("at"))


def shared_names(texts: DataFrame, side: DataFrame, level: int, before: tuple, width: int) -> DataFrame:
    """As SIDE: the names of ``level`` in open windows that another document has too, by their upper half."""

    def run(texts: pa.Table, side: pa.Table) -> pa.Table:
        unit = Unit(texts, side, width)
        names, rows = unit.close(level, before)
        order = np.lexsort((rows, names))
        names, rows = names[order], rows[order]
        first = np.concatenate([[True], names[1:] != names[:-1]])[: len(names)]
        other = np.zeros(len(names), bool)
        other[1:] = ~first[1:] & (rows[1:] != rows[:-1])
        again = np.unique(names[other])
        names = np.concatenate([names[first], again]).view(np.int64)
        return pa.table({"name": pa.array(names), "unit": pa.array(np.full(len(names), unit.number or 0))})

    names = by_unit(texts, side, run, "name long, unit long")
    order = Window.partitionBy("name").orderBy("unit")
    found = names.select("name", "unit", F.lag("unit").over(order).alias("before"), F.lead("unit").over(order).alias("after"))
    once = (F.col("before").isNull() & F.col("after").isNotNull()) | (F.col("before") != F.col("unit"))
    upper = F.shiftrightunsigned("name", 32)
    return found.where(once).select(
        "unit", F.lit(SHARED + level).alias("kind"), upper.alias("value"), F.lit(None).cast("binary").alias("at")
    )


def digests(text: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A digest of each piece of ``text``, ``high`` and ``low``."""
    pieces = (text[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True))
    found = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, pieces)), np.dtype([("high", "<i8"), ("low", "<i4"), ("rest", "<i4")]))
    return found[["high", "low"]]


def repeated_windows(texts: DataFrame, side: DataFrame, rounds: tuple, width: int) -> DataFrame:
    """As SIDE: the windows that a document of a smaller id has too, as place and number of the first word.

    A unit asks once for each digest, with its smallest id; its windows of larger ids are known to go, and are
    passed on in a row without id.
    """

    def run(texts: pa.Table, side: pa.Table) -> pa.Table:
        unit = Unit(texts, side, width)
        unit.close(0, rounds)
        ids, column = unit.texts.column("id").to_pylist(), unit.texts.column("text")
        starts = np.flatnonzero(unit.open)
        bounds = np.searchsorted(unit.rows, np.arange(len(ids) + 1))
        edges = np.searchsorted(starts, bounds)
        keys, owners, at = [np.zeros(0, np.dtype([("high", "<i8"), ("low", "<i4")]))], [], []
        for place in np.flatnonzero(np.diff(edges)).tolist():
            words = column[place].as_py().encode().split()
            own = starts[edges[place] : edges[place + 1]] - bounds[place]
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            begins = np.concatenate([[0], ends[:-1]])
            keys.append(digests(b" ".join(words), begins[own], ends[own + width - 1] - 1))
            owners.append(np.full(len(own), ids[place]))
            at.append(own | (place << 32))
        keys, owners, at = np.concatenate(keys), np.concatenate([*owners, []]).astype(np.int64), np.concatenate([*at, []]).astype(np.int64)
        order = np.lexsort((at, owners, keys["low"], keys["high"]))
        keys, owners, at = keys[order], owners[order], at[order]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        group = np.cumsum(first) - 1
        least = owners[first]
        asks = owners == least[group] if len(keys) else first
        sizes = np.bincount(group[asks], minlength=len(least)) if len(keys) else np.zeros(0, np.int64)
        sure = at[~asks]
        offsets = np.concatenate([[0], np.cumsum(sizes), *([[len(at)]] if len(sure) else [])]).astype(np.int32) * 8
        data = np.concatenate([at[asks], sure])
        found = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
        number = unit.number or 0
        extra = np.full(len(offsets) - 1 - len(least), mixed(np.array([number], np.uint64)).view(np.int64)[0])
        known = np.concatenate([least, np.zeros(len(extra), np.int64)])
        return pa.table(
            {
                "high": pa.array(np.concatenate([keys["high"][first], extra])),
                "low": pa.array(np.concatenate([keys["low"][first], np.zeros(len(extra), np.int32)]).astype(np.int32)),
                "id": pa.array(known, mask=np.arange(len(known)) >= len(least)),
                "unit": pa.array(np.full(len(known), number)),
                "at": found,
            }
        )

    asked = by_unit(texts, side, run, "high long, low int, id long, unit long, at binary")
    first = F.min("id").over(Window.partitionBy("high", "low").orderBy(F.col("id").asc_nulls_last()))
    found = asked.select("unit", "at", (F.col("id").isNull() | (first < F.col("id"))).alias("later")).where("later")
    return found.select("unit", F.lit(REMOVED).alias("kind"), F.lit(0).cast("long").alias("value"), "at")


def without_repeats(
    docs: DataFrame, width: int = WIDTH, rounds: tuple = ROUNDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, n_words, n_removed, kept)`` of every row: how many words there are and go, and the others."""
    texts = units(docs, id_col, text_col)
    status = stored(standing(texts), "standing")
    side = status
    for k, level in enumerate(rounds):
        side = side.unionByName(stored(shared_names(texts, side, level, rounds[:k], width), "shared"))
    removed = stored(repeated_windows(texts, side, rounds, width), "removed")

    def run(texts: pa.Table, side: pa.Table) -> pa.Table:
        texts = texts.combine_chunks().sort_by("place")
        kinds, values = side.column("kind").to_numpy(), side.column("value").to_numpy()
        copies = set(values[kinds == COPY].tolist())
        at = np.frombuffer(b"".join(x for x in side.column("at").to_pylist() if x), np.int64)
        at = np.sort(at)
        edges = np.searchsorted(at, np.arange(len(texts) + 1) << 32)
        totals, gone, kept = [], [], []
        for place, text in enumerate(texts.column("text")):
            words = (text.as_py() or "").encode().split()
            change = np.zeros(len(words) + 1, np.int64)
            if place in copies and len(words) >= width:
                change[0] = 1
            starts = at[edges[place] : edges[place + 1]] & 0xFFFFFFFF
            np.add.at(change, starts, 1)
            np.add.at(change, starts + width, -1)
            stays = np.cumsum(change)[:-1] == 0
            totals.append(len(words))
            gone.append(len(words) - int(stays.sum()))
            kept.append(b" ".join(words[k] for k in np.flatnonzero(stays)).decode())
        columns = [texts.column("id"), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
        return pa.table(columns, ["id", "n_words", "n_removed", "kept"])

    found = by_unit(texts, status.unionByName(removed), run, "id long, n_words long, n_removed long, kept string")
    return found.withColumnRenamed("id", id_col)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_workers(spark)
    found = without_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS place, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT doc_id, place, i, array_to_string(words[i : i + 12], ' ') AS piece
  FROM (SELECT doc_id, place, words, unnest(range(1, len(words) - 11)) AS i FROM texts)
), firsts AS (
  SELECT piece, min(doc_id) AS first FROM windows GROUP BY piece
), gone AS (
  SELECT DISTINCT place, i + unnest(range(13)) AS i
  FROM windows JOIN firsts USING (piece) WHERE first < doc_id
), words AS (
  SELECT doc_id, place, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM texts
), kept AS (
  SELECT place, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept
  FROM words ANTI JOIN gone USING (place, i) GROUP BY place
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (place)
"""
