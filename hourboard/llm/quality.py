"""Quality classifier: an interpolated modified Kneser-Ney model over characters, and language-specific thresholds.

The model is fitted on trusted text, which labels name: all documents of one half of the trusted ones, by a
hash of the id; the other half sets the thresholds. It counts n-grams of ORDER characters (digits alike, white space as one
space); counts of lower orders are numbers of distinct continuations, and there are three discounts
an order, as modified Kneser-Ney smoothing has it.

The corpus is scored in shards of SHARD_DOCS consecutive documents. Each shard asks for the n-grams
that occur in it. Sharded joins bring together the distinct n-grams of the whole corpus and the counts
of each order, and answers go back to the shards, which are moved once, compressed, to meet them.
A document's perplexity is that of all its characters and its end.

A document is rejected if its perplexity is above its threshold, which comes from the perplexities of the
trusted documents of its own language that the model did not learn from: their quantile, with a margin.
The fewer they are, the more that is drawn (PRIOR) to their median times the spread that languages have
about their medians, but it is never below their quantile, which for few documents is the largest. The
threshold of a size (in powers of two) is drawn to the language's in the same way. A language without such
documents has no threshold, and a text so short that being above the threshold proves little (EVIDENCE, in
nats over all its characters) stays.

Defined results: a null or blank text has no perplexity and is rejected. Without trusted text nothing
else is. A null label of language counts as a language. Documents without label, null ids and repeated
rows are scored like others; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.llm.shared import read, stored
from hourboard.llm.word_ids import slices

ORDER = 4
SHARD_DOCS = 8192
#: The share of held-out trusted documents within the threshold, and what it is multiplied by.
QUANTILE, MARGIN = 0.995, 1.1
#: How many trusted documents weigh as much as what a threshold is drawn to.
PRIOR = 50
EVIDENCE = 20.0
#: Characters whose n-grams are held at once, if of more than one text.
AT_ONCE = 1 << 20
BITS = 16
#: Bits for each id of a filter of ids, and its 64-bit words at most.
FILTER_BITS, FILTER_WORDS = 16, 1 << 17
START, END = 2, 3

CODES = np.arange(1 << BITS, dtype=np.uint16)
CODES[ord("1") : ord("9") + 1] = ord("0")
CODES[[c for c in range(1 << BITS) if chr(c).isspace()]] = ord(" ")


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of ``texts`` on end, as 64-bit numbers, and how many each text has.

    Characters beyond 16 bits share the private codes, so some of them are taken for each other.
    """
    counts = np.array([len(x) for x in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = CODES[np.where(points < 1 << BITS, points, 0xE000 + points % 0x1900)]
    row = np.repeat(np.arange(len(texts)), counts)
    space = codes == ord(" ")
    again = np.zeros(len(codes), bool)
    again[1:] = space[1:] & space[:-1] & (row[1:] == row[:-1])
    codes, row = codes[~again], row[~again]
    counts = np.bincount(row, minlength=len(texts))
    # ORDER - 1 starts before and one end after each text.
    padded = np.full(len(codes) + ORDER * len(texts), START, np.uint64)
    at = np.arange(len(codes)) + ORDER * row + ORDER - 1
    padded[at] = codes
    last = np.cumsum(counts + ORDER) - 1
    padded[last] = END
    real = np.zeros(len(padded), bool)
    real[at] = real[last] = True
    grams = padded.copy()
    for back in range(1, ORDER):
        grams[back:] |= padded[:-back] << np.uint64(BITS * back)
    return grams[real].view(np.int64), counts + 1


def portions(column: pa.Array):
    """The texts of a column, some at a time; null as empty."""
    held, size = [], 0
    for text in column:
        text = text.as_py() or ""
        if held and size + len(text) > AT_ONCE:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def distinct_grams(column: pa.Array) -> np.ndarray:
    found = [np.unique(grams_of(texts)[0]) for texts in portions(column)]
    return np.unique(np.concatenate([np.zeros(0, np.int64), *found]))


def counted(docs: DataFrame) -> DataFrame:
    """``(gram, n)`` over the texts of ``docs`` (``text``)."""

    def run(batches):
        for batch in slices(batches):
            for texts in portions(batch.column(0)):
                grams, n = np.unique(grams_of(texts)[0], return_counts=True)
                yield pa.record_batch({"gram": grams, "n": n})

    return docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def tail(gram: Column, order: int) -> Column:
    """The last ``order`` characters."""
    return gram.bitwiseAND(F.lit((1 << (BITS * order)) - 1)) if order < ORDER else gram


def log_probabilities(counts: DataFrame, grams: DataFrame) -> DataFrame:
    """``(gram, log_p)`` of distinct ``grams`` in the model of ``counts`` (``gram``, ``n``)."""
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        tables[order] = stored(
            tables[order + 1].groupBy(tail(F.col("gram"), order).alias("gram")).agg(F.count("*").alias("n")), "counts"
        )
    kinds = tables[1].count()  # one number: distinct characters
    found = grams.select("gram", F.lit(1.0 / (kinds + 1)).alias("p"))
    for order in range(1, ORDER + 1):
        table = tables[order]
        ones = table.agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)]).first()
        discount = F.element_at(F.array(*map(F.lit, discounts(*ones))), F.least("n", F.lit(3)).cast("int"))
        table = table.withColumn("discount", discount).withColumn("context", F.shiftrightunsigned("gram", BITS))
        contexts = table.groupBy("context").agg(F.sum("n").alias("total"), F.sum("discount").alias("freed"))
        found = (
            found.withColumn("own", tail(F.col("gram"), order))
            .withColumn("context", F.shiftrightunsigned("own", BITS))
            .join(table.select(F.col("gram").alias("own"), "n", "discount"), "own", "left")
            .join(contexts, "context", "left")
            .select(
                "gram",
                F.when(
                    F.col("total") > 0,
                    (F.coalesce(F.col("n") - F.col("discount"), F.lit(0.0)) + F.col("freed") * F.col("p")) / F.col("total"),
                )
                .otherwise(F.col("p"))
                .alias("p"),
            )
        )
    return found.select("gram", F.ln("p").alias("log_p"))


def likely(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` whose ``id`` is among ``ids`` (``id``, no nulls), and a few others, about one in FILTER_BITS.

    By a bitmap of hashes of a bounded size, so that the texts of other rows need not be moved to meet the ids. With more
    ids than it is made for more other rows stay.
    """
    words = min(FILTER_WORDS, ids.count() * FILTER_BITS // 64 + 1)
    place = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64 * words))
    bits = ids.select(F.floor(place / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit"))
    bits = bits.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bits = ids.sparkSession.range(words).select(F.col("id").alias("word")).join(bits, "word", "left")
    bits = bits.agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("bits"))
    bitmap = stored(bits.select(F.transform("bits", lambda x: x["bits"]).alias("bitmap")), "bitmap")
    bit = F.bit_get(F.element_at("bitmap", (F.floor(place / 64) + 1).cast("int")), (place % 64).cast("int"))
    return rows.join(F.broadcast(bitmap), bit == 1, "left_semi")


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """For counts of one, two, and three or more, from how many n-grams have counts of one to four."""
    if not min(n1, n2, n3, n4):
        return 0.5, 0.75, 0.75
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))


def sharded(batches, width: int):
    """Each batch with its shard's number, the same whenever the same partitions are read."""
    task = TaskContext.get().partitionId() << 32
    seen = 0
    for batch in slices(batches):
        yield task + seen // SHARD_DOCS, batch
        seen += batch.num_rows


def scored(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``(id, lang, n_scored, log_p)`` of ``docs`` (``id``, ``lang``, ``text``), which have to be read from files."""

    def ask(batches):
        shard, grams = None, []
        for number, batch in sharded(batches, 3):
            if shard not in (None, number):
                yield pa.record_batch({"shard": np.full(len(grams[0]), shard), "gram": grams[0]})
                grams = []
            shard = number
            grams = [np.unique(np.concatenate([*grams, distinct_grams(batch.column(2))]))]
        if grams:
            yield pa.record_batch({"shard": np.full(len(grams[0]), shard), "gram": grams[0]})

    def packed(batches):
        pack = zstandard.ZstdCompressor(3)
        for number, batch in sharded(batches, 3):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            yield pa.record_batch({"shard": [number], "docs": [pack.compress(sink.getvalue())]})

    def answer(parts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(answers["gram"].to_numpy())
        known, log_p = answers["gram"].to_numpy()[order], answers["log_p"].to_numpy()[order]
        results = []
        for part in parts["docs"]:
            with pa.ipc.open_stream(zstandard.decompress(part)) as stream:
                table = stream.read_all()
            counts, sums = [], []
            for texts in portions(table.column(2)):
                grams, n = grams_of(texts)
                at = np.searchsorted(known, grams)
                if not np.array_equal(known[np.minimum(at, len(known) - 1)], grams):
                    raise RuntimeError("A shard changed between two readings of the documents")
                totals = np.concatenate([[0.0], np.cumsum(log_p[at])])
                sums.append(np.diff(totals[np.concatenate([[0], np.cumsum(n)])]))
                counts.append(n)
            n, sums = np.concatenate(counts), np.concatenate(sums)
            ids = table.column(0).to_pandas(integer_object_nulls=True)  # never as floats, which large ids are not
            own = pd.DataFrame({"id": ids, "lang": table.column(1).to_pandas()})
            blank = np.array([not (x and not x.isspace()) for x in table.column(2).to_pylist()], bool)
            results.append(own.assign(n_scored=np.where(blank, 0, n), log_p=sums))
        return pd.concat(results).astype({"id": "Int64"})

    requests = stored(docs.mapInArrow(ask, "shard long, gram long"), "requests")
    known = log_probabilities(counts, requests.select("gram").distinct())
    answers = requests.join(stored(known, "probabilities"), "gram").select("shard", "gram", "log_p")
    parts = docs.mapInArrow(packed, "shard long, docs binary")
    return parts.groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(
        answer, "id long, lang string, n_scored long, log_p double"
    )


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quantile: float = QUANTILE,
    margin: float = MARGIN,
) -> DataFrame:
    """``(id_col, lang, n_scored, perplexity, threshold, kept)`` of every row; ``labels`` has ``doc_id`` and ``quality``."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    if "Exchange" in rows._jdf.queryExecution().executedPlan().toString():
        rows = stored(rows, "documents")  # shards have to be the same in both readings
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("id")).distinct()
    learns = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    teachers = stored(trusted.where(learns), "teachers")
    counts = stored(counted(likely(rows.where(learns), teachers).join(teachers, "id", "left_semi")), "counts")
    perplexities = stored(
        scored(rows, counts).withColumn(
            "perplexity", F.when(F.col("n_scored") > 0, F.exp(-F.col("log_p") / F.col("n_scored")))
        ),
        "perplexities",
    )
    held_out = perplexities.join(trusted.where(~learns), "id", "left_semi").where("perplexity is not null")
    lang, size = F.coalesce("lang", F.lit("")).alias("of"), F.floor(F.log2("n_scored")).alias("size")

    held_out = held_out.select("perplexity", lang, size)

    def high(of: Column) -> Column:
        return F.percentile_approx(of, quantile, 10_000)

    def drawn(own: Column, to: Column) -> Column:
        """``own``, of ``trusted`` documents, drawn to a higher ``to``."""
        return F.greatest(own, F.exp((F.col("trusted") * F.ln(own) + PRIOR * F.ln(to)) / (F.col("trusted") + PRIOR)))

    def own(*by: str) -> DataFrame:
        return held_out.groupBy(*by).agg(
            high(F.col("perplexity")).alias("own"),
            F.percentile_approx("perplexity", 0.5, 10_000).alias("median"),
            F.count("*").alias("trusted"),
        )

    langs = stored(own("of"), "languages")
    spread = held_out.join(F.broadcast(langs), "of").agg(high(F.col("perplexity") / F.col("median"))).first()[0] or 1.0
    by_lang = langs.select("of", drawn(F.col("own"), F.col("median") * spread).alias("by_lang"))
    by_size = own("of", "size").join(by_lang, "of").select("of", "size", drawn(F.col("own"), F.col("by_lang")).alias("by_size"))
    marked = (
        perplexities.select("*", lang, size)
        .join(F.broadcast(by_size), ["of", "size"], "left")
        .join(F.broadcast(by_lang), "of", "left")
        .withColumn("threshold", F.coalesce("by_size", "by_lang") * margin)
    )
    above = F.col("n_scored") * (F.ln("perplexity") - F.ln("threshold"))
    kept = F.col("perplexity").isNotNull() & F.coalesce(above <= EVIDENCE, F.lit(True))
    return marked.select(F.col("id").alias(id_col), "lang", "n_scored", "perplexity", "threshold", kept.alias("kept"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
