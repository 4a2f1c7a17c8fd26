"""Byte-level BPE: encoding by overlapping chunks, decoding by concatenating raw bytes.

A long text is cut into chunks that overlap. Each chunk is pre-tokenised by itself. Where a pre-token
boundary of a chunk coincides, within the overlap, with one of the chunk before, both agree from there
on, for a match depends only on what follows its start; the text is cut at the first such place. The
pieces between cuts are encoded in parallel and their ids concatenated. Where two chunks do not
meet (a pre-token longer than the overlap), the text is not cut from there on. A text no longer than
a chunk is one piece and is not moved.

Ids are kept as bytes, unsigned little-endian 32-bit numbers.

Defined results: a null text counts as empty and has no ids. Repeated rows are encoded alike, null ids
are kept, other columns are not looked at, an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourboard.llm.shared import join_unique, read, shuffle_partitions, stored, text_or_empty
from hourboard.llm.word_ids import slices

RANKS = "byte_bpe_50k.tiktoken"
#: Characters of a chunk, and how many more it has from the next one.
CHUNK, OVERLAP = 65_536, 1_024
#: A match that ends so near a chunk's end could be another with more text ("'l" and "'ll").
MARGIN = 4


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_encodings: dict[tuple[str, str], object] = {}


def encoding(path: str, pattern: str):
    """This worker's encoding by the ranks at ``path``."""
    import tiktoken

    if (path, pattern) not in _encodings:
        _encodings[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})
    return _encodings[path, pattern]


def mapped(frame: DataFrame, function, schema: str) -> DataFrame:
    """``function`` of each batch's columns as lists gives the columns of the result."""

    def run(batches):
        for batch in slices(batches):
            yield pa.record_batch(function(batch), names=[c.strip().split()[0] for c in schema.split(",")])

    return frame.mapInArrow(run, schema)


def boundaries(text: str, start: int, whole: bool, pattern) -> np.ndarray:
    """Where pre-tokens of ``text`` end, counted from ``start``; only those that more text could not move."""
    ends = np.array([m.end() for m in pattern.finditer(text)], np.int64)
    return start + (ends if whole else ends[ends <= len(text) - MARGIN])


def cuts(chunks: DataFrame, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``(digest, cuts)``: where the texts are cut, from their ``chunks`` (``digest``, ``chunk``, ``part``)."""

    def edges(batch):
        compiled = regex.compile(pattern)
        heads, tails = [], []
        for number, part in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            start = number * chunk
            found = boundaries(part, start, len(part) < chunk + overlap, compiled)
            heads.append(found[(found >= start) & (found < start + overlap)])
            tails.append(found[found >= start + chunk])
        lists = pa.list_(pa.int64())
        return [batch.column(0), batch.column(1), pa.array(heads, lists), pa.array(tails, lists)]

    ends = mapped(chunks, edges, "digest string, chunk int, head array<bigint>, tail array<bigint>")
    order = Window.partitionBy("digest").orderBy("chunk")  # one text's chunks
    met = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    ends = ends.withColumn("cut", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(met))
    ends = ends.withColumn("good", F.min(F.col("cut").isNotNull()).over(order))
    return ends.where("good").groupBy("digest").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))


def encode_long(texts: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``(digest, ids)`` of distinct long ``texts`` (``digest``, ``text``)."""
    parts = shuffle_partitions(texts.sparkSession)
    numbers = F.sequence(F.lit(0), F.ceil(F.length("text") / chunk).cast("int") - 1)
    chunks = texts.select("digest", F.explode(numbers).alias("chunk"), "text").select(
        "digest", "chunk", F.substring("text", F.col("chunk") * chunk + 1, F.lit(chunk + overlap)).alias("part")
    )
    found = cuts(chunks.repartition(parts, "digest", "chunk"), pattern, chunk, overlap)
    ends = F.concat(F.slice("cuts", F.lit(2), F.size("cuts")), F.array(F.length("text").cast("long")))
    pieces = (
        texts.join(found, "digest")
        .select("digest", "text", F.posexplode(F.arrays_zip(F.col("cuts").alias("a"), ends.alias("b"))))
        .select("digest", F.col("pos").alias("piece"), F.expr("substring(text, int(col.a) + 1, int(col.b - col.a))").alias("part"))
    )

    def encode(batch):
        encoder = encoding(path, pattern)
        ids = [np.array(encoder.encode_ordinary(x.as_py()), "<u4").tobytes() for x in batch.column(2)]
        return [batch.column(0), batch.column(1), pa.array(ids, pa.binary())]

    encoded = mapped(pieces.repartition(parts, "digest", "piece"), encode, "digest string, piece int, ids binary")
    joined = F.sort_array(F.collect_list(F.struct("piece", "ids")))  # one text's pieces
    return encoded.groupBy("digest").agg(joined.alias("pieces")).select(
        "digest", F.aggregate("pieces", F.lit(b""), lambda all_, x: F.concat(all_, x["ids"])).alias("ids")
    )


def bpe_encode(
    docs: DataFrame,
    path: str,
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``(id_col, ids)`` of every row."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long"), text.alias("text"))

    def encode(batch):
        encoder = encoding(path, pattern)
        ids = [np.array(encoder.encode_ordinary(x.as_py()), "<u4").tobytes() for x in batch.column(1)]
        return [batch.column(0), pa.array(ids, pa.binary())]

    short = mapped(rows.where(F.length("text") <= chunk), encode, f"{id_col} long, ids binary")
    long = rows.where(F.length("text") > chunk).withColumn("digest", F.sha2("text", 256))
    names = stored(long.select(id_col, "digest"), "long-texts")
    counts = names.groupBy("digest").agg(F.count("*").alias("n"))
    texts = stored(long.groupBy("digest").agg(F.first("text").alias("text")), "long-texts")
    encoded = stored(encode_long(texts, path, pattern, chunk, overlap).join(counts, "digest"), "long-ids")
    return short.unionByName(join_unique(names, encoded, ["digest"], "n", names.count()).select(id_col, "ids"))


def decoder(path: str):
    """The function from ids, as bytes, to the raw bytes they stand for."""
    tokens = {rank: token for token, rank in ranks_of(path).items()}
    return lambda ids: b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def bpe_decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the raw bytes its ids stand for."""
    at = encoded.columns.index(ids_col)
    schema = encoded.select("*", F.lit(b"").alias("decoded")).schema

    def decode(batches):
        raw = decoder(path)
        for batch in slices(batches):
            found = pa.array([raw(x.as_py()) for x in batch.column(at)], pa.binary())
            yield pa.record_batch([*batch.columns, found], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(decode, schema)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    encoded = bpe_encode(read(spark, sf_dir, "documents"), path)

    def digests(batches):
        # Decodes as bpe_decode does, row by row, so that no decoded text leaves the task.
        raw = decoder(path)
        words = [str(i).encode() for i in range(max(ranks_of(path).values()) + 1)]

        def row(ids: bytes) -> tuple[int, str, str]:
            numbers = np.frombuffer(ids, "<u4").tolist()
            listed = hashlib.sha256(b" ".join(map(words.__getitem__, numbers))).hexdigest()
            return len(numbers), listed, hashlib.sha256(raw(ids)).hexdigest()

        for batch in slices(batches):
            found = [row(x.as_py()) for x in batch.column(1)]
            columns = [[x[k] for x in found] for k in range(3)]
            yield pa.record_batch(
                [batch.column(0), pa.array(columns[0], pa.int64()), *(pa.array(x, pa.string()) for x in columns[1:])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
