"""Token ids as flat binary files with document offsets.

A file set is a folder. Each part has three files: ``part-NNNNN.bin`` with the ids of its documents
on end, unsigned little-endian, two bytes each if the vocabulary allows and else four;
``part-NNNNN.idx`` with one more 64-bit offset than documents, counted in ids from the part's start;
``part-NNNNN.doc`` with the 64-bit document ids. Parts are in ascending order of document id; where
a part starts in the whole set is the sum of the tokens of the parts before it.

Files are memory-mapped, so the folder has to be mounted on every machine; by default it is a fresh
one in the shared folder of the session. A part is written under a temporary name and renamed, so a
repeated task replaces it whole.

Defined results: a null text counts as empty and gives its end id alone. Null ids come first and are
stored as the smallest 64-bit number. Repeated ids follow each other, ordered by a hash of the text.
Other columns are not looked at. An empty table gives no parts and no rows.
"""

from __future__ import annotations

import os
import zlib
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.llm.shared import read, shared_path, shuffle_partitions
from hourboard.llm.word_ids import encoder, slices, with_end

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
NO_ID = np.iinfo(np.int64).min


def mounted(path: str) -> str:
    """The path of a shared folder as the operating system has it."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"Memory-mapped files need a mounted folder, not {path}")
    return parts.path


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> list[tuple[int, int, int, int]]:
    """Writes the file set and returns ``(part, documents, tokens, base)`` of each part in order."""
    os.makedirs(folder, exist_ok=True)

    def write(batches):
        tokens = encoder(vocabulary)
        kind = "<u2" if max(tokens.size, end_id + 1) <= 1 << 16 else "<u4"
        task = TaskContext.get()
        part, names, counts = task.partitionId(), [], []
        path = f"{folder}/part-{part:05d}"
        own = f".{task.taskAttemptId()}"
        with open(f"{path}.bin{own}", "wb") as out:
            for batch in slices(batches):
                ids, n = with_end(*tokens.encode(batch.column(1)), end_id)
                out.write(ids.astype(kind).tobytes())
                names.append(batch.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy())
                counts.append(n)
        names = np.concatenate([np.zeros(0, np.int64), *names])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts]))])
        for suffix, values in ((".idx", offsets), (".doc", names)):
            with open(f"{path}{suffix}{own}", "wb") as out:
                out.write(values.astype("<i8").tobytes())
        for suffix in (".bin", ".idx", ".doc"):
            os.replace(f"{path}{suffix}{own}", f"{path}{suffix}")
        yield pa.record_batch(
            {"part": [part], "documents": [len(names)], "tokens": [int(offsets[-1])]},
            pa.schema([("part", pa.int32()), ("documents", pa.int64()), ("tokens", pa.int64())]),
        )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = (
        rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "id")
        .sortWithinPartitions("id", F.xxhash64("text"))
        .mapInArrow(write, "part int, documents long, tokens long")
        .collect()  # one small row a part
    )
    base, placed = 0, []
    for part, documents, tokens in sorted(map(tuple, parts)):
        if documents:
            placed.append((part, documents, tokens, base))
        base += tokens
    return placed


def read_tokens(spark: SparkSession, folder: str, parts: list[tuple[int, int, int, int]], id_col: str = "doc_id") -> DataFrame:
    """``(id_col, start, n_tokens, ids_crc32)`` of every document, from the mapped files."""

    def mapped(batches):
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{folder}/part-{row['part']:05d}"
                offsets = np.memmap(f"{path}.idx", "<i8", "r")
                kind = "<u2" if os.path.getsize(f"{path}.bin") == 2 * offsets[-1] else "<u4"
                ids, names = np.memmap(f"{path}.bin", kind, "r"), np.memmap(f"{path}.doc", "<i8", "r")
                sums = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.record_batch(
                    {
                        id_col: pa.array(names, pa.int64(), mask=np.asarray(names) == NO_ID),
                        "start": pa.array(row["base"] + offsets[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(offsets), pa.int64()),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    table = spark.createDataFrame(parts, "part int, documents long, tokens long, base long")
    return table.repartitionById(max(1, len(parts)), "part").mapInArrow(
        mapped, f"{id_col} long, start long, n_tokens long, ids_crc32 long"
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = mounted(shared_path(spark, "tokens"))
    parts = write_tokens(read(spark, sf_dir, "documents"), folder, public_tokenizers.path(VOCABULARY))
    return read_tokens(spark, folder, parts)
