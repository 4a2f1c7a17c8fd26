"""Best-fit packing by sums of squares.

Documents become token ids plus an end id; those over the capacity are cut into pieces. Pieces are
dealt at random into groups of about GROUP_PIECES and each group is packed by itself, longest piece
first. A piece goes where the sum over all gaps of the squared number of open sequences with that
gap becomes smallest: into an open sequence it fits or into a new one. A group's few sequences that
stay open are then packed once more, as if each were a piece, over groups of groups.

Defined results: a null text counts as empty and gives its end id alone, as one piece. Repeated rows
are packed each; null ids are packed like others. Ties go to the smallest gap, then to opening a
sequence. Other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.llm.shared import read, stored
from hourboard.llm.word_ids import encoder, slices, with_end

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 4096
#: Pieces packed together; a group's state is one number a gap, and its rows are fixed in width.
GROUP_PIECES = 20_000
#: Groups whose open sequences are packed together.
GROUPS_JOINED = 64
NEVER = np.iinfo(np.int64).max
PIECES = "long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id_col, piece, start, length, ids_crc32)`` of each piece of each document."""

    def cut(batches):
        tokens = encoder(vocabulary)
        for batch in slices(batches):
            ids, counts = with_end(*tokens.encode(batch.column(1)), end_id)
            ids = ids.astype("<u4")
            per = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), per)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
            start = piece * capacity
            length = np.minimum(counts[doc] - start, capacity)
            first = (np.cumsum(counts) - counts)[doc] + start
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(first, first + length, strict=True)]
            yield pa.record_batch(
                {
                    id_col: batch.column(0).take(pa.array(doc)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(cut, f"{id_col} {PIECES}")


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece, longest first (``lengths`` at most ``capacity``)."""
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap; full ones are not open
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used = 0
    for at in np.argsort(-lengths, kind="stable"):
        size = int(lengths[at])
        # What the sum of squares changes by, for each gap from size on, and for a new sequence.
        moved = 2 * (count[: capacity + 1 - size] - count[size:]) + 2
        moved[0] = 1 - 2 * count[size]  # a sequence that becomes full is open no more
        moved[count[size:] == 0] = NEVER
        gap = int(np.argmin(moved)) + size
        opened = 2 * count[capacity - size] + 1 if size < capacity else 0
        if moved[gap - size] <= opened:
            chosen = open_by_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, chosen = capacity, used
            used += 1
        sequence[at], offset[at] = chosen, capacity - gap
        if gap > size:
            open_by_gap[gap - size].append(chosen)
            count[gap - size] += 1
    return sequence, offset


def pack(parts: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``."""
    # By place in the table as stored, so that equal pieces spread too.
    parts = stored(parts.withColumn("place", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(parts.count() / GROUP_PIECES))
    group = F.pmod(F.xxhash64("place"), F.lit(groups))

    def pack_group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place").drop_columns("place")
        lengths = rows.column("length").to_numpy()
        sequence, offset = sum_of_squares(lengths, capacity)
        fill = np.bincount(sequence, lengths)[sequence].astype(np.int64)
        return rows.append_column("bin", [sequence]).append_column("offset", [offset]).append_column("filled", [fill])

    # As Arrow, so that ids beside null ones stay whole numbers.
    columns = f"{id_col} {PIECES}, group long, bin long, offset long, filled long"
    placed = parts.withColumn("group", group).groupBy("group").applyInArrow(pack_group, columns)
    placed = stored(placed, "packed")

    def pack_open(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["group", "bin"], ignore_index=True)
        sequence, offset = sum_of_squares(rows["filled"].to_numpy(), capacity)
        return rows.assign(to=sequence, shift=offset)

    bins = placed.where(F.col("filled") < capacity).groupBy("group", "bin").agg(F.first("filled").alias("filled"))
    joined = (
        bins.withColumn("joined", F.floor(F.col("group") / GROUPS_JOINED))
        .groupBy("joined")
        .applyInPandas(pack_open, "group long, bin long, filled long, joined long, to long, shift long")
        .select("group", "bin", "joined", "to", "shift")
    )
    # Numbers of full sequences are even, of joined ones odd.
    full = (F.col("group") * (1 << 32) + F.col("bin")) * 2
    open_ = (F.col("joined") * (1 << 32) + F.col("to")) * 2 + 1
    return placed.join(joined, ["group", "bin"], "left").select(
        id_col,
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce(open_, full).alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)))
