"""Embedding near-dedup by an exact metric range join.

Identical vectors are collapsed first. Pivots, a bounded sample, partition the rest: a vector's home
is the cell of its nearest pivot. On unit vectors a cosine bound is a distance bound, so the triangle
inequality says which other cells can hold a partner of a vector: not those whose border plane with the
home cell is farther than the bound, nor those whose outermost vector is nearer to their pivot than the
vector is by more than the bound. A cell of many vectors is cut into blocks. Each block is stored once, as a
row, and tasks read pairs of blocks from there (a product of the table with itself), so a vector is shuffled
to its block and no further, however many others it is compared with. Pairs of cells out of reach are
not read, and of a pair only vectors are compared that can reach the other cell. Most pairs of vectors are told to be far
apart by half of their numbers and the length of the rest. Candidates of single precision are confirmed in double precision.

Links are counted where they are found; for components a block only passes on what connects. So
neither grows with the square of a group.

Defined results: a vector that is null, empty or zero, or has a null or non-finite number, links with
nothing; vectors of different length neither. Identical vectors link with each other. Rows that share an
id are one vector for components. A null id links with its copies. Labels and other columns are not
looked at; an empty table gives no rows.
"""

from __future__ import annotations

import contextlib
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from hourboard.llm.shared import BATCH_CONF, components, join_unique, read, shuffled, stored
from hourboard.llm.word_ids import slices

MIN_COSINE = 0.9
#: Vectors to a pivot, about, and the most pivots there are (which bounds what is broadcast).
PER_PIVOT, MAX_PIVOTS = 2048, 512
#: Vectors of a block.
BLOCK = 8192
#: Vectors of a block compared at once.
STRIDE = 1024
#: Vectors they are compared with at once, so that the products stay in a cache.
TILE = 1024
#: Most bytes of a block in double precision, and of a file of blocks, which a task holds one of.
BLOCK_BYTES, FILE_BYTES = 1 << 23, 24 << 20
#: Tiles with more than one pair in so many that may be close are looked at again, by whole vectors.
FEW = 64
#: Bytes of blocks that a worker remembers.
HELD_BYTES = 48 << 20
#: Pairs of blocks in an Arrow batch.
PAIRS = 4
#: A block as one row: ``reached`` has a byte for each cell, and the others the bytes of arrays.
PACKED = "block int, cell int, reached binary, ids binary, copies binary, vectors binary"
#: By how much single precision may be off.
SLACK = 1e-4
#: The same of distances, the square roots of small differences.
ROUGH = 1e-2
#: Pivots this near to each other have no border: rounding would spoil the division by their distance.
NEAR = 1e-3


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of :func:`packed`, as rows of double precision."""
    rows = [np.frombuffer(x, np.float32 if len(x) == 4 * width else np.float64) for x in column.to_pylist()]
    return np.array(rows, np.float64).reshape(-1, width)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def usable(rows: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector can link, with it as array<double>."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return rows.withColumn("vector", vector).where(fine & F.exists("vector", lambda x: x != 0))


def packed(rows: DataFrame, columns: str) -> DataFrame:
    """``rows`` (``id``, ``vector``) with these of ``id``, ``mark``, ``width`` and ``raw``.

    ``raw`` is the vector as bytes, of single precision where that is exact. Equal vectors alone have one ``mark``.
    """
    names = [x.split()[0] for x in columns.split(",")]

    def run(batches):
        for batch in slices(batches):
            sizes = batch.column(1).value_lengths().to_numpy()
            ends = np.cumsum(sizes)
            # Zeros of either sign are one number, so equal arrays are equal vectors.
            values = batch.column(1).flatten().to_numpy() + 0.0
            with np.errstate(over="ignore"):
                single = values.astype(np.float32)
            short = np.logical_and.reduceat(single == values, ends - sizes) if len(sizes) else []
            raw = [(single if s else values)[e - n : e].tobytes() for s, n, e in zip(short, sizes, ends, strict=True)]
            marks = [hashlib.sha256(int(n).to_bytes(8, "little") + x).digest() for n, x in zip(sizes, raw, strict=True)]
            found = {"id": batch.column(0), "mark": marks, "width": sizes, "raw": raw}
            kinds = {"id": pa.int64(), "mark": pa.binary(), "width": pa.int32(), "raw": pa.binary()}
            yield pa.record_batch([pa.array(found[name], kinds[name]) for name in names], names)

    return rows.mapInArrow(run, columns)


class Cells:
    """The pivots and what is known of their cells."""

    def __init__(self, pivots: np.ndarray, min_cosine: float):
        self.pivots = pivots
        self.reach = math.sqrt(max(0.0, 2 - 2 * min_cosine)) + 1e-6
        self.apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
        numbers = np.arange(len(pivots))
        odd = (numbers[:, None] + numbers[None, :]) % 2 == 1
        # One way between each two cells, half of them up and half down.
        self.visits = np.where(odd, numbers[None, :] < numbers[:, None], numbers[None, :] > numbers[:, None])
        self.radius = np.full(len(pivots), np.inf)
        self.blocks = np.ones(len(pivots), np.int64)

    def homes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's cell, and its distances to all pivots."""
        far = np.sqrt(np.maximum(0, 2 - 2 * vectors @ self.pivots.T))
        return far.argmin(axis=1), far

    def visited(self, home: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Which cells each vector visits besides its home."""
        return self.visits[home] & self.reached(home, far)

    def reached(self, home: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Which cells may hold a partner of each vector."""
        near = far[np.arange(len(home)), home][:, None]
        apart = self.apart[home]
        beyond_border = (apart > NEAR) & ((far * far - near * near) / (2 * np.maximum(apart, NEAR)) > self.reach)
        beyond_radius = far > self.radius[None, :] + self.reach
        return ~beyond_border & ~beyond_radius

    def may_meet(self, units: np.ndarray, home: int, other: int) -> np.ndarray:
        """Which vectors of the cell ``home`` may have a partner in the cell ``other``, by single precision."""
        square = 2 - 2 * units @ self.pivots[[home, other]].astype(np.float32).T
        border, reach = self.apart[home, other], self.reach + ROUGH
        beyond_border = border > 5 * ROUGH and (square[:, 1] - square[:, 0]) / (2 * border) > reach
        return ~beyond_border & (square[:, 1] <= (self.radius[other] + reach) ** 2)


def join_width(rows: DataFrame, width: int, min_cosine: float) -> tuple[DataFrame, DataFrame]:
    """``(id, links)`` counts and ``(a, b)`` links that connect, of distinct ``rows`` (``id``, ``copies``, ``raw``)."""
    spark = rows.sparkSession
    total = rows.count()
    wanted = max(1, min(MAX_PIVOTS, math.ceil(total / PER_PIVOT)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(wanted).select("raw").collect()  # at most MAX_PIVOTS
    cells = Cells(unit(matrix(pa.array([bytes(x[0]) for x in sample], pa.binary()), width)), min_cosine)
    most = max(1, min(BLOCK, BLOCK_BYTES // (8 * width)))

    def measure(batches):
        for batch in slices(batches):
            home, far = cells.homes(unit(matrix(batch.column(2), width)))
            yield pa.record_batch({"cell": pa.array(home, pa.int64()), "far": far[np.arange(len(home)), home]})

    sizes = rows.mapInArrow(measure, "cell long, far double").groupBy("cell").agg(F.max("far"), F.count("*"))
    cells.radius[:] = -np.inf
    for cell, radius, size in sizes.collect():  # a row a pivot
        cells.radius[cell] = radius
        cells.blocks[cell] = -(-size // most)
    first = np.cumsum(cells.blocks) - cells.blocks
    groups = int(cells.blocks.sum())

    def deal(batches):
        for batch in slices(batches):
            home, _ = cells.homes(unit(matrix(batch.column(2), width)))
            ids = batch.column(0).to_numpy()
            own = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % cells.blocks[home]
            block = pa.array((first[home] + own).astype(np.int32))
            yield pa.record_batch([block, *batch.columns], ["block", "id", "copies", "raw"])

    def pack(batches):
        block = None
        for batch in slices(batches):
            numbers = batch.column(0).to_numpy()
            for number in np.unique(numbers):
                if block is None or block.number != number:
                    if block is not None:
                        yield block.row(cells)
                    block = Packing(number, int(np.searchsorted(first, number, "right")) - 1, width)
                block.add(batch.filter(pa.array(numbers == number)))
        if block is not None:
            yield block.row(cells)

    files = max(4, math.ceil(total * width * 8 / FILE_BYTES))
    dealt = rows.mapInArrow(deal, "block int, id long, copies long, raw binary")
    dealt = dealt.repartitionById(max(1, min(groups, files)), "block").sortWithinPartitions("block", "id")
    blocks = stored(dealt.mapInArrow(pack, PACKED), "vector-blocks")

    def join(batches):
        # Of a task, the blocks on the left come one by one, each with all on the right.
        left, right, size = None, {}, len(PACKED.split(","))
        for batch in batches:
            for at in range(batch.num_rows):
                row = [column[at] for column in batch.columns]
                if left is None or left.number != row[0].as_py():
                    left = Block(row[:size], width)
                other = left if row[0] == row[size] else right.get(row[size].as_py()) or Block(row[size:], width)
                if other is not left and sum(x.nbytes for x in right.values()) + other.nbytes <= HELD_BYTES:
                    right[other.number] = other
                yield compare(left, other, cells, min_cosine)

    other = blocks.select(*[F.col(name).alias(f"other_{name}") for name in blocks.columns])
    odd = (F.col("block") + F.col("other_block")) % 2 == 1
    # One way between each two blocks, half of them up and half down.
    once = F.when(odd, F.col("block") > F.col("other_block")).otherwise(F.col("block") < F.col("other_block"))
    reach = F.expr("substring(reached, other_cell + 1, 1) = X'01' AND substring(other_reached, cell + 1, 1) = X'01'")
    pairs = blocks.join(other.hint("shuffle_replicate_nl"), (F.col("block") == F.col("other_block")) | (once & reach))
    with batches_of(spark, PAIRS):
        found = stored(pairs.mapInArrow(join, "id long, links long, a long, b long"), "vector-links")
    counts = found.where("links > 0").groupBy("id").agg(F.sum("links").alias("links"))
    return counts, found.where("a is not null").select("a", "b")


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Within it Arrow batches have ``rows`` rows at most."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


class Packing:
    """The vectors of a block while it is put into one row."""

    def __init__(self, number: int, cell: int, width: int):
        self.number, self.cell, self.width = int(number), cell, width
        self.ids, self.copies, self.vectors = [], [], []

    def add(self, batch: pa.RecordBatch) -> None:
        self.ids.append(batch.column(1).to_numpy())
        self.copies.append(batch.column(2).to_numpy())
        self.vectors.append(matrix(batch.column(3), self.width))

    def row(self, cells: Cells) -> pa.RecordBatch:
        vectors = np.concatenate(self.vectors)
        reached = np.zeros(len(cells.pivots), bool)
        for at in range(0, len(vectors), STRIDE):
            units = unit(vectors[at : at + STRIDE])
            far = np.sqrt(np.maximum(0, 2 - 2 * units @ cells.pivots.T))
            reached |= cells.reached(np.full(len(units), self.cell), far).any(axis=0)
        with np.errstate(over="ignore"):
            single = vectors.astype(np.float32)
        raw = single if (single == vectors).all() else vectors
        ids, copies = np.concatenate(self.ids), np.concatenate(self.copies)
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (reached.astype(np.uint8), ids, copies, raw)]
        numbers = [pa.array([x], pa.int32()) for x in (self.number, self.cell)]
        return pa.record_batch([*numbers, *blobs], ["block", "cell", "reached", "ids", "copies", "vectors"])


class Block:
    """A row of :class:`Packing`, read."""

    def __init__(self, row: list, width: int):
        self.number, self.cell = row[0].as_py(), row[1].as_py()
        self.ids, self.copies = (np.frombuffer(x.as_buffer(), np.int64) for x in row[3:5])
        raw = row[5].as_buffer()
        kind = np.float32 if raw.size == 4 * width * len(self.ids) else np.float64
        self.raw = np.frombuffer(raw, kind).reshape(-1, width)
        # Copies: what Arrow has read goes with the batch.
        self.ids, self.copies, self.raw = self.ids.copy(), self.copies.copy(), self.raw.copy()
        units = unit(self.raw.astype(np.float64))
        self.units, head = units.astype(np.float32), width // 2
        rest = np.sqrt((units[:, head:] ** 2).sum(axis=1, keepdims=True))
        self.heads = np.hstack([self.units[:, :head], rest.astype(np.float32)])
        self.nbytes = sum(x.nbytes for x in (self.ids, self.copies, self.raw, self.units, self.heads))


def close(a: Block, b: Block, rows: np.ndarray, columns: np.ndarray, least: float):
    """Pairs ``(i, j)`` of these ``rows`` of ``a`` and ``columns`` of ``b``, few of which have a cosine below ``least``.

    The product of two vectors is at most that of their heads and that of the lengths of the rest, so nearly all pairs
    are told to be far apart by their heads.
    """
    found = []
    for to in range(0, len(columns), TILE):
        some = columns[to : to + TILE]
        near = a.heads[rows] @ b.heads[some].T >= least
        if np.count_nonzero(near) > near.size // FEW:
            near = a.units[rows] @ b.units[some].T >= least
        # Rows first: most have none, which is seen much faster than where the others are.
        full = np.flatnonzero(near.any(axis=1))
        i, j = np.nonzero(near[full])
        found.append((rows[full[i]], some[j]))
    return (np.concatenate([x[k] for x in found]) if found else rows[:0] for k in (0, 1))


def compare(new: Block, old: Block, cells: Cells, min_cosine: float) -> pa.RecordBatch:
    """The links of two blocks with each other, or of one within itself."""
    same = new is old
    rows, columns = np.arange(len(new.ids)), np.arange(len(old.ids))
    if new.cell != old.cell:
        rows = rows[cells.may_meet(new.units, new.cell, old.cell)]
        columns = columns[cells.may_meet(old.units, old.cell, new.cell)]
    counts = np.zeros(len(new.ids), np.int64)
    others = counts if same else np.zeros(len(old.ids), np.int64)
    label, a, b = np.arange(len(old.ids)), [], []
    for at in range(0, len(rows), STRIDE):
        # Of a block within itself, only what comes before.
        before = columns[: at + STRIDE] if same else columns
        i, j = close(new, old, rows[at : at + STRIDE], before, np.float32(min_cosine - SLACK))
        if same:
            i, j = i[j < i], j[j < i]
        for cut in range(0, len(i), 1 << 18):
            left, right = i[cut : cut + (1 << 18)], j[cut : cut + (1 << 18)]
            x, y = new.raw[left].astype(np.float64), old.raw[right].astype(np.float64)
            norms = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
            linked = (x * y).sum(axis=1) / norms >= min_cosine
            left, right = left[linked], right[linked]
            np.add.at(others, right, new.copies[left])
            np.add.at(counts, left, old.copies[right])
            connect(left, right, label, new.ids, old.ids, same, a, b)
    found = [(new.ids, counts)] if same else [(new.ids, counts), (old.ids, others)]
    ids = np.concatenate([x[n > 0] for x, n in found])
    links = np.concatenate([n[n > 0] for _, n in found])
    empty = [None] * len(a)
    pad = pa.nulls(len(ids), pa.int64())
    return pa.record_batch(
        {
            "id": pa.concat_arrays([pa.array(ids, pa.int64()), pa.array(empty, pa.int64())]),
            "links": pa.concat_arrays([pa.array(links, pa.int64()), pa.array(empty, pa.int64())]),
            "a": pa.concat_arrays([pad, pa.array(a, pa.int64())]),
            "b": pa.concat_arrays([pad, pa.array(b, pa.int64())]),
        }
    )


def connect(i, j, label: np.ndarray, ids: np.ndarray, others: np.ndarray, same: bool, a: list, b: list) -> None:
    """Notes the pairs that connect what was apart, for each new vector ``i`` with its partners ``j``."""
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    starts = np.flatnonzero(np.diff(i, prepend=-1))
    for s, e in zip(starts, [*starts[1:], len(i)][: len(starts)], strict=True):
        roots, at = np.unique(label[j[s:e]], return_index=True)
        a.extend([int(ids[i[s]])] * len(roots))
        b.extend(others[j[s:e][at]].tolist())
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
        if same:
            label[label == label[i[s]]] = roots[0]


def vector_join(
    rows: DataFrame, min_cosine: float = MIN_COSINE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` of every row."""
    spark = rows.sparkSession
    table = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("raw"))
    vectors = usable(table, "raw").select("id", "vector")
    # Vectors are read again rather than kept with their marks.
    keyed = stored(packed(vectors, "id long, mark binary"), "vectors")
    classes = packed(vectors, "id long, mark binary, width int, raw binary").groupBy("mark").agg(
        F.min("id").alias("first"), F.count("*").alias("copies"), F.first("width").alias("width"), F.first("raw").alias("raw")
    )
    classes = stored(classes, "classes")
    widths = [x[0] for x in classes.groupBy("width").count().collect()]  # lengths of vectors, one as a rule
    named = classes.where(F.col("first").isNotNull())
    counts = spark.createDataFrame([], "id long, links long")
    links = spark.createDataFrame([], "a long, b long")
    for width in widths:
        own = named.where(F.col("width") == width).select(F.col("first").alias("id"), "copies", "raw")
        more, found = join_width(own, width, min_cosine)
        counts, links = counts.unionByName(more), links.unionByName(found)
    nodes = components(named.select(F.col("first").alias("id")).distinct(), links)
    counts = counts.groupBy("id").agg(F.sum("links").alias("links"))
    answers = (
        classes.select("mark", "copies", "first")
        .join(shuffled(nodes.withColumnRenamed("id", "first")), "first", "left")
        .join(shuffled(counts.withColumnRenamed("id", "first")), "first", "left")
        .select("mark", "copies", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    linked = join_unique(keyed, stored(answers, "answers"), ["mark"], "copies", keyed.count(), grows=True)
    fine = F.coalesce(
        F.forall(F.col("raw").cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
        & F.exists(F.col("raw").cast("array<double>"), lambda x: x != 0),
        F.lit(False),
    )
    rest = table.where(~fine).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return linked.select("id", "links", "component").unionByName(rest).select(
        F.col("id").alias(id_col),
        F.col("links").alias("n_links"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op7_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join(read(spark, sf_dir, "embeddings"))
