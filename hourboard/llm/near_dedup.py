"""Near-dedup by a chosen-path set similarity join.

A document's set is that of its word shingles, hashed to 64 bits. Documents with equal sets are
collapsed first. Each set is embedded as TOKENS minwise tokens. A tree starts with all sets in one
node; in each node every set chooses, by a hash of the path so far and the token, about 1 / threshold of
its tokens, and goes to the child of each. Nodes of at most SMALL sets are compared exhaustively,
by the share of their minwise tokens that agree, and larger ones branch again. A node that is still
larger at DEPTH (copies of one text, mostly) is taken as linked throughout, for the next step to tell
apart. Where large nodes are few (:data:`AT_LAST`), all pairs in them are compared and the trees end there. There are as many independent trees (:func:`trees`) as bring the chance below MISSED that a pair
at the threshold, alike in as many tokens as chance has it, shares no node at DEPTH. Pairs that meet in a
small node earlier, or are more alike, are missed less. What all trees miss is not found otherwise.

Copies of one text, and texts that are alike but less than the threshold, would stay together through many levels of
all trees. So FIRST_TREES trees of FIRST_DEPTH levels are looked at first for large nodes alone. Sets that these connect
are a cluster, or those of one node where that would be too many. In a cluster of at most :func:`complete` sets each is
compared with all others, block by block, and the cluster is a group; what is larger is compared within blocks, and the
components of the links that full sets confirm are labels and groups. From then on a node of one group is done with, and so is a
large one in which all but SMALL sets have the same: these few are compared with all others, in blocks.

What the trees link are candidates only. Their components are small; each brings its full sets
together once, and links are confirmed on these, between sets that are not yet connected, likely
ones first. A component of over BLOCK sets is split at random into blocks, each with some sets of all of it
(:data:`PILOTS`). Sets that do not end up connected with most of the component are then sent to the
other blocks, again in blocks, and compared with all sets there. So every pair that is not connected otherwise is
compared, and no task holds more than two blocks.

Defined results: null, empty and wordless texts have no shingles and link with nothing. With fewer words
than a shingle has, the whole sequence is the one shingle. Repeated rows have equal sets; rows that share
an id are one document. A null id has the component of its copies, or null. Other columns are not
looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.llm.shared import components, join_unique, read, shuffle_partitions, stored
from hourboard.llm.word_ids import slices

#: Minwise tokens of a set, and how many of them have to agree for a candidate: over four standard
#: deviations below what a link at similarity 0.8 gives.
TOKENS, AGREEING = 64, 38
#: Levels of a tree, and the chance to miss a pair at the threshold that only meets at the last one.
DEPTH, MISSED = 6, 0.001
#: Bytes of text that are hashed at once, if more than one text.
HASHED_BYTES = 1 << 20
#: Sets in a node that are compared exhaustively, and in a block.
SMALL, BLOCK = 64, 256
#: Trees and levels of the first look at large nodes, and the sets of a component that all its blocks have.
FIRST_TREES, FIRST_DEPTH, PILOTS = 4, 2, 16
#: Rows for each set that comparing all large nodes throughout may deal out, to end the trees at a level.
AT_LAST = 4
#: Links that a task thins out at once.
THINNED = 1 << 16
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
EVEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * MIX_1
        values = (values ^ (values >> np.uint64(27))) * MIX_2
    return values ^ (values >> np.uint64(31))


BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * EVEN)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
SEEDS = mixed(np.arange(1, 2 * TOKENS + 1, dtype=np.uint64) * EVEN).astype(np.uint32)
FACTORS, SHIFTS = SEEDS[:TOKENS] | np.uint32(1), SEEDS[TOKENS:]
STEP = np.uint64(0xD1342543DE82EF95)
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


def words_of(texts: pa.Array, fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of ``texts`` in turn, its bytes taken through ``fold``, and the row each word is from."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    solid = np.concatenate([~SPACES[data], [False]])
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[offsets[:-1]] = solid[offsets[:-1]]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = np.searchsorted(offsets, starts, "right") - 1
    gaps = np.concatenate([np.flatnonzero(~solid), offsets[1:]])
    gaps.sort()
    ends = gaps[np.searchsorted(gaps, starts, "right")]
    # Sums of byte codes times powers; a word's is the difference of two, scaled to its start.
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data), STEP)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTES[fold[data]] * powers[:-1])])
        scale = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data), BACK)]))
        return mixed((sums[ends] - sums[starts]) * scale[starts] + (ends - starts).astype(np.uint64)), rows


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    part = np.cumsum(sizes) // HASHED_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(texts)]
    return [s for a, b in zip(edges, edges[1:], strict=False) for s in sets_at_once(texts.slice(a, b - a), width)]


def sets_at_once(texts: pa.Array, width: int) -> list[np.ndarray]:
    words, rows = words_of(texts)
    counts = np.bincount(rows, minlength=len(texts))
    ends = np.cumsum(counts)
    with np.errstate(over="ignore"):
        hashes = np.zeros(len(words), np.uint64)
        for k in range(width):
            hashes[: max(0, len(words) - k)] += mixed(words[k:] + EVEN * np.uint64(k + 1))
        hashes = mixed(hashes)
        sets = []
        for count, end in zip(counts, ends, strict=True):
            if count >= width:
                sets.append(np.unique(hashes[end - count : end - width + 1]))
            elif count:
                sets.append(mixed(np.array([hash_of(words[end - count : end])], np.uint64)))
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def hash_of(words: np.ndarray) -> int:
    """Of a sequence shorter than a shingle."""
    return int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8).digest(), "little")


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The minwise value of each of TOKENS hashes."""
    low = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(short), 2048):
            part = short[at : at + 2048]
            np.minimum(low, (part[:, None] * FACTORS + SHIFTS).min(axis=0), out=low)
    return low


def summaries(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, n_shingles, mark, sketch)``: mark is a 128-bit digest of the set, null for an empty set."""

    def run(batches):
        for batch in slices(batches):
            sets = shingle_sets(batch.column(1), width)
            marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            sketches = [sketch(s).tobytes() if len(s) else None for s in sets]
            yield pa.record_batch(
                {
                    "id": batch.column(0),
                    "n_shingles": pa.array(list(map(len, sets)), pa.int64()),
                    "mark": pa.array(marks, pa.binary()),
                    "sketch": pa.array(sketches, pa.binary()),
                }
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n_shingles long, mark binary, sketch binary")


def tokens_of(column: pa.Array) -> np.ndarray:
    """A row of TOKENS 64-bit tokens for each sketch."""
    values = np.array([np.frombuffer(x, np.uint32) for x in column.to_pylist()], np.uint64).reshape(-1, TOKENS)
    return mixed((np.arange(1, TOKENS + 1, dtype=np.uint64) << np.uint64(32)) | values)


def branches(nodes: DataFrame, threshold: float) -> DataFrame:
    """``(id, path, label, group)`` of the children of ``nodes`` (``id``, ``path``, ``sketch``, ``label``, ``group``)."""
    limit = np.uint64(int(2**64 / (threshold * TOKENS)))

    def run(batches):
        for batch in slices(batches):
            paths = batch.column(1).to_numpy().astype(np.int64).view(np.uint64)
            chosen = mixed(tokens_of(batch.column(2)) ^ mixed(paths + EVEN)[:, None])
            rows, at = np.nonzero(chosen < limit)
            children = mixed(chosen[rows, at] + STEP).view(np.int64)
            rows = pa.array(rows)
            ids, labels, groups = (batch.column(k).take(rows) for k in (0, 3, 4))
            yield pa.record_batch({"id": ids, "path": pa.array(children), "label": labels, "group": groups})

    return nodes.select("id", "path", "sketch", "label", "group").mapInArrow(run, "id long, path long, label long, group long")


def grouped(batches, keys: int):
    """The rows of each group, of batches that are sorted by their first ``keys`` columns; a group may span batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.Table.from_batches([batch])
        if held is not None:
            batch = pa.concat_tables([held, batch])
        batch = batch.combine_chunks()
        values = np.stack([batch.column(k).to_numpy() for k in range(keys)], 1)
        edges = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *edges[:-1]], edges, strict=False):
            yield batch.slice(a, b - a)
        held = batch.slice(edges[-1] if len(edges) else 0)
    if held is not None:
        yield held


def compared(nodes: DataFrame) -> DataFrame:
    """``(a, b)``: labels that are linked within small nodes (``path, id, label, sketch``), as far as connects what is alike."""

    def run(batches):
        a, b = [], []
        for node in grouped(batches, 1):
            labels = node.column("label").to_numpy()
            values = np.array([np.frombuffer(x, np.uint32) for x in node.column("sketch").to_pylist()])
            left = np.arange(1, len(labels))
            reached = [0]
            while reached:  # outwards from one set through all that are alike, then from the next
                near = left[(values[left] == values[reached[-1]]).sum(axis=1) >= AGREEING]
                own = labels[reached[-1]]
                other = np.unique(labels[near])
                other = other[other != own].tolist()
                a += [own] * len(other)
                b += other
                left = np.setdiff1d(left, near, assume_unique=True)
                reached = [*reached[:-1], *near.tolist()]
                if not reached and len(left):
                    reached, left = [left[0]], left[1:]
            if len(a) > 10_000:
                yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
                a, b = [], []
        yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    parts = shuffle_partitions(nodes.sparkSession)
    dealt = nodes.select("path", "id", "label", "sketch").repartition(parts, "path").sortWithinPartitions("path", "id")
    return dealt.mapInArrow(run, "a long, b long")


def missed(threshold: float, count: int) -> float:
    """The chance that ``count`` trees have no node at DEPTH with both sets of a pair at the threshold."""
    choice, chance = 1 / (threshold * TOKENS), 0.0
    for agreeing in range(TOKENS + 1):
        none = 0.0
        for _ in range(DEPTH):
            none = (1 - choice + choice * none) ** agreeing
        weight = math.comb(TOKENS, agreeing) * threshold**agreeing * (1 - threshold) ** (TOKENS - agreeing)
        chance += weight * none**count
    return chance


def trees(threshold: float) -> int:
    return next(count for count in itertools.count(1) if missed(threshold, count) < MISSED)


def rooted(sets: DataFrame, count: int) -> DataFrame:
    return sets.withColumn("path", F.explode(F.array(*[F.lit(k).cast("long") for k in range(count)])))


def bridged(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b)``: labels linked with those sets in large ``nodes`` (``path, id, label, group, top, n``) not of the ``top`` group.

    Without groups, labels are groups. They are sent to all blocks of the node, and in each linked to one set that is likely to be alike, unless other links
    of the block connect the two; so a block has fewer links than guests and one.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.array(F.pmod(F.xxhash64("id"), blocks))
    guest = F.col("group" if "group" in nodes.columns else "label") != F.col("top")
    dealt = nodes.select(
        "path", F.explode(F.when(guest, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(own)).alias("block"),
        "id", "label", guest.alias("guest"),
    ).join(sets.select("id", "sketch"), "id")

    def run(batches):
        for block in grouped(batches, 2):
            labels, guests = block.column("label").to_numpy(), int(pc.sum(block.column("guest").cast("int64")).as_py())
            values = np.array([np.frombuffer(x, np.uint32) for x in block.column("sketch").to_pylist()])
            # All blocks have the guests, so these are compared with each other in the first alone.
            among, joined = block.column("block")[0].as_py() == 0, labels.copy()
            a, b = [], []
            for k in range(guests):
                near = np.flatnonzero((values[k + 1 :] == values[k]).sum(axis=1) >= AGREEING) + k + 1
                for other in [*(near[near < guests] if among else []), *near[near >= guests][:1]]:
                    if joined[other] != joined[k]:
                        a.append(labels[k])
                        b.append(labels[other])
                        joined[joined == joined[other]] = joined[k]
            yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    parts = shuffle_partitions(nodes.sparkSession)
    dealt = dealt.select("path", "block", "guest", "id", "label", "sketch").repartition(parts, "path", "block")
    return dealt.sortWithinPartitions("path", "block", F.desc("guest"), "id").mapInArrow(run, "a long, b long")


def compared_throughout(members: DataFrame) -> DataFrame:
    """``(a, b)``: labels linked so that all sets of a cluster (``cluster, n, id, label, sketch``) that are likely to be alike are connected.

    Each two blocks of a cluster meet, and each block meets itself.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    dealt = members.select(
        "cluster", F.pmod(F.xxhash64("id"), blocks).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"), "id", "label", "sketch",
    ).select("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "label", "sketch")

    def run(batches):
        for pair in grouped(batches, 3):
            joined = pair.column("label").to_numpy().copy()
            values = np.array([np.frombuffer(x, np.uint32) for x in pair.column("sketch").to_pylist()])
            low, high, block = (pair.column(k).to_numpy() for k in ("low", "high", "block"))
            firsts = int((block == low).sum())
            a, b = [], []
            for k in range(firsts):
                start = k + 1 if low[0] == high[0] else firsts
                near = np.flatnonzero((values[start:] == values[k]).sum(axis=1) >= AGREEING) + start
                for own in np.setdiff1d(joined[near], joined[k : k + 1]):
                    a.append(joined[k])
                    b.append(own)
                    joined[joined == own] = joined[k]
            yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    parts = shuffle_partitions(members.sparkSession)
    dealt = dealt.repartition(parts, "cluster", "low", "high").sortWithinPartitions("cluster", "low", "high", "block", "id")
    return dealt.mapInArrow(run, "a long, b long")


def candidates(sets: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: labels linked so that all ``sets`` (``id, sketch, label, group``) that are likely to be alike are connected.

    Sets of one group are not compared again. Without labels, each set is its own; without groups, labels are groups.
    """
    if "label" not in sets.columns:
        sets = sets.withColumn("label", F.col("id"))
    if "group" not in sets.columns:
        sets = sets.withColumn("group", F.col("label"))
    roots = rooted(sets, trees(threshold))
    found, count = None, sets.count()
    for depth in range(1, DEPTH + 1):
        children = branches(roots, threshold)
        if "label" not in children.columns:
            children = children.withColumns({"label": F.col("id"), "group": F.col("id")})
        children = stored(children, "paths")
        sizes = children.groupBy("path").agg(F.count("*").alias("n"), F.min("group").alias("low"), F.max("group").alias("high"))
        sizes = stored(sizes.where("n > 1 and low <> high").select("path", "n"), "nodes")
        members = children.join(sizes, "path")
        small = members.where(F.col("n") <= SMALL).select("id", "path").join(sets, "id")
        large = stored(members.where(F.col("n") > SMALL), "large")
        tops = large.groupBy("path", "n", "group").agg(F.count("*").alias("c")).groupBy("path", "n")
        tops = tops.agg(F.max_by("group", "c").alias("top"), (F.col("n") - F.max("c")).alias("others"))
        tops = stored(tops.select("path", "top", "others", (F.col("n") * F.ceil(F.col("n") / BLOCK)).alias("dealt")), "tops")
        few = large.join(tops.where(F.col("others") <= SMALL).drop("dealt"), "path")
        links = compared(small).unionByName(bridged(few, sets))
        large = large.join(tops.where(F.col("others") > SMALL).select("path"), "path")
        dealt = tops.where(F.col("others") > SMALL).agg(F.sum("dealt")).first()[0] or 0
        last = dealt <= AT_LAST * count
        if dealt and last:
            rest = large.select(F.col("path").alias("cluster"), "n", "id", "label").join(sets.select("id", "sketch"), "id")
            links = links.unionByName(compared_throughout(rest))
        elif depth == DEPTH:
            held = large.select("path", "label").distinct()
            firsts = held.groupBy("path").agg(F.min("label").alias("a"))
            links = links.unionByName(held.join(firsts, "path").select("a", F.col("label").alias("b")))
        links = stored(links.where("a <> b").distinct(), "candidates")
        found = links if found is None else found.unionByName(links)
        if last:
            break
        roots = large.select("id", "path").join(sets, "id")
    return found


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the similarity of two sorted sets is at least ``percent``."""
    few, many = sorted((len(a), len(b)))
    if 100 * few < percent * many:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (few + many - common)


def confirm(sets: list[np.ndarray], sketches: np.ndarray, labels: np.ndarray, percent: int, guests: int = 0):
    """Pairs ``(a, b)`` of ``labels`` that connect those of sets that are alike, each with the least of its kind.

    Likely pairs are tried first, and only while their labels are not connected. With ``guests``, only pairs of
    one of the first ``guests`` sets and one of the others are tried.
    """
    agree = np.zeros((len(sets), len(sets)), np.int16)
    for k in range(TOKENS):
        agree += sketches[:, k, None] == sketches[None, :, k]
    i, j = np.nonzero(np.triu(agree >= AGREEING, 1))
    if guests:
        mixed_pairs = (i < guests) & (j >= guests)
        i, j = i[mixed_pairs], j[mixed_pairs]
    joined = labels.copy()
    for at in np.argsort(-agree[i, j], kind="stable"):
        a, b = i[at], j[at]
        if joined[a] != joined[b] and alike(sets[a], sets[b], percent):
            least = min(joined[a], joined[b])
            joined[(joined == joined[a]) | (joined == joined[b])] = least
    changed = joined != labels
    return np.unique(np.stack([joined[changed], labels[changed]], 1), axis=0)


def confirmed(members: DataFrame, percent: int, keys: list[str], guest: bool) -> DataFrame:
    """``(a, b)``: labels linked in the groups by ``keys`` of ``members`` (``id``, ``shingles``, ``label``, ``guest``)."""

    def run(batches):
        for group in grouped(batches, len(keys)):
            labels = group.column("label").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
            sketches = np.array([sketch(s) for s in sets])
            guests = int(pc.sum(group.column("guest")).as_py()) if guest else 0
            if guest and guests in (0, len(labels)):
                continue
            # Guests are compared some at a time.
            stay = np.arange(guests, len(labels))
            for at in range(0, max(1, guests), BLOCK):
                some = np.concatenate([np.arange(at, min(at + BLOCK, guests)), stay])
                pairs = confirm([sets[k] for k in some], sketches[some], labels[some], percent, len(some) - len(stay))
                yield pa.record_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    parts = shuffle_partitions(members.sparkSession)
    dealt = members.select(*keys, "id", "label", "guest", "shingles").repartition(parts, *keys)
    return dealt.sortWithinPartitions(*keys, F.desc("guest"), "id").mapInArrow(run, "a long, b long")


def full_sets(docs: DataFrame, members: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``members`` (``id``, ...) with ``shingles``, the full set as bytes."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = members.select("*", F.lit(b"").alias("shingles")).schema
    names = members.columns

    def run(batches):
        for batch in slices(batches):
            sets = [s.tobytes() for s in shingle_sets(batch.column(len(names)), width)]
            yield pa.record_batch([*batch.columns[:-1], pa.array(sets, pa.binary())], [*names, "shingles"])

    return rows.join(members, "id").select(*names, "text").mapInArrow(run, schema)


def thinned(links: DataFrame) -> DataFrame:
    """``links`` (``a``, ``b``) as few as connect what some ten thousand of them at once connect, each with the least id.

    Trees, levels and blocks give many ways from one set to another; what is left has short ways and is soon labelled.
    """

    def run(batches):
        least: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := least.setdefault(x, x)) != x:
                least[x] = x = least[up]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    least[max(a, b)] = min(a, b)
        ends = [(root(x), x) for x in list(least)]
        ends = [end for end in ends if end[0] != end[1]]
        yield pa.record_batch([pa.array([end[k] for end in ends], pa.int64()) for k in (0, 1)], ["a", "b"])

    tasks = max(1, -(-links.count() // THINNED))
    return stored(links.select("a", "b").repartition(tasks).mapInArrow(run, "a long, b long"), "thinned")


def gathered(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, component)`` of all ``nodes``, as :func:`components` gives it.

    Links are thinned while that helps; where a last task had all that were left, each end has its component.
    """
    count = links.count()
    while True:
        links, before = thinned(links), count
        if before <= THINNED:
            ends = links.select(F.col("b").alias("id"), F.col("a").alias("component"))
            return nodes.join(ends, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
        count = links.count()
        if 2 * count > before:
            return components(nodes, links)


def placed_in_blocks(docs: DataFrame, near: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, cluster, label, blocks, block, shingles)`` of ``near`` (``id, cluster, label``)."""
    sizes = near.groupBy("cluster").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK)
    members = join_unique(near, stored(sizes, "sizes"), ["cluster"], "n", near.count()).select(
        "id", "cluster", "label", blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).alias("block")
    )
    return stored(full_sets(docs, members, width, id_col, text_col), "sets")


def other_blocks():
    blocks = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    return F.explode(F.filter(blocks, lambda x: x != F.col("block")))


def linked_in_blocks(members: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: labels linked within the blocks of ``members``, each with the pilots of its cluster."""
    wide = members.where("blocks > 1")
    pilots = wide.groupBy("cluster", F.pmod(F.xxhash64("id", F.lit(1)), PILOTS)).agg(F.min("id").alias("id")).select("id")
    pilots = wide.join(pilots, "id").withColumn("block", other_blocks())
    home = members.unionByName(pilots.select(*members.columns)).withColumn("guest", F.lit(0))
    return stored(confirmed(home, percent, ["cluster", "block"], False), "links")


def complete(threshold: float) -> int:
    """The sets of a cluster up to which comparing all deals each to no more blocks than a level of the trees has nodes of it."""
    return BLOCK * trees(threshold)


def first_clusters(sets: DataFrame, threshold: float) -> DataFrame | None:
    """``(id, cluster, n)`` of the sets in large nodes of the first trees, ``n`` those of the cluster; none without such nodes."""
    roots = rooted(sets, FIRST_TREES)
    for _ in range(FIRST_DEPTH):
        children = stored(branches(roots, threshold), "paths")
        sizes = children.groupBy("path").agg(F.count("*").alias("n"), F.min("id").alias("least")).where(F.col("n") > SMALL)
        large = stored(children.join(sizes, "path").select("id", "path", "n", "least"), "large")
        if not large.limit(1).count():
            return None
        roots = large.select("id", "path").join(sets, "id")
    ways = large.select(F.col("least").alias("a"), F.col("id").alias("b")).where("a <> b").distinct()
    held = large.groupBy("id").agg(F.max(F.struct("n", "path")).alias("node"))
    held = stored(held.join(gathered(held.select("id"), stored(ways, "ways")), "id"), "held")
    sizes = held.groupBy("component").agg(F.count("*").alias("n"))
    held = held.join(sizes, "component").select(
        "id", F.when(F.col("n") <= complete(threshold), F.col("component")).otherwise(F.col("node.path")).alias("cluster")
    )
    sizes = held.groupBy("cluster").agg(F.count("*").alias("n"))
    return stored(held.join(sizes, "cluster").select("id", "cluster", "n"), "first")


def joined_copies(
    docs: DataFrame, sets: DataFrame, percent: int, width: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame | None]:
    """``sets`` with ``label`` and ``group``, and the links ``(a, b)`` of labels that were found within groups.

    Sets of one group have been compared with each other throughout, or are connected by links that full sets confirm, which
    give them one label. Other sets have their own id as label and group.
    """
    sets = sets.withColumns({"label": F.col("id"), "group": F.col("id")})
    first = first_clusters(sets.select("id", "sketch", "label", "group"), percent / 100)
    if first is None:
        return sets, None
    whole = F.col("n") <= complete(percent / 100)
    found = stored(compared_throughout(first.where(whole).join(sets.select("id", "label", "sketch"), "id")), "throughout")
    least = first.where(whole).groupBy("cluster").agg(F.min("id").alias("group"))
    known = first.where(whole).join(least, "cluster").select("id", F.col("id").alias("label"), "group")
    near = first.where(~whole).select("id", "cluster", F.col("id").alias("label"))
    if near.limit(1).count():
        links = linked_in_blocks(placed_in_blocks(docs, near, width, id_col, text_col), percent)
        labels = gathered(near.select("id"), links).withColumnRenamed("component", "label")
        known = known.unionByName(labels.withColumn("group", F.col("label")))
    sets = sets.select("id", "sketch").join(known, "id", "left")
    return stored(sets.withColumns({k: F.coalesce(k, "id") for k in ("label", "group")}), "labelled"), found


def by_label(frame: DataFrame, found: DataFrame) -> DataFrame:
    """``frame`` with the columns that ``found`` has for its ``label`` (``id`` there), if it has any."""
    sizes = frame.groupBy("label").agg(F.count("*").alias("n_label"))
    found = stored(found.withColumnRenamed("id", "label").join(sizes, "label"), "found")
    return join_unique(frame, found, ["label"], "n_label", frame.count()).drop("n_label")


def linked_components(
    docs: DataFrame, sets: DataFrame, percent: int, width: int, id_col: str, text_col: str
) -> DataFrame:
    """``(id, component)`` of distinct ``sets`` (``id``, ``sketch``). Links are of labels throughout."""
    sets, within = joined_copies(docs, sets, percent, width, id_col, text_col)
    maybe = candidates(sets, percent / 100)
    maybe = maybe if within is None else maybe.unionByName(within)
    near = gathered(maybe.select(F.col("a").alias("id")).union(maybe.select("b")).distinct(), maybe)
    near = by_label(sets.select("id", "label"), near.withColumnRenamed("component", "cluster"))
    members = placed_in_blocks(docs, stored(near.select("id", "cluster", "label"), "clusters"), width, id_col, text_col)
    links = thinned(linked_in_blocks(members, percent))

    wide = members.where("blocks > 1")
    if wide.limit(1).count():
        held = wide.select(F.col("label").alias("id")).distinct()
        inner = links.join(held.withColumnRenamed("id", "a"), "a", "left_semi")
        joined = gathered(held, inner).withColumnRenamed("component", "joined")
        at_home = by_label(wide, joined).drop("label").withColumnRenamed("joined", "label").withColumn("guest", F.lit(0))
        # What is not connected with most of its cluster goes round, in blocks of its own.
        counts = at_home.groupBy("cluster", "label").agg(F.count("*").alias("c")).groupBy("cluster")
        main = counts.agg(F.max_by("label", "c").alias("main"), (F.sum("c") - F.max("c")).alias("others"))
        main = stored(main.where("others > 0"), "main")
        groups = F.ceil(F.col("others") / BLOCK)
        at_home = at_home.join(main.select("cluster", "main", groups.alias("groups")), "cluster")
        away = at_home.where("label <> main").withColumn("guest", F.lit(1)).withColumn("block", other_blocks())
        away = away.withColumn("part", F.pmod(F.xxhash64("id", F.lit(2)), F.col("groups")))
        at_home = at_home.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
        round_ = confirmed(at_home.unionByName(away), percent, ["cluster", "block", "part"], True)
        links = links.unionByName(stored(round_, "links"))
    found = gathered(sets.select(F.col("label").alias("id")).distinct(), links)
    return by_label(sets.select("id", "label"), found).select("id", "component")


def near_dedup(
    docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` of every row; links from a similarity of ``percent`` on."""
    rows = stored(summaries(docs, width, id_col, text_col), "summaries")
    classes = rows.where(F.col("mark").isNotNull()).groupBy("mark")
    classes = stored(
        classes.agg(F.min("id").alias("first"), F.count("*").alias("copies"), F.first("sketch").alias("sketch")), "classes"
    )
    sets = classes.where(F.col("first").isNotNull()).select(F.col("first").alias("id"), "sketch")
    found = linked_components(docs, sets, percent, width, id_col, text_col)
    answers = stored(
        classes.select("mark", "copies", "first").join(found.withColumnRenamed("id", "first"), "first", "left"), "answers"
    )
    full = rows.where(F.col("mark").isNotNull()).drop("sketch")
    full = join_unique(full, answers.select("mark", "copies", "component"), ["mark"], "copies", rows.count())
    empty = rows.where(F.col("mark").isNull()).withColumn("component", F.col("id"))
    columns = ["id", "n_shingles", "component"]
    return full.select(*columns).unionByName(empty.select(*columns)).select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents"), percent=85, width=3)
