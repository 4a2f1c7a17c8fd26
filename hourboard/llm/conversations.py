"""Conversation structure repair by the auction algorithm for shortest paths.

A conversation should be one system message at most, then user and assistant in turn. Each of its rows, by turn,
is kept, given another role or deleted, and rows are inserted, at the least cost (:data:`KEEP` and so on). That is a
shortest path through a lattice: a node says how many rows are dealt with and what the output ends with.

The auction keeps a path from the start and a price at each node, at most the cost of any arc plus the
price behind it. The path is extended along the cheapest arc where the price of its end equals that, and else the price
is raised to it and the path contracted by one. Prices start from what each row costs at least. When the path
arrives, the start's price is the least cost, and every shortest path consists of tight arcs (price equal to
cost plus price behind). Those from which tight arcs lead on to the end are walked letter by letter, the
smallest first, for the least of all cheapest audits. No letter leads from a node to two others.

Conversations of up to LONG rows are groups of sorted partitions, one at a time. Longer ones are sorted over
all tasks and cut into segments; each gives the costs from any ending to any other, and these are the arcs of a
coarse lattice with 16 numbers a segment, solved in blocks of blocks by the same auction. Its prices at the borders
let each segment be traced by itself for every ending before it; a last pass over the segments in order picks the
one that holds. Only digests are taken in one task from end to end, a segment at a time. Rows that agree
in conversation, turn, role and the first 64 letters stay in one task.

Defined results: a null role or text counts as one space. Null turns come first; rows of one turn are taken by role,
then text. A role's initial is its first letter as it is; a row without one of s, u, a cannot be kept. A null
conversation is one of its own. Repeated rows are duplicates. Other columns are not looked at; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.llm.shared import join_unique, read, shuffle_partitions, stored

#: Costs of the edits, and of leaving a truncated row.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Endings of the output: nothing, system, user, assistant; by what a kept row of an initial leads to, and the next inserted.
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
ROLE = {2: "user", 3: "assistant"}
#: What is left to insert at the end of a conversation, and what that costs.
TAIL = {0: "", 1: "II", 2: "I", 3: ""}
TAIL_COST = {state: INSERT * len(letters) for state, letters in TAIL.items()}
#: Rows and bytes of a conversation, or of a segment of one, that are solved at once; segments in a block.
LONG, LONG_BYTES, BLOCK = 256, 8 << 20, 64
#: Price and target where no arc leads on.
NOWHERE = (float("inf"), -1)
SPACES = " \t\n\v\f\r"
FAULTS = ("blank", "duplicate", "truncated")


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, there)``: rows dropped (not ``there``), emptied, cut, repeated, made user by a checksum."""
    space = F.lit(" ")
    number, turn = (F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn"))
    what = F.crc32(F.concat(number, F.lit(":"), turn)) % 20
    role, text = (F.coalesce(F.col(name).cast("string"), space) for name in ("role", "text"))
    there = what != 0
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(what == 4, "user").otherwise(role)
    times = F.array_repeat(F.lit(0), F.when(what == 3, 2).otherwise(1))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), there.alias("there"), times.alias("times"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("there"), F.col("role")).alias("role"), F.when(F.col("there"), F.col("text")).alias("text"),
        "there", F.explode("times").alias("time"),
    ).drop("time")


class Lattice:
    """Arcs ``(letter, cost, target)`` by node, the last node being the goal, and prices that no arc undercuts."""

    def __init__(self, arcs: list, prices: list):
        self.arcs, self.prices = arcs, prices
        self.goal = len(arcs) - 1

    def reaches(self, start: int) -> bool:
        seen, open_ = {start}, [start]
        while open_:
            for _, _, target in self.arcs[open_.pop()]:
                if target not in seen:
                    seen.add(target)
                    open_.append(target)
        return self.goal in seen

    def auction(self, start: int) -> int:
        """The least cost from ``start``, which has to reach the goal; prices are raised as far as that takes."""
        arcs, prices, path = self.arcs, self.prices, [start]
        while path[-1] != self.goal:
            node = path[-1]
            best, target = min(((cost + prices[target], target) for _, cost, target in arcs[node]), default=NOWHERE)
            if prices[node] == best:
                path.append(target)
            else:
                prices[node] = best
                if len(path) > 1:
                    path.pop()
        return prices[start]

    def tight(self) -> list[list]:
        """The tight arcs of each node from which tight arcs lead on to the goal."""
        live = [False] * self.goal + [True]
        into = [[] for _ in self.arcs]
        for node, arcs in enumerate(self.arcs):
            for arc in arcs:
                if self.prices[node] == arc[1] + self.prices[arc[2]]:
                    into[arc[2]].append((node, arc))
        found, open_ = [[] for _ in self.arcs], [self.goal]
        while open_:
            for node, arc in into[open_.pop()]:
                found[node].append(arc)
                if not live[node]:
                    live[node] = True
                    open_.append(node)
        return found


def lattice_of(rows: str, exits: dict[int, int], final: bool) -> Lattice:
    """The lattice of ``rows``, two letters each (initial, fault), that may end as ``exits`` says, at these costs.

    At the end rows are inserted only if it is ``final``.
    """
    size = len(rows) // 2
    arcs, least = [], []
    for k in range(size + 1):
        initial, fault = rows[2 * k : 2 * k + 2] or ("", "")
        more = TRUNCATED if fault == "t" else 0
        least.append(DELETE if fault in ("t", "d") else 0)
        for state in range(4):
            here = []
            if k < size:
                here.append(("D", DELETE, 4 * (k + 1) + state))
                if fault != "d":
                    here.append(("R", REROLE + more, 4 * (k + 1) + NEXT[state]))
                    if state in KEPT.get(initial, ()):
                        here.append(("K", KEEP + more, 4 * (k + 1) + KEPT[initial][state]))
            elif state in exits:
                here.append(("", exits[state], 4 * (size + 1)))
            if k < size or final:
                here.append(("I", INSERT, 4 * k + NEXT[state]))
            arcs.append(here)
    ahead, prices = min(exits.values()), []
    for k in range(size, -1, -1):
        ahead += least[k] if k < size else 0
        prices += [ahead] * 4
    return Lattice([*arcs, []], [*reversed(prices), 0])


def encoded(initial: str, fault: str | None) -> str:
    """A row as :func:`lattice_of` wants it."""
    return (initial if initial in KEPT else "x") + {None: "k", "truncated": "t"}.get(fault, "d")


def walk(tight: list[list], start: int, goal: int) -> str:
    """The least letters along tight arcs, the end coming first."""
    letters, node = [], start
    while node != goal:
        letter, _, node = min(tight[node])
        letters.append(letter)
    return "".join(letters)


@lru_cache(1 << 16)
def repaired(rows: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    lattice = lattice_of(rows, {0: 0, 3: 0}, True)
    cost = lattice.auction(0)
    return cost, walk(lattice.tight(), 0, lattice.goal)


@lru_cache(1 << 12)
def transfers(rows: str) -> list[int | None]:
    """The least cost through a segment from each ending to each, None where there is no way."""
    found = [None] * 16
    for after in range(4):
        lattice = lattice_of(rows, {after: 0}, False)
        for before in range(4):
            if lattice.reaches(before):
                found[4 * before + after] = lattice.auction(before)
    return found


def coarse(costs: list[list], exits: dict[int, int]) -> Lattice:
    """The lattice over segments that cost ``costs`` (as :func:`transfers`)."""
    arcs = [
        [("", cost[4 * before + after], 4 * (k + 1) + after) for after in range(4) if cost[4 * before + after] is not None]
        for k, cost in enumerate(costs)
        for before in range(4)
    ]
    goal = 4 * (len(costs) + 1)
    arcs += [[("", exits[state], goal)] if state in exits else [] for state in range(4)]
    ahead, prices = min(exits.values()), []
    for cost in [*reversed(costs), None]:
        prices += [ahead] * 4
        ahead += min(filter(lambda x: x is not None, cost)) if cost else 0
    return Lattice([*arcs, []], [*reversed(prices), 0])


def priced(costs: list[list], entries: list[int], exits: dict[int, int]) -> list[dict[int, int]]:
    """At each border of the segments, the endings on cheapest ways on and what is still to pay from there."""
    if len(costs) > BLOCK:
        step = max(BLOCK, -(-len(costs) // BLOCK))
        blocks = [costs[at : at + step] for at in range(0, len(costs), step)]
        outer = priced([block_transfers(block) for block in blocks], entries, exits)
        inner = [priced(block, list(a), b) for block, a, b in zip(blocks, outer, outer[1:], strict=False)]
        return [border for block in inner for border in block[:-1]] + [outer[-1]]
    lattice = coarse(costs, exits)
    for entry in entries:
        lattice.auction(entry)
    tight = lattice.tight()
    return [
        {state: lattice.prices[4 * k + state] for state in range(4) if tight[4 * k + state]} for k in range(len(costs) + 1)
    ]


def block_transfers(costs: list[list]) -> list[int | None]:
    found = [None] * 16
    for after in range(4):
        lattice = coarse(costs, {after: 0})
        for before in range(4):
            if lattice.reaches(before):
                found[4 * before + after] = lattice.auction(before)
    return found


def rewritten(audit: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], int]:
    """``role:text`` of what ``audit`` leaves of rows, and the ending."""
    lines, row = [], 0
    for letter in audit:
        if letter == "D":
            row += 1
            continue
        role, text = ("", "") if letter == "I" else (roles[row], texts[row])
        if letter == "K":
            state = KEPT[role[0]][state]
        else:
            state = NEXT[state]
            role = ROLE[state]
        row += letter != "I"
        lines.append(f"{role}:{text}")
    return lines, state


def fault_of(text: str, again: bool) -> str | None:
    """The first fault of a row."""
    end = text.rstrip(SPACES)
    if not end:
        return "blank"
    return "duplicate" if again else None if end[-1] in ".!?" else "truncated"


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def by_key(batches, names: list[str]) -> Iterator[tuple]:
    """Rows as tuples, of batches that are sorted; Arrow batches are of bounded size."""
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)


def record_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 512, most_bytes: int = LONG_BYTES):
    """``rows`` in batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(value) for value in row if isinstance(value, str))
        if len(held) >= most or size > most_bytes:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema.names)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema.names)


COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
WHOLE = pa.schema(
    [("conv_id", pa.int64()), ("gaps", pa.int64()), *[(name, pa.int64()) for name in COUNTS], ("audit", pa.string()), ("repaired", pa.string())]
)
WHOLE_DDL = "conv_id long, gaps long, " + ", ".join(f"{name} long" for name in COUNTS) + ", audit string, repaired string"


def short_conversations(rows: DataFrame) -> DataFrame:
    """One row of WHOLE for each conversation, of at most LONG rows."""

    def solved(conv, turns, roles, texts) -> tuple:
        seen, faults = set(), []
        for role, text in zip(roles, texts, strict=True):
            faults.append(fault_of(text, (role, text) in seen))
            seen.add((role, text))
        cost, audit = repaired("".join(encoded(role[:1], fault) for role, fault in zip(roles, faults, strict=True)))
        known = [turn for turn in turns if turn is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        lines, _ = rewritten(audit, roles, texts, 0)
        counts = [faults.count(name) for name in FAULTS]
        return conv, gaps, *counts, illegal([role[:1] for role in roles]), cost, audit, "\n".join(lines)

    def conversations(batches):
        last, held = None, ([], [], [])
        for key, conv, turn, role, text, there in by_key(batches, ["key", "conv_id", "turn", "role", "text", "there"]):
            if last is None or last[0] != key:
                if last is not None:
                    yield solved(last[1], *held)
                last, held = (key, conv), ([], [], [])
            if there:
                for values, value in zip(held, (turn, role, text), strict=True):
                    values.append(value)
        if last is not None:
            yield solved(last[1], *held)

    parts = shuffle_partitions(rows.sparkSession)
    dealt = rows.repartition(parts, "key").sortWithinPartitions("key", "turn", "role", "text")
    return dealt.mapInArrow(lambda batches: record_batches(conversations(batches), WHOLE), WHOLE_DDL)


SEGMENT = pa.schema(
    [("key", pa.string()), ("conv_id", pa.int64()), ("part", pa.int32()), ("segment", pa.int64())]
    + [(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal")]
    + [("first", pa.string()), ("last", pa.string()), ("rows", pa.string()), ("costs", pa.list_(pa.int64()))]
    + [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
)
SEGMENT_DDL = (
    "key string, conv_id long, part int, segment long, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, rows string, costs array<long>, roles array<string>, texts array<string>"
)


def segments(rows: DataFrame) -> DataFrame:
    """The rows of long conversations in segments of LONG, with what they cost from each ending to each."""
    rows = stored(rows.where("there").withColumn("place", F.monotonically_increasing_id()), "rows")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "place")
    same = rows.groupBy("key", F.sha2("role", 256).alias("a"), F.sha2("text", 256).alias("b"))
    firsts = same.agg(F.min(order).alias("first")).select(F.col("first.place").alias("place"), F.lit(True).alias("new"))
    marked = rows.join(firsts, "place", "left").withColumn("again", F.col("new").isNull())
    parts = shuffle_partitions(rows.sparkSession)
    sorted_ = marked.repartitionByRange(parts, "key", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions(
        "key", "turn", "role", "text", "place"
    )

    def cut(batches):
        part, number, last, held, size = TaskContext.get().partitionId(), 0, None, [], 0
        for key, conv, role, text, again in by_key(batches, ["key", "conv_id", "role", "text", "again"]):
            if held and (key != last[0] or len(held) >= LONG or size > LONG_BYTES):
                yield segment(*last, part, number, held)
                number, held, size = number + 1, [], 0
            last = (key, conv)
            held.append((role, text, fault_of(text, again)))
            size += len(text)
        if held:
            yield segment(*last, part, number, held)

    def segment(key, conv, part, number, held) -> tuple:
        initials = [role[:1] for role, _, _ in held]
        faults = [fault for _, _, fault in held]
        sketch = "".join(map(encoded, initials, faults))
        counts = [faults.count(name) for name in FAULTS]
        return (
            key, conv, part, number, *counts, illegal(initials), initials[0], initials[-1], sketch, transfers(sketch),
            [role for role, _, _ in held], [text for _, text, _ in held],
        )

    # A batch is a segment, so that its texts are within bounds.
    found = sorted_.mapInArrow(lambda batches: record_batches(cut(batches), SEGMENT, 1), SEGMENT_DDL)
    return stored(found, "segments")


def chosen(parts: DataFrame) -> DataFrame:
    """``(key, part, segment, audit, repaired, cost, illegal)`` of each segment, and of the end of each conversation."""
    borders = pa.schema([("key", pa.string()), ("part", pa.int32()), ("segment", pa.int64()), ("before", pa.list_(pa.int64())),
                         ("after", pa.list_(pa.int64())), ("joint", pa.int64())])

    def solved(key, held):
        found = priced([costs for _, _, _, _, costs in held], [0], TAIL_COST)
        for k, (part, segment, first, _, _) in enumerate(held):
            joint = illegal([held[k - 1][3], first]) if k else 0
            yield key, part, segment, sorted(found[k]), [found[k + 1].get(state, -1) for state in range(4)], joint

    def conversations(batches):
        last, held = None, []
        for key, *row in by_key(batches, ["key", "part", "segment", "first", "last", "costs"]):
            if held and key != last:
                yield from solved(last, held)
                held = []
            last = key
            held.append(row)
        if held:
            yield from solved(last, held)

    count = shuffle_partitions(parts.sparkSession)
    narrow = parts.select("key", "part", "segment", "first", "last", "costs").repartition(count, "key")
    prices = narrow.sortWithinPartitions("key", "part", "segment").mapInArrow(
        lambda batches: record_batches(conversations(batches), borders),
        "key string, part int, segment long, before array<long>, after array<long>, joint long",
    )
    names = ["key", "part", "segment", "rows", "roles", "texts", "before", "after", "joint"]
    ways = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("audit", pa.string()), ("repaired", pa.string()), ("cost", pa.int64())])
    traced = pa.schema([("key", pa.string()), ("part", pa.int32()), ("segment", pa.int64()), ("joint", pa.int64()), ("ways", pa.list_(ways))])

    def trace(batches):
        for key, part, segment, rows, roles, texts, before, after, joint in by_key(batches, names):
            lattice = lattice_of(rows, {state: price for state, price in enumerate(after) if price >= 0}, False)
            for state in before:
                lattice.auction(state)
            tight, found = lattice.tight(), []
            for state in before:
                audit = walk(tight, state, lattice.goal)
                lines, end = rewritten(audit, roles, texts, state)
                cost = lattice.prices[state] - after[end]
                found.append({"before": state, "after": end, "audit": audit, "repaired": "\n".join(lines) if lines else None, "cost": cost})
            yield key, part, segment, joint, found

    alternatives = parts.join(prices, ["key", "part", "segment"]).select(*names).mapInArrow(
        lambda batches: record_batches(trace(batches), traced, 1),
        "key string, part int, segment long, joint long, "
        "ways array<struct<before: int, after: int, audit: string, repaired: string, cost: long>>",
    )
    result = pa.schema([("key", pa.string()), ("part", pa.int32()), ("segment", pa.int64()), ("audit", pa.string()), ("repaired", pa.string()),
                        ("cost", pa.int64()), ("illegal", pa.int64())])

    def pick(batches):
        last, state = None, 0
        for key, part, segment, joint, found in by_key(batches, traced.names):
            if key != last:
                if last is not None:
                    yield end_of(last, state)
                last, state = key, 0
            way = next(way for way in found if way["before"] == state)
            state = way["after"]
            yield key, part, segment, way["audit"], way["repaired"], way["cost"], joint
        if last is not None:
            yield end_of(last, state)

    def end_of(key, state) -> tuple:
        lines, _ = rewritten(TAIL[state], [], [], state)
        return key, 1 << 30, 0, TAIL[state], "\n".join(lines) if lines else None, TAIL_COST[state], 0

    dealt = stored(alternatives, "ways").repartition(count, "key").sortWithinPartitions("key", "part", "segment")
    return dealt.mapInArrow(
        lambda batches: record_batches(pick(batches), result, 1),
        "key string, part int, segment long, audit string, repaired string, cost long, illegal long",
    )


def digested(parts: DataFrame) -> DataFrame:
    """``(key, cost, illegal, audit, repaired_sha256)`` of the segments that :func:`chosen` gives, in its order."""
    result = pa.schema([("key", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches):
        last, digest, some, cost, bad, audit = None, None, False, 0, 0, []
        for key, letters, text, more, joint in by_key(batches, ["key", "audit", "repaired", "cost", "illegal"]):
            if key != last:
                if last is not None:
                    yield last, cost, bad, "".join(audit), digest.hexdigest()
                last, digest, some, cost, bad, audit = key, hashlib.sha256(), False, 0, 0, []
            cost, bad = cost + more, bad + joint
            audit.append(letters)
            if text is not None:
                digest.update(("\n" * some + text).encode())
                some = True
        if last is not None:
            yield last, cost, bad, "".join(audit), digest.hexdigest()

    return parts.mapInArrow(
        lambda batches: record_batches(run(batches), result), "key string, cost long, illegal long, audit string, repaired_sha256 string"
    )


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with a ``key`` that is never null, and ids and turns as numbers."""
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("long").cast("string")), F.lit(""))
    return rows.select(
        key.alias("key"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "there"
    )


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The ``rows`` of conversations that are solved at once, and of those that are cut into segments, if any."""
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), size.alias("bytes"))
    sizes = stored(sizes.withColumn("long", (F.col("n") > LONG) | (F.col("bytes") > LONG_BYTES)), "sizes")
    if not sizes.where("long").limit(1).count():
        return rows, None
    marked = stored(join_unique(rows, sizes, ["key"], "n", rows.count()), "conversations")
    return marked.where("not long").select(*rows.columns), marked.where("long").select(*rows.columns)


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (``conv_id, turn, role, text, there``): faults, cost, audit, digest."""
    short, long = split(keyed(rows))
    digest = F.sha2("repaired", 256).alias("repaired_sha256")
    found = short_conversations(short).select(*[name for name in WHOLE.names if name != "repaired"], digest)
    if long is None:
        return found
    parts = segments(long)
    there = long.where("there")
    turns = there.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    # Conversations of which no row is left are in ``long`` too.
    sums = parts.groupBy("key").agg(*[F.sum(name).alias(name) for name in FAULTS], F.sum("illegal").alias("inside"))
    whole = long.groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    for table in (turns, sums, digested(chosen(parts))):
        whole = whole.join(table, "key", "left")
    zero = F.lit(0).cast("long")
    counts = {name: F.coalesce(name, zero) for name in ("gaps", *FAULTS, "cost")}
    counts["illegal"] = F.coalesce(F.col("illegal") + F.col("inside"), zero)
    empty = hashlib.sha256(b"").hexdigest()
    whole = whole.select(
        "conv_id",
        *[counts[name].alias(name) for name in ("gaps", *COUNTS)],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
    return found.unionByName(whole)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(read(spark, sf_dir, "conversations")))
