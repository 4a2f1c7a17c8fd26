"""Exact dedup by an extendible-hash index on shared files.

Every distinct text has one entry under its 64-bit hash. The directory has 2**depth slots by the
first bits of the hash; a bucket that holds more entries than its capacity is split by one more
bit, and the directory doubles when that needs a bit it does not have. Buckets, and so ranges of
hashes, belong to owner tasks. An owner sorts its entries by hash, chains those that collide and
tells them apart by comparing the bytes of their texts; it writes them to the shared folder.

Defined results: a null text counts as the empty text. A null id loses to any id; a group of null
ids only keeps null. Of repeated rows (same id and text) all get the same decision, and one row
survives in :func:`survivors`. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.llm.shared import HOT_SHARE, join_unique, read, shuffle_partitions, stored, text_or_empty

#: Entries a bucket holds before it is split.
CAPACITY = 4096
#: Bits the directory can have; buckets still too full at this depth get longer instead. It bounds
#: the broadcast directory to 65,536 small rows.
MAX_DEPTH = 16


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, digest)`` of each row: 64-bit hash and SHA-256 of the text."""
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), F.sha2(text, 256).alias("digest")
    )


def directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``(slot, bucket, depth)``: the directory at ``max_depth`` bits for the distinct ``keys``.

    Starts with one bucket and splits overfull ones, a level at a time, until none is left. A
    bucket is named by its first slot.
    """
    slots = stored(
        keys.groupBy(slot_of(F.col("key"), max_depth).alias("slot")).agg(F.count("*").alias("entries")), "slots"
    )
    table = slots.select("slot", "entries", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("bucket"))
    for depth in range(max_depth):
        load = table.groupBy("bucket", "depth").agg(F.sum("entries").alias("load")).where(F.col("load") > capacity)
        if not load.limit(1).count():
            break
        split = F.col("load").isNotNull()
        low = F.shiftright("slot", max_depth - depth - 1)
        table = stored(
            table.join(F.broadcast(load), ["bucket", "depth"], "left").select(
                "slot",
                "entries",
                F.when(split, F.lit(depth + 1)).otherwise(F.col("depth")).alias("depth"),
                F.when(split, F.shiftleft(low, max_depth - depth - 1)).otherwise(F.col("bucket")).alias("bucket"),
            ),
            "directory",
        )
    return table.select("slot", "bucket", "depth")


def slot_of(key, bits: int):
    """The first ``bits`` bits of the hash ``key``, as a number from 0."""
    return F.shiftrightunsigned(key, 64 - bits)


def build_index(
    docs: DataFrame, posts: DataFrame, id_col: str = "doc_id", text_col: str = "text", payload: bool = False
) -> DataFrame:
    """Entries ``(bucket, key, digest, text, keep_id, group_size)`` on shared files, sorted by key in each owner's file.

    With ``payload`` an entry also has ``row``, a struct of the kept row's columns.
    """
    spark = docs.sparkSession
    counts = posts.groupBy("key").agg(F.count("*").alias("n"))
    counts = stored(counts, "keys")
    total = posts.count()
    hot = F.broadcast(counts.where(F.col("n") * HOT_SHARE > total).select("key"))

    text = text_or_empty(text_col)
    rows = docs.select(
        F.xxhash64(text).alias("key"),
        text.alias("text"),
        F.col(id_col).alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        *([F.struct(*docs.columns).alias("row")] if payload else []),
    )

    def merged(frame: DataFrame, *keys: str) -> DataFrame:
        kept = [F.coalesce(F.max_by("row", "keep_id"), F.first("row")).alias("row")] if payload else []
        return frame.groupBy(*keys, "text").agg(
            F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), *kept
        )

    # Hot texts are merged where they are read; others go to their owners as they are.
    cold = rows.join(hot, "key", "left_anti")
    warm = merged(rows.join(hot, "key", "left_semi"), "key")
    owners = shuffle_partitions(spark)
    slots = directory(counts.select("key"))
    bucketed = cold.unionByName(warm).withColumn("slot", slot_of(F.col("key"), MAX_DEPTH)).join(
        F.broadcast(slots.select("slot", "bucket")), "slot"
    )
    owner = F.floor(F.col("bucket") * owners / (1 << MAX_DEPTH)).cast("int")
    owned = bucketed.drop("slot").withColumn("owner", owner).repartitionById(owners, "owner")
    entries = merged(owned, "owner", "bucket", "key").withColumn("digest", F.sha2("text", 256))
    return stored(entries.drop("owner"), "index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, keep_id, group_size, kept, text_sha256)`` of every row of ``docs``."""
    posts = stored(postings(docs, id_col, text_col), "postings")
    index = build_index(docs, posts, id_col, text_col)
    found = index.select("key", "digest", "keep_id", "group_size")
    return join_unique(posts, found, ["key", "digest"], "group_size", posts.count()).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, read from the index."""
    posts = stored(postings(docs, id_col, text_col), "postings")
    return build_index(docs, posts, id_col, text_col, payload=True).select("row.*")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t,
             max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
             count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
      FROM documents)
"""
