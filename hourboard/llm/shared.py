"""What the operators share: the shared folder, tables in it, joins with hot keys, components."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that hold more than one row in so many are broadcast, so there are at most so many of them.
HOT_SHARE = 1000
#: Most rows in an Arrow batch for Python stages, so that a batch of texts stays within some tens of MB.
BATCH_ROWS = 2048
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names, which all executors reach.

    Where the session names none (as in tests) the folder is put into the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a table in the shared folder: computed once, and safe from lost executors."""
    spark = frame.sparkSession
    path = shared_path(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, and get batches of bounded size."""
    if not 0 < int(spark.conf.get(BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shuffled(table: DataFrame) -> DataFrame:
    """``table``, which the join it goes to never broadcasts: for tables that grow with the input.

    What Spark compares with its limit for broadcasts is the size of the compressed files a table is made from, and
    an ``explode`` does not add to it, so the table may be a hundred times as large in memory, the driver's as well.
    """
    return table.hint("merge")


def join_unique(
    big: DataFrame, small: DataFrame, keys: list[str], count: str, total: int, grows: bool = False
) -> DataFrame:
    """Inner join to ``small``, which has one row per key and in ``count`` how many of ``total`` rows have it.

    Keys with over one row in :data:`HOT_SHARE` number fewer than that and are broadcast; the rest
    have no hot key and are shuffled, where Spark's limit says so or the table ``grows``.
    """
    hot = F.broadcast(small.where(F.col(count) * HOT_SHARE > total))
    cold = small.where(F.col(count) * HOT_SHARE <= total)
    cold = shuffled(cold) if grows else cold
    few = big.join(hot, keys)
    many = big.join(hot.select(*keys), keys, "left_anti").join(cold, keys)
    return few.unionByName(many)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, component)`` of all ``nodes`` (column ``id``, distinct): the smallest id reachable by ``edges`` (``a``, ``b``).

    Labels are lowered along links and then shortened (the label of a label), each round written
    to the shared folder, until a round changes none. Only the number of changes is read back.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "links")
    labels = stored(nodes.select("id", F.col("id").alias("component")), "labels")
    linked = both.select(F.col("a").alias("id")).distinct()
    active = stored(labels.join(linked, "id", "left_semi"), "labels")
    while True:
        seen = (
            both.join(active.select(F.col("id").alias("b"), F.col("component").alias("near")), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("near").alias("near"))
        )
        lower = active.join(seen, "id", "left").select(
            "id", F.col("component").alias("old"), F.least("component", F.coalesce("near", "component")).alias("component")
        )
        lower = stored(lower, "labels")
        roots = lower.select(F.col("id").alias("component"), F.col("component").alias("root"))
        # The roots of large components are hot keys of this join; there are few labels per root.
        hops = lower.join(roots, "component", "left").select(
            "id", "old", F.least("component", F.coalesce("root", "component")).alias("component")
        )
        hops = stored(hops, "labels")
        changed = hops.where("component <> old").limit(1).count()
        active = hops.select("id", "component")
        if not changed:
            break
    return labels.join(active.withColumnRenamed("component", "low"), "id", "left").select(
        "id", F.coalesce("low", "component").alias("component")
    )
