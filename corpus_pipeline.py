"""A pipeline over ``documents``: quality, language, exact copies, near copies, packing.

Each stage takes the session, what the stage before kept and the folder of the tables, and returns its
rows; :func:`run` writes them as Parquet into the shared folder and reads them again as the next
stage's documents. All but the last keep the columns of ``documents``.

Decisions are joined to the rows by id. Rows that share an id and a decision that keeps one of
them stay together, but for exact copies, of which one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.llm import exact_dedup, language_id, near_dedup, packing, quality
from hourboard.llm.shared import on_workers, read, stored


def unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until ``docs`` has no such column."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is among those of ``decisions`` (``doc_id``); rows without id stay if one is."""
    name = unused(docs, "_id")
    wanted = decisions.select(F.col("doc_id").alias(name)).distinct()
    kept = docs.join(wanted.where(F.col(name).isNotNull()), F.col("doc_id") == F.col(name), "left_semi")
    nameless = docs.where(F.col("doc_id").isNull()) if decisions.where("doc_id is null").limit(1).count() else None
    return kept.unionByName(nameless) if nameless is not None else kept


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    on_workers(spark)
    found = quality.quality(docs, read(spark, sf_dir, "labels"))
    return keep(docs, stored(found.where("kept").select("doc_id"), "kept"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language was found."""
    on_workers(spark)
    names = unused(docs, "_lang_pred"), unused(docs, "_score")
    found = language_id.identify(docs, language_id.learn(docs), names=names)
    return found.where(F.col(names[0]) != language_id.UNKNOWN).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.survivors(docs).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    on_workers(spark)
    return keep(docs, stored(near_dedup.near_dedup(docs).where("kept").select("doc_id"), "kept"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequences and places."""
    on_workers(spark)
    return packing.pack(packing.pieces(docs, public_tokenizers.path(packing.VOCABULARY)))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("packing", packing_stage),
]

#: SQL has no form of the quality and language models, nor of the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
