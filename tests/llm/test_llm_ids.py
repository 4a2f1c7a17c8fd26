"""Large ids beside null ones stay as they are; columns of any name stay too."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hourboard.llm import packing, quality

BIG = (1 << 53) + 1
PROSE = "The committee met in the old town hall and agreed, after a long debate, to repair the bridge before winter. "


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(BIG + 2 * k, PROSE + f"It was meeting number {k} of the year.", "en") for k in range(40)]
    rows += [(None, PROSE + "It was meeting number 5 of the year.", "en")] * 3 + [(7, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    return frame.withColumns({"_id": F.lit("x"), "_score": F.lit(7.0), "_LANG_PRED": F.lit("y")})


def ids_of(frame):
    return sorted((row[0] for row in frame.select("doc_id").collect()), key=str)


def test_packing_keeps_large_ids(docs):
    parts = packing.pieces(docs, public_tokenizers.path(packing.VOCABULARY))
    assert ids_of(packing.pack(parts)) == ids_of(docs)


def test_quality_keeps_large_ids(spark, docs):
    labels = spark.createDataFrame([(BIG + 2 * k, 1) for k in range(40)], "doc_id long, quality int")
    found = quality.quality(docs, labels)
    assert ids_of(found) == ids_of(docs)
    assert ids_of(found.where("kept")) == ids_of(docs.where("text is not null"))


def test_pipeline_stages_keep_rows_and_columns(spark, docs, tmp_path):
    labels = spark.createDataFrame([(BIG + 2 * k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    good = ids_of(docs.where("text is not null"))
    for name, expected in (("quality", good), ("language", good)):
        found = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
        assert found.columns == docs.columns and ids_of(found) == expected
        assert found.select("_id", "_score", "_LANG_PRED").distinct().collect() == [("x", 7.0, "y")]
    near = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, str(tmp_path))
    assert near.columns == docs.columns and set(ids_of(near)) <= set(ids_of(docs)) and near.count() >= 1


def test_rows_without_id_stay_together(docs):
    none, some = docs.where("doc_id is null").limit(1), docs.where(F.col("doc_id") == BIG)
    assert ids_of(corpus_pipeline.keep(docs, none)) == [None] * 3
    assert ids_of(corpus_pipeline.keep(docs, some)) == [BIG]
    assert ids_of(corpus_pipeline.keep(docs, docs.where("false"))) == []
