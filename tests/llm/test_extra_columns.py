"""Map columns and clashing names through mixing and every stage of the pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from faregate.llm import minhash, mixing
from tests.conftest import SF
from tests.llm.frames import awkward, documents


def with_maps(spark):
    nested = F.struct(F.array(F.create_map(F.lit("k"), F.col("doc_id"))).alias("inside"), F.lit(1).alias("plain"))
    return (
        documents(spark, awkward())
        .withColumn("tags", F.create_map(F.lit("a"), F.col("source"), F.lit("b"), F.col("lang")))
        .withColumn("nested", nested)
        .withColumns({"_copy": F.lit("c"), "copies": F.lit("d"), "with.dot": F.lit(2)})
    )


def test_names_no_column_has(spark):
    out = mixing.mix_sources(with_maps(spark))
    assert len(set(out.columns)) == len(out.columns)
    assert {"__copy", "__copies"} <= set(out.columns)
    assert out.count() == out.select("tags", "nested").count() > 0


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_every_stage_takes_maps_and_clashing_names(spark, out, stage):
    docs = with_maps(spark)
    made = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF)
    made.write.parquet(out)
    if stage != corpus_pipeline.STAGES[-1][0]:
        assert made.columns == docs.columns
    assert spark.read.parquet(out).count() > 0


def test_one_of_rows_alike_in_id_and_text(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "en", f"s{i}") for i in range(30)]
    picked = {
        minhash.drop_near_duplicates(documents(spark, rows[k:] + rows[:k]).repartition(n)).first()["source"]
        for k, n in ((0, 1), (7, 3), (19, 5))
    }
    assert len(picked) == 1
