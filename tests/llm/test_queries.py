"""Registered queries against their DuckDB twins, and the pipeline as a whole."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from faregate.llm.common import table
from faregate.llm.queries import ORACLE, QUERIES
from faregate.plans.catalog import TABLES
from tests.conftest import SF
from tests.llm.frames import awkward, documents
from tools.check_oracle import rows_of


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op3_quality", "op4_suffix_dedup", "op5_minhash", "op9_language_id"])
def test_one_row_per_document(spark, name):
    docs = table(spark, SF, "documents")
    got = QUERIES[name](spark, SF)
    assert got.count() == docs.count() == got.select("doc_id").distinct().count()


def test_pipeline(spark, out):
    docs = table(spark, SF, "documents")
    columns, ids = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    sizes = [len(ids)]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        docs.write.parquet(f"{out}/{i}")
        docs = spark.read.parquet(f"{out}/{i}")
        now = {r[0] for r in docs.select("doc_id").distinct().collect()}
        assert now <= ids, name
        sizes.append(len(now))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        ids = now
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > sizes[4] == sizes[5] > 0
    places = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert places.filter("n <> end or n > 1024").count() == 0


def test_stages_take_awkward_and_empty_tables(spark, out):
    for k, rows in enumerate((awkward(), [])):
        docs = documents(spark, rows)
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF).write.parquet(f"{out}/{k}-{i}")
            docs = spark.read.parquet(f"{out}/{k}-{i}")
        assert (docs.count() > 0) == bool(rows)
