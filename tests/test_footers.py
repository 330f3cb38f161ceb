"""Schema versions out of footers, and the clustered layout."""

import random

import pytest
from pyspark.sql import types as T

from faregate.operators import cluster, layout
from faregate.sources import footers


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def deliver(spark, out, *versions):
    for rows, schema in versions:
        layout.write_parquet(spark.createDataFrame(rows, schema), out, mode="append")


@pytest.mark.parametrize(
    "kinds, widest",
    [
        (["int", "bigint"], "bigint"),
        (["float", "double"], "double"),
        (["tinyint", "smallint", "int"], "int"),
        (["int", "float"], "double"),
        (["bigint", "float"], None),
        (["string", "int"], None),
        (["string"], "string"),
        (["date", "timestamp_ntz"], "timestamp_ntz"),
    ],
)
def test_widest(kinds, widest):
    assert footers.wider(kinds) == widest and footers.wider(kinds[::-1]) == widest


def test_versions_in_one_scan(spark, out):
    deliver(
        spark, out,
        ([(1, 1.5, None), (2, None, "x")], "k int, v float, s string"),
        ([(1 << 40, 0.1, "y", 7)], "k bigint, v double, s string, late int"),
        ([], "k bigint, v double, s string, late int"),
        ([("z", 5)], "s string, k int"),
    )
    df = footers.read_versions(spark, out)
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {"k": "bigint", "v": "double", "s": "string", "late": "int"}
    assert rows_of(df.select("k", "v", "s", "late")) == sorted(
        [(1, 1.5, None, None), (2, None, "x", None), (1 << 40, 0.1, "y", 7), (5, None, "z", None)], key=str
    )
    assert df.where("k > 3").count() == 2  # a filter that reaches files of either type
    history = {(r["name"], r["kind"]): r["rows"] for r in footers.schema_history(footers.footers(spark, out)).collect()}
    assert history[("k", "int")] == 3 and history[("k", "bigint")] == 1 and history[("late", "int")] == 1


def test_narrowing_is_refused_by_name(spark, out):
    deliver(spark, out, ([(1, 1)], "k int, w bigint"), ([(2, 2)], "k bigint, w bigint"))
    wanted = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("absent", T.StringType())])
    with pytest.raises(footers.Narrowing, match="'k' is bigint"):
        footers.read_versions(spark, out, wanted)
    wider = T.StructType([T.StructField("k", T.LongType()), T.StructField("absent", T.StringType())])
    assert rows_of(footers.read_versions(spark, out, wider)) == [(1, None), (2, None)]


def test_types_without_a_common_one_are_refused(spark, out):
    deliver(spark, out, ([(1,)], "k int"), ([("a",)], "k string"))
    with pytest.raises(footers.Narrowing, match="'k' is int and string"):
        footers.read_versions(spark, out)


def test_names_that_differ_by_case_are_refused(spark, out):
    deliver(spark, out, ([(1,)], "k int"), ([(1,)], "K int"))
    with pytest.raises(footers.Narrowing, match="only by case"):
        footers.read_versions(spark, out)


def skewed(n=4000):
    draw = random.Random(3)
    return [
        (i, None if i % 50 == 0 else 7 if i % 3 == 0 else draw.randint(0, 10_000), draw.lognormvariate(0, 2)) for i in range(n)
    ]


def box(spark, *rows):
    return spark.createDataFrame(list(rows), "low0 double, high0 double, low1 double, high1 double")


def test_clustered_rows_are_the_rows(spark, out):
    rows = skewed()
    cluster.write_clustered(spark.createDataFrame(rows, "id int, a int, b double"), out, "a", "b", files=32)
    assert rows_of(spark.read.parquet(out)) == sorted(rows, key=str)


@pytest.mark.parametrize("boxes", [[(100, 900, 0.1, 1.0)], [(7, 7, 2.0, 3.0), (9000, 9999, 0.0, 0.2)], [(-5, -1, 0.0, 9e9)]])
def test_boxes_like_a_plain_filter(spark, out, boxes):
    rows = skewed()
    df = spark.createDataFrame(rows, "id int, a int, b double")
    cluster.write_clustered(df, f"{out}/z", "a", "b", files=32)
    layout.write_small_files(df, f"{out}/flat", 32)
    wanted = box(spark, *[tuple(float(x) for x in b) for b in boxes])
    inside = [r for r in rows if r[1] is not None and any(w <= r[1] <= x and y <= r[2] <= z for w, x, y, z in boxes)]
    for name in ("z", "flat"):
        assert rows_of(cluster.read_boxes(spark, f"{out}/{name}", "a", "b", wanted)) == sorted(inside, key=str)
    hit = {n: cluster.hit_groups(cluster.group_bounds(spark, f"{out}/{n}", "a", "b"), wanted).count() for n in ("z", "flat")}
    assert 2 * hit["z"] < hit["flat"] or not hit["flat"]


def test_a_hot_pair_is_split(spark, out):
    rows = [(i, 1 if i % 3 else i, 1.0 if i % 3 else float(i)) for i in range(3000)]
    cluster.write_clustered(spark.createDataFrame(rows, "id int, a int, b double"), out, "a", "b", files=16)
    sizes = [r["group_rows"] for r in cluster.group_bounds(spark, out, "a", "b").collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000


def test_empty_table_and_no_boxes(spark, out):
    cluster.write_clustered(spark.createDataFrame([], "id int, a int, b double"), out, "a", "b", files=4)
    assert cluster.read_boxes(spark, out, "a", "b", box(spark, (0.0, 1.0, 0.0, 1.0))).count() == 0
    assert cluster.read_boxes(spark, out, "a", "b", box(spark)).count() == 0
