"""Differences of tables by signed cells, and hot keys by a sketch."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from faregate.operators import difference, shares

SCHEMA = "a int, b string, c double, d array<string>"


def rows(seed, count):
    draw = random.Random(seed)
    return [(draw.choice([None, i, 1]), draw.choice([None, "x", "y", "xy"]), draw.choice([0.5, None, float("nan"), -0.0]),
             draw.choice([None, [], [None, "p"], ["p", None]])) for i in range(count)]


def listed(df):
    return Counter({(repr(tuple(r)[:-2]), r["side"]): r["times"] for r in df.collect()})


def plain(left, right):
    a, b = Counter(map(repr, left)), Counter(map(repr, right))
    return Counter({(k, "left"): n for k, n in (a - b).items()} | {(k, "right"): n for k, n in (b - a).items()})


@pytest.mark.parametrize("cells", [300, 3000])
def test_equals_a_plain_multiset_difference(spark, cells):
    """With 300 cells there are more differences than the cells can hold."""
    left = rows(1, 3000)
    right = left[:2600] + [(r[0], "z", *r[2:]) for r in left[2600:]] + left[:30] * 2
    random.Random(2).shuffle(right)
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA).select("d", "c", "b", "a")
    got = difference.difference(a, b.repartition(7), cells)
    assert listed(got) == plain(left, right)


def test_nothing_differs(spark):
    a = spark.createDataFrame(rows(3, 500), SCHEMA)
    assert difference.difference(a, a.repartition(9)).count() == 0
    assert difference.difference(a.limit(0), a.limit(0)).count() == 0
    assert difference.difference(a, a.limit(0)).agg(F.sum("times")).first()[0] == 500


def test_missing_values_do_not_move(spark):
    a = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    b = spark.createDataFrame([(1, None), (None, 2)], "a int, b int")
    assert difference.difference(a, b).count() == 4


def test_only_like_tables(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(ValueError, match="one table only"):
        difference.difference(a, a.withColumnRenamed("b", "c"))
    with pytest.raises(ValueError, match="types"):
        difference.difference(a, a.withColumn("a", F.col("a").cast("bigint")))
    with pytest.raises(ValueError, match="maps"):
        m = a.withColumn("m", F.create_map("b", "a"))
        difference.difference(m, m)


def test_rows_are_not_shuffled(spark):
    wide = spark.range(2000).select("id", F.repeat(F.md5(F.col("id").cast("string")), 50).alias("text"))
    plan = difference.signed_cells(wide, wide)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange" in line]
    assert exchanges and all("cell" in line and "text" not in line for line in exchanges)


def test_cells_that_look_single():
    assert difference._single([2, 4, 6, 8, 10, 1]) is None
    assert difference.take_out({5: [1, 1, 1, 1, 1, 1]}) == ([], False)


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("share", [0.3, 0.02, 0.002])
def test_hot_keys_are_those_of_a_grouping(spark, kind, share):
    i = F.col("id")
    key = F.when(i % 3 == 0, -1).when(i % 50 == 1, -2).when(i % 400 == 2, -3).when(i % 11 == 4, F.lit(None)).otherwise(i)
    df = spark.range(30_000).select(key.cast(kind).alias("key"))
    want = shares.key_shares(df, "key").where(F.col("share") >= share)
    got = shares.hot_keys(df, "key", share)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "approx_top_k" in plan.lower()


def test_hot_keys_of_small_shares_and_other_types(spark):
    df = spark.range(100).select((F.col("id") % 4).alias("key"), (F.col("id") % 4 / 2).alias("half"))
    assert shares.hot_keys(df, "key", 1e-6).count() == 4
    assert shares.hot_keys(df, "half", 0.2).count() == 4
    assert shares.hot_keys(df.limit(0), "key", 0.2).count() == 0
