from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from faregate.operators import balance, curate, joins, shares
from faregate.plans import catalog, trips
from faregate.session import SQL_PROFILES, variant_session
from tests.conftest import SF


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sides(spark):
    fact = spark.range(6_000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("k")
    )
    dim = spark.range(50).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("z"), "id").alias("zone"))
    return fact, dim


@pytest.mark.parametrize(
    "strategy,node", [("broadcast", "BroadcastHashJoin"), ("hash", "ShuffledHashJoin"), ("merge", "SortMergeJoin")]
)
def test_strategy_gives_its_join_node(sides, strategy, node):
    fact, dim = sides
    df = joins.join_dimension(fact, dim, "k", strategy)
    assert node in planned(df)
    assert df.count() == 6_000


def test_unknown_strategy(sides):
    with pytest.raises(ValueError):
        joins.join_dimension(*sides, "k", "magic")


def test_a_large_side_is_not_broadcast(sides):
    fact, dim = sides
    hinted = joins.broadcast_if_small(dim, 50)._jdf.queryExecution().logical().toString()
    plain = joins.broadcast_if_small(dim, 49)._jdf.queryExecution().logical().toString()
    wide = dim.withColumn("text", F.repeat(F.lit("x"), 1_000))
    heavy = joins.broadcast_if_small(wide, 50, 40_000)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted and "broadcast" not in plain and "broadcast" not in heavy


@pytest.mark.parametrize("strategy", ["auto", "hash", "merge"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, sides, strategy, how):
    fact, dim = sides
    fact = fact.unionByName(spark.createDataFrame([(-1, None), (-2, 999)], "row bigint, k int"))
    plain = fact.join(dim, "k", how).select("row", "k", "zone")
    salted = joins.salted_join(fact, dim, "k", ["row"], strategy, how, partitions=6).select("row", "k", "zone")
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, salted.collect()))


def test_salting_spreads_the_hot_key(spark):
    """With a 90 % key the largest join partition shrinks to about a salt's share."""
    fixed = variant_session(spark, {**SQL_PROFILES["teaching"], "spark.sql.autoBroadcastJoinThreshold": "-1"})
    fact = fixed.range(20_000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 10 != 0, 1).otherwise(F.col("id") % 97).alias("k")
    )
    dim = fixed.range(97).select(F.col("id").alias("k"), F.lit("x").alias("zone"))
    plain = joins.join_dimension(fact, dim, "k", "merge")
    salted = joins.salted_join(fact, dim, "k", ["row"], "merge")
    largest = {
        name: balance.balance(balance.rows_per_partition(df)).first()["max_rows"]
        for name, df in (("plain", plain), ("salted", salted))
    }
    assert largest["plain"] >= 18_000
    assert largest["salted"] <= 6_000


def test_hot_keys_are_bounded_by_their_share(spark):
    df = spark.range(1_000).select((F.col("id") % 100).alias("k"))
    assert shares.hot_keys(df, "k", 0.01).count() == 100
    assert shares.hot_keys(df, "k", 0.011).count() == 0


def test_the_registered_query_splits_the_skewed_partition(spark):
    plan = executed_plan(catalog.join_skew_aqe(spark, "/root/testdata/sf0.01"))
    assert "SortMergeJoin(skew=true)" in plan


def test_nested_bytes_count_before_a_broadcast(spark):
    wide = spark.range(1_000).select("id", F.array_repeat(F.lit(1), 1_000).alias("a"), F.struct(F.lit("xy").alias("t")).alias("s"))
    assert wide.agg(F.sum(joins.held_bytes(wide))).first()[0] == 1_000 * (8 + 8 + 8_000 + 8 + 8 + 2)
    plan = joins.broadcast_if_small(wide, 2_000, 1_000_000)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan


def test_orphans_stay_and_hot_suppliers_are_salted(spark, out, monkeypatch):
    """A supplier with a third of all lines, lines without a partner, adaptive execution off."""
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lines = lines.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_suppkey")).cast("bigint"))
    orphans = lines.limit(7).withColumns({"l_orderkey": F.lit(-1).cast("bigint"), "l_suppkey": F.lit(-1).cast("bigint")})
    lines.unionByName(orphans).write.parquet(f"{out}/lineitem.parquet")
    for name in ("orders", "customer", "supplier", "nation", "region"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    wanted = lines.count() + 7
    assert catalog.curate_wide(spark, out).count() == wanted
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (3, 64 << 20))
    fixed = variant_session(spark, {**SQL_PROFILES["teaching"], "spark.sql.autoBroadcastJoinThreshold": "-1"})
    df = catalog.curate_wide(fixed, out)
    assert "__salt" in planned(df) and df.count() == wanted


def test_curate_neither_shuffles_nor_sorts(spark):
    raw = spark.read.schema(trips.schemas.TRIP_SCHEMA).parquet(f"{SF}/region.parquet")
    zones = trips.zones(spark, SF)
    plan = planned(curate.curate(raw, zones))
    assert plan.count("BroadcastHashJoin") >= 2
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert len(curate.curate(raw, zones).columns) == 38


def test_key_share_joins_sums_not_rows(spark):
    plan = planned(catalog.key_share(spark, SF))
    line = plan[plan.index("l_suppkey") :]
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double>" in line
    scan_to_join = plan[plan.rindex("FileScan parquet [l_suppkey") - 600 : plan.rindex("FileScan parquet [l_suppkey")]
    assert "partial_sum" in scan_to_join or "partial_count" in scan_to_join


def test_shares_sum_to_one_and_leave_out_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    rows = shares.by_share(shares.key_shares(df, "k"), "k").collect()
    assert [(r["k"], r["n"]) for r in rows] == [("a", 2), ("b", 1)]
    assert sum(r["share"] for r in rows) == pytest.approx(1.0)


def test_group_total_of_the_known_shuffle(spark):
    assert shares.group_total(spark.range(200_000).select((F.col("id") % 97).alias("k")), "k").first()[0] == 97
    assert shares.group_total(spark.range(1_000).select((F.col("id") % 7).alias("k")), "k").first()[0] == 7
