from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from faregate.operators import replicate, sampling


def smallest(keys, salt, size):
    return set(sorted(keys, key=lambda k: hashlib.md5(f"{k}:{salt}".encode()).hexdigest())[:size])


@pytest.mark.parametrize("size", [0, 1, 17, 500, 999, 1_000, 5_000])
def test_exact_sample_is_the_smallest_draws(spark, size):
    got = sampling.sample_exact(spark.range(1_000), "id", "s", size).collect()
    assert {r[0] for r in got} == smallest(range(1_000), "s", size)


def test_sample_does_not_depend_on_partitions(spark):
    a = sampling.sample_exact(spark.range(0, 3_000, 1, 1), "id", "s", 100)
    b = sampling.sample_exact(spark.range(3_000).repartition(7), "id", "s", 100)
    assert a.exceptAll(b).count() == 0 and a.count() == 100


def test_several_picks_in_one_pass(spark):
    picks = {
        "a": sampling.Pick("x", sampling.share_of_rows(0.012)),
        "b": sampling.Pick("y", sampling.share_of_rows(0.5)),
        "none": sampling.Pick("z", sampling.share_of_rows(0.0)),
    }
    row = (
        sampling.with_picks(spark.range(1_234), "id", picks)
        .agg(*[F.count_if(F.col(name)).alias(name) for name in picks])
        .first()
    )
    assert row.asDict() == {"a": int(1_234 * 0.012), "b": 617, "none": 0}


def test_empty_input(spark):
    picks = {"a": sampling.Pick("x", sampling.share_of_rows(0.5))}
    assert sampling.with_picks(spark.range(0), "id", picks).count() == 0


def test_a_key_that_is_not_unique_is_an_error(spark):
    df = spark.range(1_000).select((F.col("id") * 0).alias("k"))
    with pytest.raises(Exception, match="not unique"):
        sampling.sample_exact(df, "k", "s", 10).collect()


def test_fallback_lookup(spark):
    rows = sampling.fallback_zones(spark).collect()
    assert sorted(r["LocationID"] for r in rows) == list(range(1, 266))
    assert Counter(r["Borough"] for r in rows) == sampling.FALLBACK_BOROUGHS
    assert {r["Zone"] for r in rows} >= {"Zone 001", "Zone 265"}
    assert {r["service_zone"] for r in rows} <= set(sampling.FALLBACK_SERVICE_ZONES)


def test_absent_boroughs_give_their_weight_to_the_rest(spark):
    df = spark.range(5_000).select(sampling.skewed_borough(F.col("id"), present=["Queens", "Bronx"]).alias("b"))
    assert {r[0] for r in df.distinct().collect()} == {"Queens", "Bronx"}


@pytest.mark.parametrize("target", [0, 3, 10, 25, 40])
@pytest.mark.parametrize("spread", [False, True])
def test_replicate_reaches_the_target_exactly(spark, target, spread):
    df = spark.createDataFrame([(i * 7,) for i in range(10)], "k bigint")
    got = Counter(r["k"] for r in replicate.replicate_rows(df, "k", target, spread=spread).collect())
    wanted = Counter((i % 10) * 7 for i in range(target))
    assert got == wanted


def test_many_copies_of_one_row_unfold_in_chunks(spark):
    df = spark.createDataFrame([(1, "a")], "k bigint, t string")
    copies = replicate.replicate_rows(df, "k", 12_345, spread=True)
    row = copies.agg(F.count("*"), F.min("copy"), F.max("copy"), F.countDistinct("copy")).first()
    assert tuple(row) == (12_345, 0, 12_344, 12_345)


def test_csv_volume(spark, out):
    from faregate.operators import layout

    df = spark.range(500).select("id", F.format_string("name %05d", "id").alias("t"))
    layout.write_csv(replicate.replicate_to_csv_bytes(df, "id", 100_000).drop("copy"), out)
    size = layout.listing(spark, out).agg(F.sum("length")).first()[0]
    assert 0.97 * 100_000 < size < 1.1 * 100_000


def test_union_of_versions_fills_the_late_column(spark):
    old = spark.createDataFrame([(1,)], "k int")
    new = spark.createDataFrame([(0.75, 2)], "fee double, k int")
    rows = replicate.union_versions(old, new).orderBy("k").collect()
    assert [(r["k"], r["fee"]) for r in rows] == [(1, None), (2, 0.75)]


def test_rows_without_a_key_are_repeated_too(spark):
    df = spark.createDataFrame([(i if i >= 5 else None,) for i in range(20)], "k bigint")
    assert replicate.replicate_rows(df, "k", 50).count() == 50
    with pytest.raises(ValueError, match="have no k"):
        replicate.replicate_rows(df, "k", 58)
