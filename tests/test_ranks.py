from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from faregate.operators import ranks


def frame(spark, groups, dtype="double"):
    rows = [(g, v) for g, values in groups.items() for v in values]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, f"g string, v {dtype}").repartition(3)


@pytest.mark.parametrize("rounds", [0, 1, 2, 3])
def test_grouped_median_equals_python(spark, rounds):
    rng = random.Random(7)
    groups = {
        "one": [4.5],
        "two": [1.0, 2.0],
        "ties": [3.0] * 500 + [1.0],
        "hot": [rng.lognormvariate(0, 3) for _ in range(5_000)],
        "odd": [float(rng.randrange(50)) for _ in range(1_001)],
    }
    got = {r["g"]: (r["n"], r["median"]) for r in ranks.median_by(frame(spark, groups), "v", ["g"], rounds).collect()}
    assert got == {g: (len(v), statistics.median(v)) for g, v in groups.items()}


def test_groups_too_many_to_broadcast_are_joined(spark, monkeypatch):
    monkeypatch.setattr(ranks, "BROADCAST_ROWS", 3)
    groups = {f"g{i}": [float(j % 7) for j in range(i * 3 + 1)] for i in range(20)}
    found = ranks.median_by(frame(spark, groups), "v", ["g"], 2)
    got = {r["g"]: r["median"] for r in found.collect()}
    assert got == {g: statistics.median(v) for g, v in groups.items()}


def test_missing_group_key_and_missing_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("b", 2.0), ("b", None)], "g string, v double")
    got = {r["g"]: (r["n"], r["median"]) for r in ranks.median_by(df, "v", ["g"]).collect()}
    assert got == {None: (2, 2.0), "b": (1, 2.0)}


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_large_integers_beyond_double_precision(spark, monkeypatch, rounds):
    monkeypatch.setattr(ranks, "_FORCED_ROUNDS", rounds)
    base = 2**62
    df = spark.createDataFrame([(base + i,) for i in range(301)], "k bigint")
    kept = ranks.first_rows(df, "k", lambda n: n / 3)
    assert sorted(r[0] - base for r in kept.collect()) == list(range(100))


@pytest.mark.parametrize("start,stop", [(0, 10), (5, 5), (990, 2_000), (2_000, 3_000), (250, 750), (0, 1_000)])
@pytest.mark.parametrize("rounds", [0, 2])
def test_slices_by_filter_equal_sorted_slices(spark, monkeypatch, start, stop, rounds):
    monkeypatch.setattr(ranks, "_FORCED_ROUNDS", rounds)
    keys = random.Random(3).sample(range(10**9), 1_000)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    wanted = sorted(keys)[start:stop]
    small = ranks.slice_rows(df, "k", start, stop)
    by_rank = ranks.slice_rows(df, "k", lambda n: F.lit(start), lambda n: F.lit(stop))
    assert sorted(r[0] for r in small.collect()) == wanted
    assert sorted(r[0] for r in by_rank.collect()) == wanted


def test_first_rows_of_nothing_and_of_everything(spark):
    df = spark.range(100)
    assert ranks.first_rows(df, "id", lambda n: F.lit(0)).count() == 0
    assert ranks.first_rows(df, "id", lambda n: n * 5).count() == 100
    assert ranks.first_rows(df.limit(0), "id", lambda n: n / 2).count() == 0


def test_a_large_head_is_a_pushed_filter_not_a_sort(spark, out):
    spark.range(50_000).write.parquet(out)
    df = ranks.first_rows(spark.read.parquet(out), "id", 20_000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(id), LessThanOrEqual(id,19999)]" in plan
    assert df.count() == 20_000


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_keys_in_any_session_zone(spark, monkeypatch, zone):
    monkeypatch.setattr(ranks, "_FORCED_ROUNDS", 1)
    start = dt.datetime(2024, 3, 10, 1, 0, 0, 1)
    times = [start + dt.timedelta(minutes=i) for i in range(200)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
        got = ranks.slice_rows(df, "t", lambda n: n / 4, lambda n: n / 2)
        assert sorted(r[0] for r in got.collect()) == times[50:100]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rounds_grow_with_the_table():
    rows = (10**6, 10**8, 10**11, 10**13)
    assert [ranks._rounds_for(n, ranks.FINE_GRID) for n in rows] == [0, 1, 2, 3]


def test_more_groups_than_the_fine_grid_serves(spark):
    rng = random.Random(5)
    groups = {f"g{i:04d}": [rng.random() for _ in range(rng.randrange(1, 6))] for i in range(1_200)}
    groups["hot"] = [rng.random() for _ in range(4_000)]
    got = {r["g"]: r["median"] for r in ranks.median_by(frame(spark, groups), "v", ["g"], 2).collect()}
    assert got == {g: statistics.median(v) for g, v in groups.items()}


@pytest.mark.parametrize("rounds", [0, 1, 2])
@pytest.mark.parametrize("size", [9_999, 10_000, 10_001])
def test_ties_and_missing_keys_mean_the_same_at_every_size(spark, monkeypatch, rounds, size):
    monkeypatch.setattr(ranks, "_FORCED_ROUNDS", rounds)
    keys = [i % 100 for i in range(20_000)] + [None] * 5
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    last = sorted(k for k in keys if k is not None)[size - 1]
    got = sorted(r[0] for r in ranks.first_rows(df, "k", size).collect())
    assert got == sorted(k for k in keys if k is not None and k <= last)


@pytest.mark.parametrize("rows", [10, 10_001])
def test_text_keys_are_refused_at_every_size(spark, rows):
    df = spark.createDataFrame([("a",)], "k string")
    for call in (lambda: ranks.first_rows(df, "k", rows), lambda: ranks.slice_rows(df, "k", 0, rows)):
        with pytest.raises(TypeError, match="numbers or times"):
            call()


def test_a_missed_bracket_is_searched_again(spark, monkeypatch):
    monkeypatch.setattr(ranks, "_FORCED_ROUNDS", 1)
    calls, real = [], ranks._bracket

    def unlucky(mine, first, last, dtype):
        calls.append(1)
        if len(calls) == 1:  # far beside the wanted rank
            return F.struct(F.max(F.col("high")).cast(dtype).alias("lo"), F.max(F.col("high")).cast(dtype).alias("hi"))
        return real(mine, first, last, dtype)

    monkeypatch.setattr(ranks, "_bracket", unlucky)
    assert ranks.first_rows(spark.range(1_000), "id", 100).count() == 100 and len(calls) == 2
