from __future__ import annotations

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from faregate.operators import balance, defects, duplicates, fingerprint, gates, histogram, normalise, stages
from faregate.operators.defects import DirtyColumns
from faregate.plans import trips
from faregate.plans.trips import TRIP_EVENTS
from faregate.schemas import TRIP_SCHEMA
from tests.conftest import SF


@pytest.fixture(scope="module")
def clean(spark):
    return trips.trip_events(spark, SF)


@pytest.fixture(scope="module")
def dirty(spark, clean, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dirty") / "t")
    defects.inject_defects(clean, TRIP_EVENTS).write.parquet(path)
    return spark.read.parquet(path)


def test_exact_counts_of_every_class(clean, dirty):
    n = clean.count()
    counts = gates.gate_counts(dirty.dropDuplicates(), TRIP_EVENTS).first()
    assert counts["total_rows"] == n
    assert counts["null_PULocationID"] == int(n * 0.012)
    assert counts["passenger_count_eq_0"] == int(n * 0.03)
    assert counts["fare_gt_10000"] == int(n * 0.001)
    assert counts["duration_lt_0"] <= int(n * 0.0015)
    assert dirty.count() == n + int(n * 0.02)
    assert duplicates.duplicate_count(dirty).first()["duplicates"] == int(n * 0.02)


def test_only_the_defects_change(clean, dirty):
    same = dirty.drop(defects.DRIFT_COLUMN).dropDuplicates()
    touched = same.exceptAll(clean).count()
    n = clean.count()
    assert 0 < touched <= sum(int(n * r) for r in defects.DEFECT_RATES.values())


def test_drift_column_starts_at_seventy_percent(clean, dirty):
    n = clean.count()
    late = dirty.dropDuplicates().where(F.col(defects.DRIFT_COLUMN).isNotNull())
    assert late.count() == n - int(n * 0.7)
    assert late.agg(F.min("trip_id")).first()[0] == int(n * 0.7)


def test_split_keeps_every_row(dirty):
    good, bad = gates.clean_rows(dirty, TRIP_EVENTS), gates.rejected_rows(dirty, TRIP_EVENTS)
    assert good.count() + bad.count() == dirty.count()
    assert good.columns == dirty.columns
    assert bad.where(F.size("reasons") == 0).count() == 0


def test_gates_on_edge_values(spark):
    rows = [
        (1, 5, 1.0, 1.0, "2024-01-05", 10.0),
        (2, None, -0.5, 0.0, "31/02/2024", -1.0),
        (3, 5, 10_000.0, None, "2098-06-15", None),
        (4, 5, 10_000.01, 2.0, None, 0.0),
        (5, 5, None, 1.0, "2002-01-01", 1.0),
    ]
    df = spark.createDataFrame(
        rows, "k int, PULocationID int, fare_amount double, passenger_count double, pickup_date string, trip_duration_sec double"
    )
    split = {r["k"]: r["reasons"] for r in gates.split_by_gates(df, DirtyColumns(key="k")).collect()}
    assert split == {
        1: [],
        2: ["null_PULocationID", "fare_lt_0", "passenger_count_eq_0", "duration_lt_0", "date_unparseable"],
        3: ["date_out_of_range"],
        4: ["fare_gt_10000"],
        5: ["date_out_of_range"],
    }
    assert gates.gate_counts(df, DirtyColumns(key="k")).first()["unparseable_or_out_of_range_date"] == 4


def test_timestamp_gate_does_not_see_injected_durations(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)), (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)), (None, dt.datetime(2024, 1, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in df.select(gates.end_before_start("a", "b")).collect()] == [False, True, False]


def test_reconcile_shows_overlap_as_fewer(clean, dirty):
    rows = {r["metric"]: r for r in gates.reconcile(clean, dirty, TRIP_EVENTS).collect()}
    assert rows["null_PULocationID"]["verdict"] == "equal"
    assert rows["duplicate_rows"]["verdict"] == "equal"
    assert rows["total_rows"]["verdict"] == "equal"
    assert rows["clean_rows"]["measured"] >= rows["clean_rows"]["injected"]


def test_duplicates_treat_missing_and_nan_as_equal(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, None, "a")] * 3 + [(1.0, None, "a"), (nan, "", "a")], "x double, s string, t string")
    row = duplicates.duplicate_count(df).first()
    assert (row["rows"], row["distinct_rows"], row["duplicates"]) == (5, 3, 2)
    assert duplicates.drop_duplicates(df).count() == 3


def test_long_texts_do_not_travel_through_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = duplicates.duplicate_count(df, ["text"])._jdf.queryExecution().executedPlan().toString()
    assert "sha2" in plan[plan.index("Exchange hashpartitioning") :]


def test_fingerprint_sees_what_an_exclusive_or_misses(spark):
    df = spark.range(10)
    twice = df.unionByName(df).unionByName(df)
    a, b = fingerprint.fingerprint(df).first(), fingerprint.fingerprint(twice).first()
    assert a["content"] != b["content"]
    shuffled = df.orderBy(F.rand(3)).repartition(5)
    assert fingerprint.fingerprint(shuffled).first() == a
    assert len(fingerprint.short_fingerprint(df).first()[0]) == 16


def test_fingerprint_sees_moved_nulls_and_swapped_columns(spark):
    def content(rows, schema="a string, b string"):
        return fingerprint.fingerprint(spark.createDataFrame(rows, schema)).first()["content"]

    base = content([(None, "a"), ("x", "y")])
    assert base == content([("x", "y"), (None, "a")])
    others = [
        content([("a", None), ("x", "y")]),
        content([(None, "a"), ("y", "x")]),
        content([(None, "a"), ("x", "y")], "b string, a string"),
        content([(None, "a"), (None, "a"), ("x", "y")]),
        content([("", "a"), ("x", "y")]),
    ]
    assert len({base, *others}) == 6


def test_histogram_leaves_out_nan(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert [r["n"] for r in histogram.histogram(rows, "x", 3).orderBy("bin").collect()] == [1, 0, 1]


@pytest.mark.parametrize("buckets", [1, 10])
def test_histogram_equals_the_edge_definition(spark, buckets):
    values = [0.1 * i for i in range(101)] + [3.3] * 7
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = histogram.histogram(df, "x", buckets).orderBy("bin").collect()
    lo, hi = min(values), max(values)
    width = (hi - lo) / buckets or 1
    for i, r in enumerate(got):
        a, b = lo + i * width, lo + (i + 1) * width
        assert r["n"] == sum(1 for v in values if a <= v < b or (i == buckets - 1 and v == hi))
    assert sum(r["n"] for r in got) == len(values)


def test_histogram_of_equal_values_and_of_nothing(spark):
    same = histogram.histogram(spark.createDataFrame([(5.0,)] * 4, "x double"), "x").orderBy("bin").collect()
    assert [(r["from_value"], r["n"]) for r in same][:2] == [(5.0, 4), (6.0, 0)]
    assert len(same) == 10
    assert histogram.histogram(spark.createDataFrame([], "x double"), "x").count() == 0


def test_stage_stats_with_a_straggler_and_a_zero_median(spark):
    rows = [("s", t) for t in [1.0, 1.0, 1.0, 20.4]] + [("z", 0.0)] * 3 + [("none", None)]
    df = spark.createDataFrame(rows, "stage string, seconds double")
    got = {r["stage"]: r for r in stages.stage_stats(df, "stage", "seconds").collect()}
    assert set(got) == {"s", "z"}
    assert got["s"]["skew_ratio"] == 20.4 and got["s"]["straggler"]
    assert got["s"]["total_s"] == 23.4 and got["s"]["median_s"] == statistics.median([1.0, 1.0, 1.0, 20.4])
    assert got["z"]["skew_ratio"] is None and not got["z"]["straggler"]


def test_partition_balance(spark):
    df = spark.range(0, 100, 1, 4)
    row = balance.balance(balance.rows_per_partition(df)).first()
    assert (row["partitions"], row["total_rows"], row["max_rows"], row["skew_ratio"]) == (4, 100, 25, 1.0)


def test_normalise_renames_fills_and_drops(spark):
    raw = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1), 3, 4, 1.5, 10.0, 1.25, 0.75)],
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID bigint, DOLocationID int, "
        "trip_distance double, fare_amount double, Airport_fee double, cbd_congestion_fee double",
    )
    df = normalise.normalise(raw)
    assert df.schema.fieldNames() == TRIP_SCHEMA.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in TRIP_SCHEMA]
    row = df.first()
    assert (row["airport_fee"], row["VendorID"], row["store_and_fwd_flag"], row["passenger_count"]) == (1.25, 1, "N", 1.0)


def test_normalise_rejects_what_it_cannot_repair(spark):
    with pytest.raises(normalise.ShapeError, match="required"):
        normalise.normalise(spark.createDataFrame([(1,)], "VendorID int"))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        twins = spark.createDataFrame([(1, 2)], "a int, A int")
        with pytest.raises(normalise.ShapeError, match="case"):
            normalise.canonical_names(twins, TRIP_SCHEMA)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_lookup_shape_gate(spark):
    good = spark.range(101).select(F.col("id").alias("LocationID"), F.lit("x").alias("Borough"))
    assert normalise.check_dimension(good) is good
    with pytest.raises(normalise.ShapeError):
        normalise.check_dimension(good.limit(100))
    with pytest.raises(normalise.ShapeError):
        normalise.check_dimension(good.drop("Borough"))
