"""Quality gates: counts, split with reasons, reconciliation with the manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregate.functions.calendar import parsed_date
from faregate.operators import defects
from faregate.operators.defects import DirtyColumns
from faregate.operators.shares import row_total_of

# Dates of the period start like this, and fares stay below this.
PERIOD_PATTERN = "^202[4-6]-"
PERIOD_FIRST, PERIOD_LAST = "2024-01-01", "2026-12-31"
FARE_CEILING = 10_000

# The measured metric that belongs to each injected one.
MEASURED_FOR = {
    "null_PULocationID": "null_PULocationID",
    "negative_fare": "fare_lt_0",
    "absurd_fare": "fare_gt_10000",
    "zero_passengers": "passenger_count_eq_0",
    "out_of_range_date": "date_out_of_range",
    "negative_duration": "duration_lt_0",
    "malformed_date_string": "date_unparseable",
    "duplicate_rows": "exact_duplicates",
}


def row_gates(columns: DirtyColumns) -> dict[str, Column]:
    """Named predicates, each true for a row it rejects and never null."""
    date = F.col(columns.date)
    parsed = parsed_date(date)
    outside = (parsed < F.lit(PERIOD_FIRST).cast("date")) | (
        parsed > F.lit(PERIOD_LAST).cast("date")
    )

    def sure(predicate: Column) -> Column:
        return F.coalesce(predicate, F.lit(False))

    return {
        "null_PULocationID": F.col(columns.location).isNull(),
        "fare_lt_0": sure(F.col(columns.fare) < 0),
        "fare_gt_10000": sure(F.col(columns.fare) > FARE_CEILING),
        "passenger_count_eq_0": sure(F.col(columns.passengers) == 0),
        "duration_lt_0": sure(F.col(columns.duration) < 0),
        "date_unparseable": date.isNotNull() & parsed.isNull(),
        "date_out_of_range": sure(outside),
    }


def end_before_start(start: str, end: str) -> Column:
    """A second duration gate on the timestamps; injected rows keep theirs."""
    return F.coalesce(F.col(end) < F.col(start), F.lit(False))


def not_in_period(date: Column) -> Column:
    """True where the date text does not start as the period's dates do; null counts."""
    return ~F.coalesce(date.rlike(PERIOD_PATTERN), F.lit(False))


def _counted(columns: DirtyColumns) -> dict[str, Column]:
    """The predicates of the row-level counts."""
    gates = row_gates(columns)
    names = ("null_PULocationID", "fare_lt_0", "fare_gt_10000", "passenger_count_eq_0", "duration_lt_0")
    counted = {name: gates[name] for name in names}
    counted["unparseable_or_out_of_range_date"] = not_in_period(F.col(columns.date))
    return counted


def gate_counts(df: DataFrame, columns: DirtyColumns) -> DataFrame:
    """All row-level defect counts of a table in one pass, one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(predicate).alias(name) for name, predicate in _counted(columns).items()],
    )


def split_by_gates(df: DataFrame, columns: DirtyColumns) -> DataFrame:
    """Every row with its list of reasons and whether it is clean; no shuffle."""
    reasons = F.array_compact(
        F.array(*[F.when(hit, F.lit(name)) for name, hit in row_gates(columns).items()])
    )
    return df.withColumn("reasons", reasons).withColumn("is_clean", F.size("reasons") == 0)


def clean_rows(df: DataFrame, columns: DirtyColumns) -> DataFrame:
    return split_by_gates(df, columns).where("is_clean").drop("reasons", "is_clean")


def rejected_rows(df: DataFrame, columns: DirtyColumns) -> DataFrame:
    return split_by_gates(df, columns).where(~F.col("is_clean")).drop("is_clean")


def drift_profile(df: DataFrame, column: str, period: str) -> DataFrame:
    """Null rate of a drifting column by period."""
    return (
        df.groupBy(period)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull()).alias("nulls"))
        .withColumn("null_rate", F.col("nulls") / F.col("n"))
    )


def _measure(clean: DataFrame, dirty: DataFrame, columns: DirtyColumns) -> DataFrame:
    """Everything the tables below need, as one row from one grouping of the dirty rows.

    ``once.*`` counts a row and its copies as one, ``all.*`` counts every copy;
    ``n`` is the number of clean rows.
    """
    gates = row_gates(columns)
    any_hit = F.lit(False)
    for predicate in gates.values():
        any_hit = any_hit | predicate
    single = dirty.groupBy(*dirty.columns).agg(F.count(F.lit(1)).alias("__copies"))
    copies = F.col("__copies")

    def every(hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, copies)), F.lit(0))

    once = [F.count_if(hit).alias(name) for name, hit in gates.items()]
    every_copy = [every(hit).alias(name) for name, hit in _counted(columns).items()]
    total = F.coalesce(F.sum(copies), F.lit(0))
    return single.agg(
        F.struct(*once, F.count_if(~any_hit).alias("clean_rows")).alias("once"),
        F.struct(total.alias("total_rows"), *every_copy).alias("all"),
        (total - F.count(F.lit(1))).alias("exact_duplicates"),
    ).withColumn("n", row_total_of(clean))


def _injected() -> dict[str, Column]:
    return {name: F.floor(F.col("n") * rate).cast("bigint") for name, rate in defects.DEFECT_RATES.items()}


def _expected_clean() -> Column:
    expected = F.col("n")
    for name, count in _injected().items():
        if name != "duplicate_rows":
            expected = expected - count
    return expected


def reconcile(clean: DataFrame, dirty: DataFrame, columns: DirtyColumns) -> DataFrame:
    """Injected against measured counts: ``metric, injected, measured, difference, verdict``.

    Measured on the dirty table after exact copies are dropped, since a copy
    repeats its row's defects; the duplicates themselves are measured as
    copies. Classes that overwrite each other show as ``fewer``. Two more
    rows give the clean rows: the estimate from the counts, and the exact
    number that pass every gate.
    """
    measured = {
        name: F.col("exact_duplicates") if name == "duplicate_rows" else F.col("once")[MEASURED_FOR[name]]
        for name in defects.DEFECT_RATES
    }
    injected = _injected()
    pairs = {name: (injected[name], measured[name]) for name in injected}
    pairs["clean_rows"] = (_expected_clean(), F.col("once")["clean_rows"])
    pairs["total_rows"] = (F.col("n") + injected["duplicate_rows"], F.col("all")["total_rows"])
    rows = [
        F.struct(F.lit(name).alias("metric"), a.alias("injected"), b.alias("measured")) for name, (a, b) in pairs.items()
    ]
    difference = F.col("measured") - F.col("injected")
    return (
        _measure(clean, dirty, columns)
        .select(F.explode(F.array(*rows)).alias("e"))
        .select("e.*")
        .withColumns(
            {
                "difference": difference,
                "verdict": F.when(difference == 0, "equal").when(difference < 0, "fewer").otherwise("more"),
            }
        )
    )


def manifest(clean: DataFrame, dirty: DataFrame, columns: DirtyColumns) -> DataFrame:
    """``metric, value, detail`` rows: what was injected and what was measured."""
    none = F.lit(None).cast("string")
    share = int(defects.DRIFT_FROM * 100)
    exact = F.concat(
        F.lit("a lower bound, classes overlap; exact "), F.col("once")["clean_rows"].cast("string")
    )
    values = [(f"injected.{name}", count, none) for name, count in _injected().items()]
    values += [
        (f"measured.{name}", F.col("all")[name], none) for name in ("total_rows", *_counted(columns))
    ]
    values += [
        ("measured.exact_duplicates", F.col("exact_duplicates"), none),
        (
            "injected.schema_drift_column",
            F.lit(None).cast("bigint"),
            F.lit(f"{defects.DRIFT_COLUMN} is null for the first {share}% of rows"),
        ),
        ("clean_rows_expected", _expected_clean(), exact),
    ]
    rows = [
        F.struct(F.lit(name).alias("metric"), value.cast("bigint").alias("value"), detail.alias("detail"))
        for name, value, detail in values
    ]
    return _measure(clean, dirty, columns).select(F.explode(F.array(*rows)).alias("e")).select("e.*")
