"""Known defects put into a clean table, with their exact counts.

Each class picks its own rows by a portable draw, so classes may overlap and
the later class wins, as in a sequence of assignments. All picks are found in
one pass over the key; the rows themselves are changed in one projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregate.operators.ranks import keys_at_ranks
from faregate.operators.sampling import Pick, share_of_rows, with_picks

# The share of rows each defect class touches.
DEFECT_RATES = {
    "null_PULocationID": 0.012,
    "negative_fare": 0.004,
    "absurd_fare": 0.001,
    "zero_passengers": 0.03,
    "out_of_range_date": 0.002,
    "negative_duration": 0.0015,
    "malformed_date_string": 0.001,
    "duplicate_rows": 0.02,
}

# What the defects write.
ABSURD_FARE = 99_999.99
EARLY_DATE = "2002-01-01"
LATE_DATE = "2098-06-15"
MALFORMED_DATE = "31/02/2024"
DRIFT_COLUMN = "cbd_congestion_fee"
DRIFT_VALUE = 0.75
DRIFT_FROM = 0.7


@dataclass(frozen=True)
class DirtyColumns:
    """Which columns of a table play the parts the defects touch."""

    key: str
    location: str = "PULocationID"
    fare: str = "fare_amount"
    passengers: str = "passenger_count"
    date: str = "pickup_date"
    duration: str = "trip_duration_sec"


def _picks() -> dict[str, Pick]:
    picks = {
        f"__{name}": Pick(f"defects{i // 4}", share_of_rows(rate), i % 4)
        for i, (name, rate) in enumerate(DEFECT_RATES.items())
    }
    dated = picks["__out_of_range_date"]
    # The same draw, half the rows: these are the first half of the misdated ones.
    picks["__early_date"] = Pick(dated.salt, lambda n: dated.size(n) // 2, dated.turn)
    return picks


def inject_defects(clean: DataFrame, columns: DirtyColumns) -> DataFrame:
    """The dirty table: nulls, bad fares, bad dates, a late column, exact copies.

    Copies are taken last, so they carry the defects of the row they copy. A
    negative duration leaves the timestamps as they are, and a bad date changes
    the date text only.
    """
    c = columns
    total = clean.count()
    flagged = with_picks(clean, c.key, _picks(), total)
    (appears,) = keys_at_ranks(
        clean.select(c.key), c.key, [lambda n: F.floor(n * F.lit(DRIFT_FROM))], total
    )
    fare, seconds = F.col(c.fare), F.col(c.duration)
    changed = flagged.withColumns(
        {
            c.location: F.when(~F.col("__null_PULocationID"), F.col(c.location)),
            c.fare: F.when(F.col("__absurd_fare"), F.lit(ABSURD_FARE))
            .when(F.col("__negative_fare"), -F.abs(fare) + F.lit(0.0))
            .otherwise(fare),
            c.passengers: F.when(F.col("__zero_passengers"), F.lit(0.0)).otherwise(
                F.col(c.passengers)
            ),
            c.date: F.when(F.col("__malformed_date_string"), F.lit(MALFORMED_DATE))
            .when(F.col("__early_date"), F.lit(EARLY_DATE))
            .when(F.col("__out_of_range_date"), F.lit(LATE_DATE))
            .otherwise(F.col(c.date)),
            c.duration: F.when(
                F.col("__negative_duration"), -F.abs(seconds) + F.lit(0.0)
            ).otherwise(seconds),
            DRIFT_COLUMN: F.when(F.col(c.key) >= appears, F.lit(DRIFT_VALUE)),
        }
    )
    copies = F.explode(
        F.when(F.col("__duplicate_rows"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    )
    kept = [*clean.columns, *([] if DRIFT_COLUMN in clean.columns else [DRIFT_COLUMN])]
    return changed.withColumn("__copy", copies).select(*kept)


def second_day(day: DataFrame) -> DataFrame:
    """A later delivery: clean rows that all have the late column."""
    return day.withColumn(DRIFT_COLUMN, F.lit(DRIFT_VALUE))
