"""Where a column appeared, vanished or changed its share of missing values, found from the rows.

One pass counts rows and missing values per day for all columns; what follows works on
that table of days. Within a stretch of days every cut is scored by Pearson's
statistic of the two by two table (missing or not, before or after), from running sums;
the best cut of a stretch counts if its statistic reaches ``least_score`` and the two
shares differ by ``least_change``. Both sides of a cut are then stretches of their own,
until no stretch has a cut that counts.

Rows without a day belong to no stretch. Of equal scores the earliest day wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faregate.operators.layout import written

LEAST_SCORE = 20.0  # chance alone reaches it once in some 130,000 cuts
LEAST_CHANGE = 0.1


def missing_per_day(df: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """``column, day, n, missing``: one row per day and column."""
    counts = df.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(columns)]
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(columns)])
    return counts.select("day", "n", F.explode(pairs).alias("pair")).select("pair.column", "day", "n", "pair.missing")


def scored_cuts(days: DataFrame) -> DataFrame:
    """Every cut before a day within a stretch (``column, stretch``): both sides' counts and the score."""
    ahead = Window.partitionBy("column", "stretch").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("column", "stretch")
    sums = days.select(
        "column",
        "stretch",
        "day",
        F.sum("n").over(ahead).alias("n1"),
        F.sum("missing").over(ahead).alias("m1"),
        F.sum("n").over(whole).alias("n"),
        F.sum("missing").over(whole).alias("m"),
    ).where("n1 IS NOT NULL")
    number = {c: F.col(c).cast("double") for c in ("n1", "m1", "n", "m")}
    n1, m1, n, m = (number[c] for c in ("n1", "m1", "n", "m"))
    across = m1 * (n - n1) - (m - m1) * n1
    spread = n1 * (n - n1) * (m * (n - m))
    return sums.select(
        "column",
        "stretch",
        "day",
        (m1 / n1).alias("share_before"),
        ((m - m1) / (n - n1)).alias("share_after"),
        F.when(spread > 0, across / spread * across * n).otherwise(0.0).alias("score"),
    )


def best_cuts(days: DataFrame, least_score: float = LEAST_SCORE, least_change: float = LEAST_CHANGE) -> DataFrame:
    """The best cut of each stretch, where it counts."""
    rank = F.struct(F.col("score"), -F.datediff(F.col("day").cast("date"), F.lit("1970-01-01").cast("date")))
    best = scored_cuts(days).groupBy("column", "stretch").agg(
        F.max_by(F.struct("day", "share_before", "share_after", "score"), rank).alias("cut")
    )
    change = F.abs(F.col("share_after") - F.col("share_before"))
    return best.select("column", "stretch", "cut.*").where((F.col("score") >= least_score) & (change >= least_change))


def change_points(
    df: DataFrame,
    day: str,
    columns: Sequence[str],
    least_score: float = LEAST_SCORE,
    least_change: float = LEAST_CHANGE,
) -> DataFrame:
    """``column, day, share_before, share_after, kind``: the first day of each new stretch; ``day`` sorts as a date.

    The shares are those of the stretches on either side once all cuts are found.
    ``kind``: ``appeared`` (always missing before), ``vanished`` (always missing after)
    or ``drifted``.
    """
    days = written(missing_per_day(df, day, columns).withColumn("stretch", F.lit(0).cast("bigint")))
    while True:
        cuts = written(best_cuts(days, least_score, least_change).select("column", "stretch", F.col("day").alias("cut")))
        if cuts.isEmpty():
            break
        later = F.col("cut").isNotNull() & (F.col("day") >= F.col("cut"))
        days = written(
            days.join(cuts, ["column", "stretch"], "left")
            .withColumn("stretch", F.col("stretch") * 2 + later.cast("bigint"))
            .drop("cut")
        )
    in_order = Window.partitionBy("column").orderBy("day")
    stretches = days.groupBy("column", "stretch").agg(
        F.min("day").alias("day"), (F.sum("missing") / F.sum("n")).alias("share_after")
    )
    before = stretches.withColumn("share_before", F.lag("share_after").over(in_order)).where("share_before IS NOT NULL")
    kind = F.when(F.col("share_before") == 1, "appeared").when(F.col("share_after") == 1, "vanished").otherwise("drifted")
    return before.select("column", "day", "share_before", "share_after", kind.alias("kind"))
