"""Stage tables: task count, median, maximum, skew ratio, shuffle and spill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregate.functions.rounding import half_even
from faregate.operators.ranks import median_by

STRAGGLER_RATIO = 3.0  # fixed value: a stage is flagged from this ratio on


def skew_ratio(largest: Column, middle: Column) -> Column:
    return F.when(middle > 0, half_even(largest / middle, 1))


def stage_stats(
    tasks: DataFrame, stage: str, seconds: str, sums: Sequence[str] = ()
) -> DataFrame:
    """One row per stage that has at least one timed task.

    ``sums`` are added up over all tasks, timed or not. Times are summed in
    whole milliseconds, so the total does not depend on task order; the median
    is exact and no stage's task list is gathered in one place.
    """
    t = F.col(seconds)
    totals = tasks.groupBy(stage).agg(
        F.count(t).alias("tasks"),
        F.max(t).alias("__max"),
        F.sum(F.rint(t * 1000).cast("bigint")).alias("__ms"),
        *[F.sum(F.coalesce(F.col(name), F.lit(0))).alias(name) for name in sums],
    )
    medians = median_by(tasks, seconds, by=[stage]).select(
        F.col(stage).alias("__stage"), F.col("median").alias("__median")
    )
    both = totals.join(medians, F.col(stage).eqNullSafe(F.col("__stage")))
    ratio = skew_ratio(F.col("__max"), F.col("__median"))
    return both.where(F.col("tasks") > 0).select(
        stage,
        "tasks",
        half_even(F.col("__median")).alias("median_s"),
        half_even(F.col("__max")).alias("max_s"),
        half_even(F.col("__ms") / 1000, 1).alias("total_s"),
        ratio.alias("skew_ratio"),
        F.coalesce(ratio >= F.lit(STRAGGLER_RATIO), F.lit(False)).alias("straggler"),
        *sums,
    )


def report_totals(report: DataFrame) -> DataFrame:
    """Totals and maxima over a stage table, one row."""
    return report.agg(
        F.count(F.lit(1)).alias("stages"),
        F.coalesce(F.sum("tasks"), F.lit(0)).alias("tasks"),
        F.max("max_s").alias("longest_s"),
        F.coalesce(F.max("skew_ratio"), F.lit(0.0)).alias("max_skew"),
        F.count_if("straggler").alias("stragglers"),
    )


def run_summary(report: DataFrame, variant: str, wall_seconds: float) -> DataFrame:
    """One row for a run: stages, largest skew ratio, shuffle megabytes."""
    return report.agg(
        F.lit(variant).alias("variant"),
        half_even(F.lit(float(wall_seconds))).alias("wall_s"),
        F.count(F.lit(1)).alias("stages"),
        F.coalesce(F.max("skew_ratio"), F.lit(0.0)).alias("max_skew"),
        half_even(F.coalesce(F.sum("shuffle_write"), F.lit(0)) / (1024.0 * 1024.0), 1).alias(
            "shuffle_write_mb"
        ),
    )

