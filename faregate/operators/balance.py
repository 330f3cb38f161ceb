"""Rows per partition: a stage is as long as its slowest partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregate.functions.rounding import half_even


def rows_per_partition(df: DataFrame) -> DataFrame:
    """``partition, n`` for the partitions the rows are in now."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n")
    )


def balance(counts: DataFrame, by: Sequence[str] = (), count_column: str = "n") -> DataFrame:
    """Partitions, total, median and maximum of the counts, and their skew ratio.

    The input has one row per partition, so a plain median is bounded by the
    number of partitions.
    """
    n = F.col(count_column)
    med = F.col("median_rows")
    return (
        counts.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("partitions"),
            F.sum(n).alias("total_rows"),
            F.median(n).alias("median_rows"),
            F.max(n).alias("max_rows"),
        )
        .withColumn("skew_ratio", F.when(med > 0, half_even(F.col("max_rows") / med, 1)))
    )
