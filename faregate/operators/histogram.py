"""Fixed-width histogram with every bin present."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, buckets: int = 10) -> DataFrame:
    """``bin, from_value, to_value, n``: bins are ``[from, to)``, the last one closed.

    The width is 1 when all values are equal; an empty input gives no bins.
    Missing values and NaN are left out.
    The rows are counted by bin number in each task; only bin counts travel.
    """
    rows = df.select(F.col(value).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    spread = (F.col("hi") - F.col("lo")) / F.lit(buckets)
    edges = (
        rows.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        .where(F.col("lo").isNotNull())
        .withColumn("width", F.when(spread == 0, F.lit(1.0)).otherwise(spread))
    )
    bounds = edges.select(F.struct("lo", "width").alias("b")).scalar()
    x, lo, width = F.col("x"), F.col("b.lo"), F.col("b.width")
    guess = F.floor((x - lo) / width)
    # Division may land one bin off at an edge; the bin's own edges decide.
    exact = (
        F.when(x < lo + guess * width, guess - 1)
        .when(x >= lo + (guess + 1) * width, guess + 1)
        .otherwise(guess)
    )
    counted = (
        rows.withColumn("b", bounds)
        .select(F.greatest(F.lit(0), F.least(F.lit(buckets - 1), exact)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    bins = edges.select(
        "lo", "width", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bin")
    )
    return bins.join(counted, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("from_value"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("to_value"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )
