"""Key counts, key shares and the dominant key."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_counts(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per key; Spark counts within each partition before it shuffles."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def group_total(df: DataFrame, key: str, name: str = "groups") -> DataFrame:
    """Number of distinct keys, a missing key counted as one."""
    return key_counts(df, key).agg(F.count(F.lit(1)).alias(name))


def row_total_of(df: DataFrame) -> Column:
    """The row count as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def with_share(counts: DataFrame, count_column: str = "n", total: Column | None = None) -> DataFrame:
    """Add each group's share of all rows.

    The total is a scalar subquery, not a window over everything: a window
    without partition would put all groups into one task.
    """
    if total is None:
        total = counts.agg(F.sum(count_column).alias("total")).scalar()
    return counts.withColumn("share", F.col(count_column) / total)


def key_shares(df: DataFrame, key: str) -> DataFrame:
    """``key, n, share``; nulls are left out as a frequency table does."""
    kept = df.where(F.col(key).isNotNull()).select(key)
    return with_share(key_counts(kept, key), total=row_total_of(kept))


def by_share(shares: DataFrame, key: str) -> DataFrame:
    return shares.orderBy(F.col("share").desc(), F.col(key).asc())


def dominant_key(df: DataFrame, key: str, floor: float = 0.5) -> DataFrame:
    """The most frequent key, its share, and whether it passes the floor."""
    return (
        by_share(key_shares(df, key), key)
        .limit(1)
        .withColumn("dominates", F.col("share") >= F.lit(floor))
    )


# A sketch that tracks t keys misses a count by at most 3.5 * 0.75 / t of the rows: with
# this many per key that can be hot, by less than a tenth of the least share.
TRACKED_PER_KEY = 32
TRACKED_MOST = 1_000_000  # more than this the sketch does not take
SKETCHED = (T.IntegralType, T.StringType, T.DecimalType, T.DateType, T.BooleanType)


def hot_keys(df: DataFrame, key: str, min_share: float) -> DataFrame:
    """``key, n, share`` of keys holding at least ``min_share`` of the rows: at most ``1/min_share`` keys.

    With very many keys a grouping would shuffle nearly every one of them. Here each
    task keeps a sketch of bounded size, the sketches are merged, and the few keys
    that may be hot are counted exactly by a second scan of the key. No hot key is
    missed: it is counted to within a tenth of the least share, and there is room for all
    keys that may come out above it. Least shares too small for a sketch, and types it
    does not take, go through the grouping.
    """
    tracked = math.ceil(TRACKED_PER_KEY / min_share)
    if tracked > TRACKED_MOST or not isinstance(df.schema[key].dataType, SKETCHED):
        return key_shares(df, key).where(F.col("share") >= F.lit(min_share))
    kept = df.where(F.col(f"`{key}`").isNotNull()).select(key)
    room = math.ceil(1.25 / min_share) + 1
    sketch = kept.agg(F.expr(f"approx_top_k(`{key}`, {room}, {tracked})").alias("top"))
    candidates = sketch.select(F.explode("top.item").alias("__hot"))
    counted = key_counts(kept.join(F.broadcast(candidates), F.col(f"`{key}`") == F.col("__hot")).select(key), key)
    return with_share(counted, total=row_total_of(kept)).where(F.col("share") >= F.lit(min_share))


def rolled_up_through(
    fact: DataFrame,
    fact_key: str,
    measures: dict[str, Column],
    links: list[Callable[[DataFrame], tuple[DataFrame, list[str]]]],
) -> DataFrame:
    """Aggregate by a far attribute without joining the raw fact.

    Sums are taken per fact key first, so each join meets one row per key and
    a hot key has already collapsed inside the scan's own tasks. Every link
    joins the sums to the next table and names the columns to sum by again.
    """
    sums = fact.groupBy(fact_key).agg(*[expr.alias(name) for name, expr in measures.items()])
    for link in links:
        joined, keys = link(sums)
        sums = joined.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])
    return sums


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
