"""Rows laid out by two columns at once, and reading only the row groups a join needs.

A row's place is the interleaved bits of its two values' ranks, so that rows near in
both columns share a file and a row group's bounds are narrow in both. Ranks are taken
from quantiles, so a skewed column still uses all of its bits; inside a quantile they are
linear.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate.sources import footers

QUANTILES, INNER_BITS = 64, 10  # 16 bits of rank for each column
PLACE = "__place"


def as_number(column: Column, kind: T.DataType) -> Column:
    """A value on the scale that footers give bounds in."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        start = F.lit("1970-01-01").cast(kind)
        return F.timestamp_diff("MICROSECOND", start, column).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    return column.cast("double")


def _rank(value: Column, at: Column, bounds: Column) -> Column:
    """16 bits: the quantile a value lies in, its lower bound at place ``at``, then its share of that quantile."""
    steps = 1 << INNER_BITS
    low, high = F.get(bounds, at), F.get(bounds, at + 1)
    inner = F.floor((value - low) * steps / (high - low))  # null from the last bound on
    inside = F.least(F.greatest(F.coalesce(inner, F.lit(steps - 1)), F.lit(0)), F.lit(steps - 1))
    return F.when(value.isNull(), F.lit(0)).otherwise(at * steps + inside).cast("bigint")


def _spread(rank: Column) -> Column:
    """The 16 bits of a rank, each followed by a free one."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        rank = rank.bitwiseOR(F.shiftleft(rank, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return rank


def placed(df: DataFrame, first: str, second: str) -> DataFrame:
    """The rows with their interleaved place. Quantiles of the whole table come to the driver: 65 numbers per column."""
    numbers = [as_number(F.col(f"`{c}`"), df.schema[c].dataType) for c in (first, second)]
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    found = df.agg(*[F.percentile_approx(n, shares, 10_000).alias(f"q{i}") for i, n in enumerate(numbers)]).first()
    # in steps: each looks several times at what the one before made
    out = df.withColumns({f"{PLACE}{i}": n for i, n in enumerate(numbers)})
    bounds = [sorted({b for b in q or () if math.isfinite(b)}) or [0.0] for q in found]
    arrays = [F.array(*[F.lit(b) for b in each]) for each in bounds]
    names = [(f"{PLACE}{i}", f"{PLACE}at{i}", arrays[i]) for i in (0, 1)]
    out = out.withColumns({at: F.lit(0) for _, at, _ in names})
    half = QUANTILES // 2
    while half:  # halving, a projection a step; beyond the last bound there is none, so nothing is added
        step = {at: F.col(at) + F.when(F.get(b, F.col(at) + half) <= F.col(v), half).otherwise(0) for v, at, b in names}
        out, half = out.withColumns(step), half // 2
    out = out.withColumns({v: _rank(F.col(v), F.col(at), b) for v, at, b in names})
    both = F.shiftleft(_spread(F.col(f"{PLACE}0")), 1).bitwiseOR(_spread(F.col(f"{PLACE}1")))
    return out.withColumn(PLACE, both).drop(*[f"{PLACE}{x}" for x in ("0", "1", "at0", "at1")])


def write_clustered(df: DataFrame, path: str, first: str, second: str, files: int, mode: str = "overwrite") -> None:
    """The rows as ``files`` files by interleaved place.

    Rows that share a place (a hot pair of values) are split by a hash of the pair's
    other columns, so no place has to fit one task.
    """
    plain = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    (
        placed(df, first, second)
        .withColumn(f"{PLACE}_tie", F.xxhash64(*plain))
        .repartitionByRange(files, PLACE, f"{PLACE}_tie")
        .sortWithinPartitions(PLACE)
        .drop(PLACE, f"{PLACE}_tie")
        .write.mode(mode)
        .option("compression", "snappy")
        .parquet(path)
    )


def group_bounds(spark: SparkSession, path: str, first: str, second: str) -> DataFrame:
    """``file, row_group, group_rows`` and the bounds ``low0, high0, low1, high1`` of two columns, from the footers."""

    def of(name: str, bound: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col(bound)))

    wanted = footers.footers(spark, path).where(F.col("name").isin(first, second) & F.col("row_group").isNotNull())
    return wanted.groupBy("file", "row_group").agg(
        F.max("group_rows").alias("group_rows"),
        *[of(c, bound).alias(f"{bound}{i}") for i, c in enumerate((first, second)) for bound in ("low", "high")],
    )


def hit_groups(bounds: DataFrame, boxes: DataFrame) -> DataFrame:
    """Row groups that may hold a row of a box (``low0, high0, low1, high1``, ends included).

    Boxes are the small side of a range join: the caller's list of what is wanted. A
    group without bounds may hold anything.
    """
    b = boxes.select(*[F.col(c).cast("double").alias(f"box_{c}") for c in ("low0", "high0", "low1", "high1")])
    meets = F.lit(True)
    for i in (0, 1):
        apart = (F.col(f"high{i}") < F.col(f"box_low{i}")) | (F.col(f"low{i}") > F.col(f"box_high{i}"))
        meets = meets & ~F.coalesce(apart, F.lit(False))
    return bounds.join(F.broadcast(b), meets, "left_semi")


def read_boxes(spark: SparkSession, path: str, first: str, second: str, boxes: DataFrame, most: int = 10_000) -> DataFrame:
    """Rows inside any of the boxes, read from only the files that may hold one.

    Row groups inside those files are skipped by the reader itself, as the span of all
    boxes is a plain filter. Names of the files read go through the driver, as for any scan.
    ``most`` bounds the list of boxes, which is broadcast.
    """
    listed = boxes.limit(most + 1).collect()
    if len(listed) > most:
        raise ValueError(f"more than {most} boxes; join the table instead")
    whole = spark.read.parquet(path)
    if not listed:
        return whole.where(F.lit(False))
    boxes = spark.createDataFrame([tuple(r[c] for c in ("low0", "high0", "low1", "high1")) for r in listed], "low0 double, high0 double, low1 double, high1 double")
    files = [r["file"] for r in hit_groups(group_bounds(spark, path, first, second), boxes).select("file").distinct().collect()]
    if not files:
        return whole.where(F.lit(False))
    rows = spark.read.schema(whole.schema).parquet(*files)
    meets = F.lit(True)
    for i, name in enumerate((first, second)):
        kind = whole.schema[name].dataType
        number = as_number(F.col(f"`{name}`"), kind)
        meets = meets & number.between(F.col(f"box_low{i}"), F.col(f"box_high{i}"))
        low, high = min(r[f"low{i}"] for r in listed), max(r[f"high{i}"] for r in listed)
        rows = rows.where(F.col(f"`{name}`").between(_as_value(low, kind), _as_value(high, kind)))
    named = boxes.select(*[F.col(c).alias(f"box_{c}") for c in boxes.columns])
    return rows.join(F.broadcast(named), meets, "left_semi")


def _as_value(number: float, kind: T.DataType) -> Column:
    """The other way of ``as_number``, as a literal that reaches the Parquet reader."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", F.lit(int(number)), F.lit("1970-01-01").cast(kind))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(int(number)))
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(int(number)))
    return F.lit(number)
