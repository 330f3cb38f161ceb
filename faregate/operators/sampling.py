"""Exact samples by a portable draw, and the fallback zone lookup."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faregate.functions import digest
from faregate.functions.text import numbered_label
from faregate.operators.ranks import first_rows


@dataclass(frozen=True)
class Pick:
    """``size`` rows with the smallest draws for ``salt``; size is a function of n.

    A draw's 32 digits turned by 8, 16 or 24 places are draws of their own: one
    MD5 serves four picks, told apart by ``turn`` (0 to 3).
    """

    salt: str
    size: Callable[[int], int]
    turn: int = 0

    def draw(self, key: Column) -> Column:
        text = digest.draw(key, self.salt)
        at = 8 * self.turn
        return F.concat(F.substring(text, at + 1, 32 - at), F.substring(text, 1, at)) if at else text


def share_of_rows(rate: float) -> Callable[[int], int]:
    """A share of the rows as a whole number, cut off."""
    return lambda n: int(n * rate)


def pick_limits(df: DataFrame, key: str, picks: dict[str, Pick], total: int | None = None) -> dict[str, str]:
    """For each pick the largest draw still chosen; only these texts come back.

    Draws are uniform, so the wanted draw lies within a few standard deviations
    of ``size / n``. One pass over the key column counts what lies below that
    narrow band and keeps the band's draws, about ``16 * sqrt(size)`` of them,
    which are then ranked. Every pick is found in the same pass. A band that
    misses (only possible when the key is not unique) raises an error.
    """
    n = df.count() if total is None else total
    sizes = {name: min(pick.size(n), n) for name, pick in picks.items()}
    reach = {name: (8.0 * math.sqrt(size + 1) + 32.0) / max(n, 1) for name, size in sizes.items()}
    # Draws are computed once per row, below the explode.
    drawn = df.select(
        *[pick.draw(F.col(key)).alias(name) for name, pick in picks.items()]
    )
    entries = [
        F.when(
            F.col(name) < digest.threshold(size / max(n, 1) + reach[name]),
            F.struct(
                F.lit(name).alias("pick"),
                F.when(
                    F.col(name) >= digest.threshold(size / max(n, 1) - reach[name]), F.col(name)
                ).alias("drawn"),
            ),
        )
        for name, size in sizes.items()
    ]
    counted = (
        drawn.select(F.explode(F.array(*entries)).alias("e"))
        .where(F.col("e").isNotNull())
        .select("e.pick", "e.drawn")
        .groupBy("pick", "drawn")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    running = Window.partitionBy("pick").orderBy(F.col("drawn").asc_nulls_first())
    last = [
        F.max(F.when((F.col("pick") == name) & (F.col("cum") == size), F.col("drawn"))).alias(name)
        for name, size in sizes.items()
    ]
    found = counted.withColumn("cum", F.sum("c").over(running)).agg(*last).first().asDict()
    missed = [name for name, size in sizes.items() if size > 0 and found[name] is None]
    if missed:
        raise ValueError(f"exact picks {missed} not found: the key is not unique")
    return {name: found[name] or "" for name in picks}


def with_picks(df: DataFrame, key: str, picks: dict[str, Pick], total: int | None = None) -> DataFrame:
    """Add one boolean column per pick; exactly ``size`` rows are true in each.

    ``total`` is the table's row count, if known.
    """
    limits = pick_limits(df, key, picks, total)
    return df.withColumns(
        {
            name: F.coalesce(pick.draw(F.col(key)) <= F.lit(limits[name]), F.lit(False))
            for name, pick in picks.items()
        }
    )


def sample_exact(
    df: DataFrame, key: str, salt: str, size: int | Callable[[int], int]
) -> DataFrame:
    """Exactly ``size`` rows without replacement, the same ones on every run."""
    wanted = (lambda n: size) if isinstance(size, int) else size
    return with_picks(df, key, {"__picked": Pick(salt, wanted)}).where("__picked").drop("__picked")


RACE_DIGITS = 13  # hex digits of a draw: 52 bits


def race_time(key: Column, weight: Column, salt: str) -> Column:
    """-ln(u) / weight for a draw u in (0, 1] of the key: the waiting time of an exponential race; null if it can't win."""
    number = F.conv(F.substring(digest.draw(key, salt), 1, RACE_DIGITS), 16, 10).cast("bigint")
    u = (number + 1) / F.lit(float(16**RACE_DIGITS))
    return F.when(weight > 0, -F.ln(u) / weight.cast("double"))


def weighted_sample(df: DataFrame, key: str, weight: str, salt: str, size: int | Callable[[Column], Column]) -> DataFrame:
    """Exactly ``size`` rows without replacement, drawn one after another in proportion to their weights.

    Every row runs an exponential race at the rate of its weight, and the first ``size``
    rows win; that is the same as drawing them in turn. The time of the last winner is
    found as a rank, by brackets, so nothing is sorted and the result is a filter. Rows
    whose weight is missing or not above zero never win; if too few others are there,
    all of them do. With a unique key the number is exact.
    """
    timed = df.withColumn("__race", race_time(F.col(key), F.col(weight), salt)).where("__race IS NOT NULL")
    return first_rows(timed, "__race", size).drop("__race")


# Boroughs of the fallback lookup with their number of zones, and
# the weights of its service zones.
FALLBACK_BOROUGHS = {
    "Manhattan": 69, "Queens": 69, "Brooklyn": 61, "Bronx": 43, "Staten Island": 23,
}
FALLBACK_SERVICE_ZONES = {"Yellow Zone": 0.35, "Boro Zone": 0.55, "Airports": 0.08, "EWR": 0.02}

# Weights of the pick-up borough draw.
BOROUGH_WEIGHTS = {
    "Manhattan": 0.902, "Queens": 0.055, "Brooklyn": 0.028, "Bronx": 0.009,
    "Staten Island": 0.002, "EWR": 0.002, "Unknown": 0.002,
}


def fallback_zones(spark: SparkSession) -> DataFrame:
    """A lookup of 265 zones, for when the real one is not to be had.

    Boroughs are dealt by the order of a draw, so each gets its exact number of
    zones. The table has a fixed 265 rows; ranking it in one task is its size.
    """
    total = sum(FALLBACK_BOROUGHS.values())
    ids = spark.range(1, total + 1).select(F.col("id").cast("int").alias("LocationID"))
    place = F.row_number().over(Window.orderBy(digest.draw(F.col("LocationID"), "borough")))
    borough, reached = None, 0
    for name, zones in FALLBACK_BOROUGHS.items():
        reached += zones
        within = F.col("__place") <= reached
        borough = F.when(within, name) if borough is None else borough.when(within, name)
    return ids.withColumn("__place", place).select(
        "LocationID",
        borough.alias("Borough"),
        numbered_label("Zone", F.col("LocationID")).alias("Zone"),
        digest.weighted_label(
            F.col("LocationID"),
            "service_zone",
            list(FALLBACK_SERVICE_ZONES),
            list(FALLBACK_SERVICE_ZONES.values()),
        ).alias("service_zone"),
    )


def numbered_within(zones: DataFrame, group: str, order: str) -> DataFrame:
    """Lookup rows with their place, from 0, within their group."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    return zones.withColumn("place", place)


def skewed_borough(key: Column, salt: str = "pickup", present: list[str] | None = None) -> Column:
    """A borough drawn with the skewed weights, kept to those that are present."""
    names = [b for b in BOROUGH_WEIGHTS if present is None or b in present]
    return digest.weighted_label(key, salt, names, [BOROUGH_WEIGHTS[b] for b in names])
