"""Portable pseudo-random draws.

A draw is the MD5 hex text of ``key:salt``. It is uniform, independent of
partitioning and of task retries, and any SQL engine can recompute it. Hex
texts of equal case compare like the numbers they stand for, so a probability
becomes a short hex threshold and no number is ever parsed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_SPAN = 1 << 32  # a threshold is the first eight hex digits


def draw(key: Column, salt: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{salt}")))


def threshold(probability: float) -> str:
    """Hex text ``t`` such that ``draw < t`` holds with the given probability."""
    step = int(probability * DRAW_SPAN)
    return "g" if step >= DRAW_SPAN else f"{max(step, 0):08x}"


def weighted_label(
    key: Column, salt: str, labels: list[str], weights: list[float]
) -> Column:
    """One label per key, drawn with the given weights (made to sum to one)."""
    total = sum(weights)
    drawn = draw(key, salt)
    expr: Column | None = None
    reached = 0.0
    for label, weight in zip(labels[:-1], weights[:-1]):
        reached += weight
        hit = drawn < F.lit(threshold(reached / total))
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    last = F.lit(labels[-1])
    return last if expr is None else expr.otherwise(last)


def bucket(key: Column, salt: str, buckets: int) -> Column:
    """Bucket number 0..buckets-1 from the first eight digits of a draw."""
    number = F.conv(F.substring(draw(key, salt), 1, 8), 16, 10).cast("bigint")
    return number % F.lit(buckets)
