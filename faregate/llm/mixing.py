"""Mixing sources to target weights by Poisson replication.

A source with target share t of ``rows`` output rows (as many as there are, if
not given) and n documents has the mean rate t * rows / n. Each document's count
is drawn from the Poisson distribution with that mean by inverting it at a
number between 0 and 1 that a hash of seed and id gives; the document is then
exploded into that many copies, and all copies are shuffled by another hash.
Nothing is random: a recomputed task draws the same counts.

The distribution function is tabulated once per source, up to twelve standard
deviations beyond the mean. A mean above 64 is the sum of several draws with
equal smaller means, so no table has more than some 190 entries.

Texts are shuffled once, after the draw. The table of sources is broadcast only
where it measures small; beyond that adaptive execution splits a large source.

Weights: a table (source, weight), or an exponent: with ``tempering`` 0.5 a
source weighs as the square root of its size, with 0 all sources weigh alike. A
source without a weight, or with a weight that is not above zero, is left out.
A null source is a source of its own. Null ids draw alike, as do rows that
repeat an id in a source. Texts, null, empty or long, are only carried. An empty
table gives no rows. Names that clash with ``copy`` and ``copies`` make those
two take a leading underscore, or more until no column has their names. Map columns are
carried like others; they only take no part in the order of the copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregate.llm.common import hashable
from faregate.operators.joins import broadcast_if_small
from faregate.operators.layout import written

PART = 64.0  # the largest mean of one draw
DIGITS = 13  # hex digits of a draw: 52 bits


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 text of the parts."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("bigint") / F.lit(float(16**DIGITS))


def distribution(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... up to far beyond the mean."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    none = F.exp(-mean)
    start = F.struct(none.alias("p"), none.alias("sum"), F.array(none).alias("out"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        total = state["sum"] + p
        return F.struct(p.alias("p"), total.alias("sum"), F.concat(state["out"], F.array(total)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["out"])


def rates(
    docs: DataFrame, source: str, weights: DataFrame | None, tempering: float, rows: int | None
) -> DataFrame:
    """Per source its mean, the number of draws it is split into and their distribution."""
    counts = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(float(tempering))))
    else:
        named = weights.select(F.col("source").alias("named"), F.col("weight").cast("double").alias("weight"))
        counts = counts.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named").filter("weight > 0")
    counts = written(counts)
    total = counts.agg(F.sum("weight").alias("weight"), F.sum("n").alias("n"))
    wanted = F.lit(float(rows)) if rows is not None else docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    mean = F.col("weight") / total.select("weight").scalar() * wanted / F.col("n")
    parts = F.greatest(F.ceil(F.col("mean") / PART), F.lit(1)).cast("int")
    return (
        counts.withColumn("mean", mean)
        .withColumn("parts", parts)
        .select("source", "mean", "parts", distribution(F.col("mean") / F.col("parts")).alias("table"))
    )


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: DataFrame | None = None,
    tempering: float = 0.5,
    rows: int | None = None,
    seed: str = "mixture",
    with_copies: bool = True,
) -> DataFrame:
    """The columns of ``docs``, each row as often as drawn, and ``copy`` (from 1) of ``copies``."""
    table = broadcast_if_small(written(rates(docs, source, weights, tempering, rows)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = docs.select(
        row, F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("own")
    ).join(table, F.col("own").eqNullSafe(F.col("source")))
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    place = F.coalesce(F.col("own").cast("string"), F.lit(""))

    def drawn(part: Column) -> Column:
        at = uniform(F.lit(seed), place, key, part)
        return F.size(F.filter("table", lambda edge: edge <= at))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda total, part: total + drawn(part))
    counted = named.select("row", "id", copies.alias("copies")).filter("copies > 0")
    every = counted.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    order = F.xxhash64(F.lit(seed), "id", "copy", hashable(docs, "row"))
    mixed = every.withColumn("order", order).repartition("order").sortWithinPartitions("order")
    if not with_copies:
        return mixed.select("row.*")
    lead, taken = "", {c.lower() for c in docs.columns}
    while {f"{lead}copy", f"{lead}copies"} & taken:
        lead += "_"
    return mixed.select("row.*", F.col("copy").alias(f"{lead}copy"), F.col("copies").alias(f"{lead}copies"))
