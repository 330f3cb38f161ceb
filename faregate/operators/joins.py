"""Join strategies for a fact and a dimension with a unique key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate.operators.shares import hot_keys

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def _held(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(8) + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.StructType):
        parts = [_held(value[f.name], f.dataType) for f in kind.fields]
        return reduce(lambda a, b: a + b, parts, F.lit(8))
    if isinstance(kind, T.ArrayType):
        inside = F.aggregate(value, F.lit(0).cast("bigint"), lambda sum, x: sum + _held(x, kind.elementType))
        return F.lit(8) + F.coalesce(inside, F.lit(0))
    if isinstance(kind, T.MapType):
        keys, values = T.ArrayType(kind.keyType), T.ArrayType(kind.valueType)
        return _held(F.map_keys(value), keys) + _held(F.map_values(value), values)
    return F.lit(8)


def held_bytes(df: DataFrame) -> Column:
    """Bytes a row holds: eight per number, and what texts, arrays, maps and structs hold inside."""
    parts = [_held(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    return reduce(lambda a, b: a + b, parts, F.lit(0)).cast("bigint")


def broadcast_if_small(
    side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark ``side`` for broadcast only after measuring that it is small.

    The measuring stops at ``max_rows + 1`` rows. A larger side is returned as
    it is: Spark then picks a shuffled join, and its skew handling applies.
    """
    rows, size = side.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(held_bytes(side))).first()
    return F.broadcast(side) if rows <= max_rows and (size or 0) <= max_bytes else side


def attach_per_group(
    rows: DataFrame, summary: DataFrame, column: str, by: Sequence[str], few_groups: bool
) -> DataFrame:
    """Add a summary's column to every row of its group.

    Without group columns the summary is one row and becomes a scalar
    subquery. With them it is joined, a missing group key matching itself, and
    broadcast only when the caller has counted that the groups are few.
    """
    if not by:
        return rows.withColumn(column, summary.select(column).scalar())
    renamed = summary.select(
        *[F.col(name).alias(f"__g{i}") for i, name in enumerate(by)], column
    )
    if few_groups:
        renamed = F.broadcast(renamed)
    matches = F.lit(True)
    for i, name in enumerate(by):
        matches = matches & F.col(name).eqNullSafe(F.col(f"__g{i}"))
    return rows.join(renamed, matches).select(*rows.columns, column)


def join_dimension(
    fact: DataFrame, dim: DataFrame, key: str, strategy: str = "auto", how: str = "left"
) -> DataFrame:
    """Equi-join with a chosen physical strategy: auto, broadcast, hash or merge."""
    if strategy == "broadcast":
        dim = broadcast_if_small(dim)
    elif strategy == "hash":
        dim = dim.hint("shuffle_hash")
    elif strategy == "merge":
        dim = dim.hint("merge")
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy!r}")
    return fact.join(dim, key, how)


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    spread_on: list[str],
    strategy: str = "auto",
    how: str = "left",
    partitions: int | None = None,
) -> DataFrame:
    """Shuffled join in which no key outgrows a partition, adaptive or not.

    With P shuffle partitions a key is hot when it holds more than 1/P of the
    fact rows. There are at most P such keys, so marking them is a broadcast of
    proven size. A key with share s is spread over ``2 * s * P`` salts, about
    half a partition each; its dimension row is copied as often, which adds at
    most 3 P rows in all. Missing keys match nothing and are spread too. The
    salt is a hash of row columns: a recomputed task salts its rows the same
    way again.
    """
    if partitions is None:
        partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(
        hot_keys(fact, key, 1.0 / partitions).select(
            key, F.ceil(F.col("share") * (2 * partitions)).cast("int").alias("__salts")
        )
    )
    salts = F.when(F.col(key).isNull(), F.lit(partitions)).otherwise(
        F.coalesce(F.col("__salts"), F.lit(1))
    )
    salted_fact = (
        fact.join(hot, key, "left")
        .withColumn("__salt", F.pmod(F.xxhash64(*spread_on), salts).cast("int"))
        .drop("__salts")
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    salted_dim = dim.join(hot, key, "left").withColumn("__salt", F.explode(copies)).drop("__salts")
    if strategy == "hash":
        salted_dim = salted_dim.hint("shuffle_hash")
    elif strategy == "merge":
        salted_dim = salted_dim.hint("merge")
    return salted_fact.join(salted_dim, [key, "__salt"], how).drop("__salt")


def join_or_salt(fact: DataFrame, dim: DataFrame, key: str, spread_on: list[str], how: str = "left") -> DataFrame:
    """A broadcast join where the dimension measures small, a salted one beyond."""
    small = broadcast_if_small(dim)
    if small is not dim:
        return fact.join(small, key, how)
    return salted_join(fact, dim, key, spread_on, how=how)
