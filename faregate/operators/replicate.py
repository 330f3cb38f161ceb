"""Replication to a target size, and unions across schema versions."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregate.operators.ranks import keys_at_ranks

COPIES_PER_CHUNK = 1_000


def replicate_rows(
    df: DataFrame,
    key: str,
    target: int | Callable[[int], int],
    copy_column: str = "copy",
    spread: bool | None = None,
) -> DataFrame:
    """Repeat all rows until there are exactly ``target``; the last round is partial.

    Rows up to the key at rank ``target % n`` get one copy more than the rest,
    so nothing is joined, sorted or shuffled. With ``spread`` the copies of a row
    are first planned in chunks of 1,000 and the chunks shuffled, so that no task
    unfolds a whole row's copies; if not given, it is on where a row has more
    copies than a chunk. The key must be unique; a row without a key gets the
    whole rounds only, and a last round that would need such rows is an error.
    """
    n, keyed = df.agg(F.count(F.lit(1)), F.count(key)).first()
    whole, partial = divmod(target if isinstance(target, int) else target(n), max(n, 1))
    copies = F.lit(whole).cast("bigint")
    if partial > keyed:
        raise ValueError(f"{n - keyed} rows have no {key}; the last round needs {partial} rows with one")
    if spread is None:
        spread = whole > COPIES_PER_CHUNK
    if partial and n:
        (last,) = keys_at_ranks(df, key, [lambda _: F.lit(partial - 1)])
        copies = copies + F.coalesce(F.col(key) <= last, F.lit(False)).cast("bigint")
    step = F.lit(COPIES_PER_CHUNK).cast("bigint")
    last_copy = F.greatest(F.col("__copies") - 1, F.lit(0))
    chunks = (
        df.withColumn("__copies", copies)
        .where(F.col("__copies") > 0)
        .withColumn("__from", F.explode(F.sequence(F.lit(0).cast("bigint"), last_copy, step)))
    )
    if spread:
        chunks = chunks.repartition(F.col(key), F.col("__from"))
    inside = F.sequence(
        F.col("__from"), F.least(F.col("__from") + step, F.col("__copies")) - 1
    )
    return chunks.withColumn(copy_column, F.explode(inside)).drop("__copies", "__from")


def csv_row_bytes(df: DataFrame) -> float:
    """Average length of a row as CSV text with its line end."""
    line = F.to_csv(F.struct(*[F.col(name) for name in df.columns]))
    return df.agg(F.avg(F.octet_length(line) + 1)).first()[0] or 1.0


def replicate_to_csv_bytes(df: DataFrame, key: str, target_bytes: int) -> DataFrame:
    """Repeat rows until their CSV text reaches about ``target_bytes``."""
    return replicate_rows(df, key, math.ceil(target_bytes / csv_row_bytes(df)))


def union_versions(*frames: DataFrame) -> DataFrame:
    """All rows of several schema versions; a column a version lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
