"""Exact duplicates: missing equals missing, NaN equals NaN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_identity(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Group keys equal exactly for equal rows, with long texts as SHA-256.

    The digest keeps whole texts out of the shuffle: 32 bytes per text travel,
    whatever its length.
    """
    keys = []
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            keys.append(F.unhex(F.sha2(F.col(name).cast("binary"), 256)).alias(name))
        else:
            keys.append(F.col(name))
    return keys


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``rows, distinct_rows, duplicates`` (copies beyond the first) over the columns.

    Copies collapse inside each task before the shuffle, so a group of copies
    holding a third of the table is one row per task.
    """
    columns = list(columns or df.columns)
    groups = df.groupBy(*row_identity(df, columns)).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"),
    )


def drop_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row of every group of equal rows, over all columns or a projection."""
    kept = df.select(*columns) if columns else df
    return kept.dropDuplicates()
