"""Content fingerprint of a table, whatever its files, order or partitions.

A row's text names its columns in name order, marks missing values and gives
the length of every other one, so that no two rows can share a text by moving
a value or a null from one column to the next. The MD5 of that text is cut into
four numbers, and each is summed over all rows: any SQL engine can do the same.
Numbers with a fraction count to six decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LARGEST = 1e30  # numbers beyond have no six decimals to speak of


def value_text(value: Column, kind: T.DataType) -> Column:
    """A value as text that other engines can write alike; null stays null."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        number = value.cast("double")
        fixed = F.when(F.abs(number) < LARGEST, number).cast("decimal(38,6)").cast("string")
        other = F.when(F.isnan(number), "NaN").when(number > 0, "large").otherwise("-large")
        return F.when(F.isnan(number) | (F.abs(number) >= LARGEST), other).otherwise(fixed)
    if isinstance(kind, T.TimestampNTZType):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, value).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, T.ArrayType):
        return F.array_join(F.transform(value, lambda x: marked(value_text(x, kind.elementType))), ",")
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")


def marked(text: Column) -> Column:
    """``N`` for a missing value, else ``V``, the length in bytes and the text."""
    known = F.concat(F.lit("V"), F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(known, F.lit("N"))


def row_text(df: DataFrame) -> Column:
    parts = [
        F.concat(F.lit(f"{f.name}="), marked(value_text(F.col(f"`{f.name}`"), f.dataType)))
        for f in sorted(df.schema.fields, key=lambda f: f.name)
    ]
    return F.concat_ws(";", *parts)


def fingerprint(df: DataFrame) -> DataFrame:
    """``rows, content``: the number of rows and four sums, colon-joined."""
    digest = F.md5(row_text(df))
    parts = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)") for i in range(4)]
    return df.select(*[part.alias(f"p{i}") for i, part in enumerate(parts)]).agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws(":", *[F.coalesce(F.sum(f"p{i}"), F.lit(0)).cast("string") for i in range(4)]).alias("content"),
    )


def short_fingerprint(df: DataFrame) -> DataFrame:
    """The fingerprint as 16 hex characters, for manifests."""
    whole = fingerprint(df)
    return whole.select(F.substring(F.sha2(F.concat_ws(":", "rows", "content"), 256), 1, 16).alias("fingerprint"))
