"""Table readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate import schemas
from faregate.operators import layout
from faregate.sources import quoted_csv


class UnreadableTimestamps(ValueError):
    """The Parquet file holds nanosecond timestamps, which Spark cannot read."""


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; a file with nanosecond timestamps is reported as such."""
    try:
        return spark.read.parquet(path)
    except Exception as error:
        if "NANOS" in str(error):
            raise UnreadableTimestamps(
                f"{path} holds TIMESTAMP(NANOS) columns; write it with microseconds"
            ) from error
        raise


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Hive layout; with the schema given, a text partition value stays text."""
    return spark.read.schema(schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV that ``layout.write_csv`` wrote: every value as it was, an empty field is a missing value."""
    raw = _csv_texts(spark, path, schema)
    return raw.select(
        *[
            (layout.unescaped(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`"))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def read_foreign_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_tokens: tuple[str, ...] = schemas.CSV_NULL_TOKENS,
    multi_line: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """CSV of another tool; every pandas null text becomes a missing value.

    Spark knows one null text per read, so columns are read as text and cast
    in the same projection. A value that does not fit its type is an error,
    as the cast is the strict one. With ``multi_line`` quoted line breaks are
    read as such; files are then split all the same, see ``quoted_csv``.
    """
    raw = quoted_csv.read_texts(spark, path, schema.names, split_bytes) if multi_line else _csv_texts(spark, path, schema)
    tokens = [token for token in null_tokens if token]
    return raw.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(*tokens), F.col(f"`{f.name}`"))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def _csv_texts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return (
        spark.read.schema(text)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines; blank lines are skipped, a broken line is an error."""
    return (
        spark.read.schema(schema)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", layout.NTZ_TEXT)
        .json(path)
    )
