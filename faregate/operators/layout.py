"""Writing the same rows in several layouts, and looking at what was written."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faregate.session import shared_folder, variant_session

NTZ_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # keeps microseconds in text formats


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Snappy Parquet; mode ``ignore`` skips a table that is already there."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, read back.

    For a result that several passes use: they scan the table instead of
    repeating the work, and a lost executor costs a re-read.
    """
    path = f"{shared_folder(df.sparkSession)}/table"
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


# A line break inside a text would break the row for a reader that splits files; in this
# order each of these is replaced on writing, and in the reverse order put back on reading.
CSV_ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))

CSV_EMPTY = "\\e"  # an empty text; an empty field is a missing value


def escaped(column: Column) -> Column:
    out = column
    for plain, coded in CSV_ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return F.when(column == "", CSV_EMPTY).otherwise(out)


def unescaped(column: Column) -> Column:
    out = column
    for plain, coded in reversed(CSV_ESCAPES):
        out = F.replace(out, F.lit(coded), F.lit(plain))
    return F.when(column == CSV_EMPTY, "").otherwise(out)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header that ``tables.read_csv`` reads back value by value.

    Line breaks and backslashes of texts are escaped, so the files stay
    splittable; blanks at either end of a text are kept.
    """
    texts = {f.name: escaped(F.col(f"`{f.name}`")) for f in df.schema if f.dataType.typeName() == "string"}
    (
        df.withColumns(texts)
        .write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", NTZ_TEXT)
        .csv(path)
    )


def write_quoted_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV as common tools write it: line breaks, commas and quotes stand in quotes, a missing value is an empty field."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line; missing values are written as ``null``."""
    (
        df.write.mode(mode)
        .option("ignoreNullFields", False)
        .option("timestampNTZFormat", NTZ_TEXT)
        .json(path)
    )


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "overwrite") -> None:
    """Hive layout by one column.

    Rows are rebalanced by that column first, so a day is written by few tasks
    instead of by all, and adaptive execution splits a day that is too large.
    """
    (
        df.hint("rebalance", by)
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy(by)
        .parquet(path)
    )


def replace_days(df: DataFrame, path: str, by: str) -> None:
    """Write only the partitions ``df`` holds; running it twice changes nothing."""
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(by)
        .parquet(path)
    )


def write_small_files(df: DataFrame, path: str, files: int) -> None:
    """The small-files layout: ``files`` files of about equal size, no row lost."""
    df.repartition(files).write.mode("overwrite").option("compression", "snappy").parquet(path)


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = 256 << 20) -> None:
    """Rewrite a Parquet table of small files as files of about ``file_bytes``.

    The reader packs many small files into one task and that task writes one
    file, so nothing is shuffled. Opening cost is set low, or a task would be
    held full after a few tiny files.
    """
    packing = variant_session(
        spark,
        {
            "spark.sql.files.maxPartitionBytes": str(file_bytes),
            "spark.sql.files.openCostInBytes": "4096",
            "spark.sql.files.minPartitionNum": "1",
        },
    )
    write_parquet(packing.read.parquet(source), target)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modificationTime`` of every data file below ``path``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def _below(root: str) -> Column:
    """The part of a file's path below ``root``, whatever scheme either is written with."""
    plain = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    folder = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root.rstrip("/"))
    # paths that list files are not percent-encoded, so the root is compared as it is
    return F.when(F.startswith(plain, F.lit(f"{folder}/")), F.substr(plain, F.lit(len(folder) + 2)))


def layout_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes of each layout directly below ``root``."""
    name = F.regexp_extract(_below(root), "^([^/]+)/", 1)
    return (
        listing(spark, root)
        .groupBy(name.alias("layout"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def partition_files(spark: SparkSession, root: str, by: str) -> DataFrame:
    """Files and bytes per partition value of a Hive layout; the default partition is a null value."""
    coded = F.regexp_extract(_below(root), f"^{re.escape(by)}=([^/]+)/", 1)
    # a plus sign is itself in a partition path, and a blank to a URL
    value = F.when(coded != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(coded, F.lit("+"), F.lit("%2B"))))
    return (
        listing(spark, root)
        .groupBy(value.alias(by))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def missing_artifacts(expected: DataFrame, present: DataFrame, on: str) -> DataFrame:
    """Expected names that are not present."""
    have = present.select(F.col(on).alias("__have"))
    return expected.select(on).distinct().join(have, F.col(on).eqNullSafe(F.col("__have")), "left_anti")


# The floor a dataset has to clear.
FLOOR_ROWS = 40_000_000
FLOOR_BYTES = 3_000_000_000
FLOOR_MONTHS = 6


def dataset_floor(
    df: DataFrame,
    ts: str,
    raw_bytes: Column | None = None,
    rows: int = FLOOR_ROWS,
    months: int = FLOOR_MONTHS,
    size: int = FLOOR_BYTES,
) -> DataFrame:
    """Rows, months (and raw bytes) of a dataset and whether they clear the floor."""
    month = F.trunc(F.col(ts).cast("date"), "month")
    per_month = df.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("n"))
    report = per_month.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("month").alias("month_count"),
    ).withColumns(
        {
            "rows_ok": F.col("row_count") >= F.lit(rows),
            "months_ok": F.col("month_count") >= F.lit(months),
        }
    )
    if raw_bytes is None:
        return report
    return report.withColumn("raw_bytes", raw_bytes).withColumn(
        "bytes_ok", F.col("raw_bytes") >= F.lit(size)
    )


def write_manifest(metrics: DataFrame, path: str) -> None:
    """Metric rows as JSON; a manifest has tens of rows, so one file."""
    metrics.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def text_bytes(df: DataFrame) -> Column:
    """Raw size of a table as a scalar subquery: eight bytes per number, and the bytes of texts."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    row = F.lit(8 * (len(df.columns) - len(texts))).cast("bigint")
    for name in texts:
        row = row + F.coalesce(F.octet_length(f"`{name}`"), F.lit(0))
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).scalar()


def bytes_below(spark: SparkSession, paths: Sequence[str]) -> Column:
    """Total size of the files below some paths, as a scalar subquery."""
    files = None
    for path in paths:
        part = listing(spark, path)
        files = part if files is None else files.unionByName(part)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).scalar()
