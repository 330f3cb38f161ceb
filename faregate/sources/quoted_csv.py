"""CSV with line breaks inside quotes, read by as many tasks as the files have splits.

Whether a line break ends a record depends on every quote before it. A split
cannot know them, but the breaks under either assumption differ only by the parity
of the quotes ahead of it (a quote inside a field is doubled, which leaves parity as
it is). So:

1. Each split counts its quotes and says whether it has a line with an odd number
   of them: one row per split.
2. A scan over those rows, split by split within each file, settles for each one
   whether it starts inside quotes, and which earlier split opened the record it
   continues.
3. Each split is read again and puts its lines together. What it holds of a record
   that was opened before it, or stays open at its end, leaves as a fragment: two at
   most, and no text but these is shuffled. Fragments of a record are joined by file
   and the split that opened it.

Lines end with ``\\n``; a ``\\r`` before it belongs to the line end if that ends a
record, and to the text if it is quoted. Files that cannot be split (compressed ones) are one split
each. A quote in a field that is not quoted is no CSV that any common writer makes; it
shifts all that follows, which the strict parse of a record reports.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faregate.operators.joins import broadcast_if_small
from faregate.session import ship, variant_session

ROWS_OUT = 10_000
CHARS_OUT = 16 << 20


def physical_lines(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """``file, block, line``: the lines of every split, in order within a split."""
    if split_bytes is not None:
        spark = variant_session(
            spark,
            {
                "spark.sql.files.maxPartitionBytes": str(split_bytes),
                "spark.sql.files.openCostInBytes": "0",
                "spark.sql.files.minPartitionNum": "1",
            },
        )
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")
    )


def settled_splits(lines: DataFrame) -> DataFrame:
    """``file, block, inside, owner`` per split: whether it starts inside quotes, and who opened that record."""
    quotes = F.char_length("line") - F.char_length(F.replace("line", F.lit('"'), F.lit("")))
    splits = lines.select("file", "block", (quotes % 2).alias("odd")).groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("parity"), F.max("odd").alias("any_odd")
    )
    # a few bytes per split, so a file's splits fit one task
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("inside", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1)
    # a split inside quotes throughout opens nothing
    opener = F.when(~F.col("inside") | (F.col("any_odd") == 1), F.col("block"))
    return starts.withColumn("owner", F.last(opener, ignorenulls=True).over(before)).select("file", "block", "inside", "owner")


RECORD = "file string, block bigint, record string, first boolean, owner bigint"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records (owner null) and fragments (owner set) of splits that come one after another."""
    rows: list[tuple] = []
    held = 0
    split: tuple | None = None
    open_lines: list[str] = []  # of the record at hand
    quoted = continued = False  # inside quotes; the record began in an earlier split
    owner, first = None, False

    def take(text: str, of: int | None) -> None:
        nonlocal held, first
        rows.append((*split, text, first, of))
        held += len(text)
        first = False

    def leave() -> None:
        """The split ends: an open record leaves as a fragment."""
        if open_lines:
            take("\n".join(open_lines), owner if continued else split[1])
            open_lines.clear()

    def made() -> pa.RecordBatch:
        nonlocal rows, held
        done, rows, held = rows, [], 0
        names = ["file", "block", "record", "first", "owner"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], names)

    for batch in batches:
        for file, block, line, inside, opener in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "line", "inside", "owner"))):
            if split != (file, block):
                leave()
                split, quoted, continued, owner, first = (file, block), inside, inside, opener, block == 0
            open_lines.append(line)
            if line.count('"') % 2:
                quoted = not quoted
            if not quoted:
                text = "\n".join(open_lines)
                open_lines.clear()
                if continued:
                    take(text, owner)
                    continued = False
                else:
                    take(text, None)
            if len(rows) >= ROWS_OUT or held >= CHARS_OUT:
                yield made()
    leave()
    if rows:
        yield made()


def records(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """``record, first``: every record with its line breaks; ``first`` marks the first one of a file."""
    ship(spark)
    lines = physical_lines(spark, path, split_bytes).withColumn("at", F.monotonically_increasing_id())
    splits = settled_splits(lines).withColumnsRenamed({"file": "of", "block": "start"})
    known = broadcast_if_small(splits)
    joined = lines.join(known, (F.col("file") == F.col("of")) & (F.col("block") == F.col("start")), "left")
    if known is splits:  # a shuffled join: back into the order of the lines
        joined = joined.sortWithinPartitions("file", "block", "at")
    same_splits = F.when(F.col("of").isNull(), F.raise_error(F.lit("a file was split otherwise on second reading")).cast("boolean"))
    settled = joined.select("file", "block", "line", F.coalesce("inside", same_splits).alias("inside"), "owner")
    parts = settled.mapInArrow(_records, RECORD)
    whole = parts.where("owner IS NULL").select("record", "first")
    # the fragments of one record: as many as the splits it spans
    texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "record"))), lambda x: x["record"])
    spanning = parts.where("owner IS NOT NULL").groupBy("file", "owner").agg(
        F.array_join(texts, "\n").alias("record"), F.max("first").alias("first")
    ).select("record", "first")
    ended = F.regexp_replace("record", "\\r$", "")
    marked = F.when(F.col("first"), F.regexp_replace(ended, "^\ufeff", "")).otherwise(ended)  # a byte order mark
    return whole.unionByName(spanning).withColumn("record", marked).where("record <> ''")


def read_texts(spark: SparkSession, path: str, names: list[str], split_bytes: int | None = None) -> DataFrame:
    """All columns as text; a header of other names and a record of another shape are errors."""
    ddl = ", ".join(f"`{n}` string" for n in names)
    options = {"mode": "FAILFAST", "escape": '"', "multiLine": "true"}
    parsed = records(spark, path, split_bytes).select("first", F.from_csv("record", ddl, options).alias("row"))
    named = reduce(lambda a, b: a & b, [F.col("row")[n].eqNullSafe(F.lit(n)) for n in names])
    other = F.raise_error(F.concat(F.lit("a header has other columns: "), F.to_json("row"))).cast("boolean")
    body = F.when(F.col("first"), F.when(named, F.lit(False)).otherwise(other)).otherwise(F.lit(True))
    return parsed.where(body).select("row.*")
