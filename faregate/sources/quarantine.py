"""JSON lines read in full: good lines as rows, bad ones kept with where they stand and why.

A line is good if it is one JSON object whose values fit the schema; a column that it
lacks is missing. Every other line goes to the quarantine with its file, the byte it
starts at, its text and a reason:

* ``blank``, ``not JSON``, ``not an object``;
* ``type of <column>``: the first column, in schema order, whose value does not fit;
* ``no <column>``: the first column of ``required`` that is absent or null.

Offsets: lines end with one byte (``\\n``), so the bytes of earlier splits of a file, added
up, say where a split's first line starts; within a split a task adds up the lengths of
lines as they come. Texts of good lines do not leave the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate.operators.joins import broadcast_if_small
from faregate.operators.layout import NTZ_TEXT
from faregate.session import ship
from faregate.sources.quoted_csv import physical_lines

BROKEN = "__broken"
OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, "timestampNTZFormat": NTZ_TEXT}


def _parsed(line: Column, schema: T.StructType) -> Column:
    if BROKEN in schema.names:
        raise ValueError(f"a column may not be named {BROKEN}")
    return F.from_json(line, T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())]), OPTIONS)


def _reason(line: Column, row: Column, schema: T.StructType, required: Sequence[str]) -> Column:
    """Why a line is bad; null for a good one."""
    # the parser stops after the first value; no line has more after it and fits into both of these
    in_array = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"x":'), line, F.lit("}")))
    value = F.try_variant_get(in_object, "$.x", "variant")
    is_object = F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))
    found = (
        F.when(F.trim(line) == "", "blank").when(in_array.isNull() | in_object.isNull(), "not JSON").when(~is_object, "not an object")
    )
    broken = row[BROKEN].isNotNull()
    for field in schema.fields:
        present = F.coalesce(F.schema_of_variant(F.try_variant_get(value, _path(field.name), "variant")), F.lit("VOID")) != "VOID"
        found = found.when(broken & present & row[field.name].isNull(), f"type of {field.name}")
    found = found.when(broken, "not JSON")
    for name in required:
        found = found.when(row[name].isNull(), f"no {name}")
    return found


def _path(name: str) -> str:
    escaped = name.replace("\\", "\\\\").replace('"', '\\"')
    return f'$["{escaped}"]'


def judged_lines(
    spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (), split_bytes: int | None = None
) -> DataFrame:
    """``file, block, line, row, reason`` of every line."""
    lines = physical_lines(spark, path, split_bytes)
    rows = lines.select("file", "block", "line", _parsed(F.col("line"), schema).alias("row"))
    return rows.withColumn("reason", _reason(F.col("line"), F.col("row"), schema, required))


def good_rows(
    spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (), split_bytes: int | None = None
) -> DataFrame:
    """The rows of good lines."""
    judged = judged_lines(spark, path, schema, required, split_bytes).where("reason IS NULL")
    return judged.select(*[F.col("row")[name].alias(name) for name in schema.names])


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bad lines with the byte they start at within their split; splits come one after another."""
    split, at = None, 0
    for batch in batches:
        offsets = []
        for file, block, size in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "bytes"))):
            if split != (file, block):
                split, at = (file, block), 0
            offsets.append(at)
            at += size
        out = pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("file", "block", "line", "reason")), pa.array(offsets, pa.int64())],
            ["file", "block", "line", "reason", "at"],
        )
        bad = out.filter(pc.is_valid(batch.column("reason")))
        if bad.num_rows:
            yield bad


def bad_lines(
    spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (), split_bytes: int | None = None
) -> DataFrame:
    """``file, offset, line, reason`` of every line that is no row."""
    ship(spark)
    size = (F.octet_length("line") + 1).cast("bigint")
    judged = judged_lines(spark, path, schema, required, split_bytes)
    placed = judged.select(
        "file", "block", size.alias("bytes"), F.when(F.col("reason").isNotNull(), F.col("line")).alias("line"), "reason"
    ).mapInArrow(_starts, "file string, block bigint, line string, reason string, at bigint")
    # a few bytes per split, so a file's splits fit one task
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = physical_lines(spark, path, split_bytes).groupBy("file", "block").agg(F.sum(size).alias("bytes"))
    starts = sizes.select("file", "block", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("start"))
    return placed.join(broadcast_if_small(starts), ["file", "block"]).select(
        "file", (F.col("start") + F.col("at")).alias("offset"), "line", "reason"
    )


def reconciled(
    spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (), split_bytes: int | None = None
) -> DataFrame:
    """``file, lines, good, bad, reconciles``: lines counted by a scan of their own against those judged."""
    judged = judged_lines(spark, path, schema, required, split_bytes).groupBy("file").agg(
        F.count_if(F.col("reason").isNull()).alias("good"), F.count_if(F.col("reason").isNotNull()).alias("bad")
    )
    counted = physical_lines(spark, path, split_bytes).groupBy(F.col("file").alias("of")).agg(F.count(F.lit(1)).alias("lines"))
    return counted.join(judged, F.col("of") == F.col("file"), "left").select(
        F.col("of").alias("file"), "lines", "good", "bad", (F.col("lines") == F.col("good") + F.col("bad")).alias("reconciles")
    )
