"""Footers of Parquet files as a table: schema versions, and what each row group holds.

Footers are read by tasks, a kilobyte or so per row group; no data page is touched.
``pyarrow`` opens the files, so their scheme must be one that it knows on the workers.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate.operators import layout
from faregate.session import ship

FOOTERS = (
    "file string, row_group int, group_rows bigint, place int, name string, kind string, "
    "missing bigint, low double, high double"
)
FILES_PER_TASK = 64


class Narrowing(ValueError):
    """A column's files hold a type that the wanted one cannot hold without loss."""


# The types that hold every value of a type, the next wider ones first.
WIDER: dict[str, tuple[str, ...]] = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def _number(value: object) -> float | None:
    """A bound as a number: microseconds for times, days for dates; other types have none."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, (int, float)):
        return float(value)
    if isinstance(value, datetime.datetime):
        start = datetime.datetime(1970, 1, 1, tzinfo=value.tzinfo and datetime.timezone.utc)
        return float((value - start) // datetime.timedelta(microseconds=1))
    if isinstance(value, datetime.date):
        return float((value - datetime.date(1970, 1, 1)).days)
    return None


def _footer_rows(file: str) -> Iterator[tuple]:
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_type

    system, path = fs.FileSystem.from_uri(file) if "://" in file or file.startswith("file:") else (fs.LocalFileSystem(), file)
    with system.open_input_file(path) as source:
        meta = pq.read_metadata(source)
    schema = meta.schema.to_arrow_schema()
    kinds = {f.name: (i, from_arrow_type(f.type, prefer_timestamp_ntz=True).simpleString()) for i, f in enumerate(schema)}
    flat = {meta.schema.column(i).path: i for i in range(len(meta.schema))}
    for name, (place, kind) in kinds.items():
        if not meta.num_row_groups:
            yield file, None, 0, place, name, kind, 0, None, None
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stats = group.column(flat[name]).statistics if name in flat else None
            known = stats is not None and stats.has_min_max
            missing = stats.null_count if stats is not None and stats.has_null_count else None
            yield (
                file, g, group.num_rows, place, name, kind, missing,
                _number(stats.min) if known else None, _number(stats.max) if known else None,
            )


def footers(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, row group and column: rows, type, missing values, and bounds where it is a number or a time.

    A bound is a double, so a whole number beyond 2**53 may be off by its last bits.
    A file without rows gives its columns with a null ``row_group``. The bounds of a
    double column do not tell of NaN.
    """
    ship(spark)
    files = layout.listing(spark, path).where(F.col("path").rlike(r"/[^/_.][^/]*\.parquet$")).select("path")
    count = files.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.strip().split(" ")[0] for part in FOOTERS.split(",")]
        types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.float64()]
        for batch in batches:
            for file in batch.column(0).to_pylist():
                columns = list(zip(*_footer_rows(file))) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return files.repartition(max(count // FILES_PER_TASK, 1)).mapInArrow(read, FOOTERS)


def schema_history(footer: DataFrame) -> DataFrame:
    """``name, kind, place, files, rows``: which types a column has had, in how many files and rows."""
    per_file = footer.groupBy("file", "name", "kind").agg(F.min("place").alias("place"), F.sum("group_rows").alias("rows"))
    return per_file.groupBy("name", "kind").agg(
        F.min("place").alias("place"), F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")
    )


def wider(kinds: Sequence[str]) -> str | None:
    """The narrowest type that holds all of the types; None if there is none."""
    reach = [(k, *WIDER.get(k, ())) for k in sorted(set(kinds))]
    common = [k for k in reach[0] if all(k in other for other in reach)]
    # a chain is in order, so what stands first in one stands first in all that hold it
    return common[0] if common else None


def widened_schema(footer: DataFrame, wanted: T.StructType | None = None) -> T.StructType:
    """One schema that holds every version; columns in the order of their first place, then name.

    With ``wanted``, that schema is checked instead: a column whose files hold a
    type that does not fit into the wanted one is refused by name. What comes to the
    driver is a row per column and type, not per file.
    """
    kinds: dict[str, list[str]] = {}
    history = schema_history(footer).orderBy("place", "name", "kind").collect()
    for row in history:
        kinds.setdefault(row["name"], []).append(row["kind"])
    folded: dict[str, str] = {}
    for name in kinds:
        other = folded.setdefault(name.lower(), name)
        if other != name:
            raise Narrowing(f"columns {other!r} and {name!r} differ only by case")
    if wanted is not None:
        for field in wanted.fields:
            target = field.dataType.simpleString()
            for kind in kinds.get(folded.get(field.name.lower(), ""), []):
                if target != kind and target not in WIDER.get(kind, ()):
                    raise Narrowing(f"column {field.name!r} is {kind} in some files and does not fit into {target}")
        return wanted
    fields = []
    for name, found in kinds.items():
        kind = wider(found)
        if kind is None:
            raise Narrowing(f"column {name!r} is {' and '.join(found)} in different files; no type holds both")
        fields.append(T.StructField(name, T._parse_datatype_string(kind)))
    return T.StructType(fields)


def read_versions(spark: SparkSession, path: str, wanted: T.StructType | None = None) -> DataFrame:
    """All files of all schema versions in one scan; a column that a file lacks is missing in its rows."""
    return spark.read.schema(widened_schema(footers(spark, path), wanted)).parquet(path)
