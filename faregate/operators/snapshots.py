"""Tables of immutable Parquet files under a versioned list of them.

A version is a list (a small Parquet table) of the files that make it up. Writers add
files beside the old ones, then a new list, and at last the version's name: one small
text file that is moved into place and never replaced. Until that move readers see the
version before, and a writer that fails leaves files that no list names. Of two writers
of one version the second one's move fails, and nothing it did is seen.

A delivery has a name. A version says which delivery made it, so a delivery that is
run again after it was committed does nothing, and one that failed is simply run again.

``merge`` is a copy-on-write merge by key: files without a key that the delivery
touches are kept as they are. ``compact`` rewrites only files below a size, packed into
bins, and keeps all others.

A table may be cut by one column (``by``, such as a day); each file then holds rows of
one value, and a merge looks only at files of the values that the delivery has, so
the key of such a table has to include that column.

Layout below ``root``: ``data`` the files, ``lists`` one folder per list, ``versions``
one file per version. Files that no version names are left for the caller to remove.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate.operators.joins import broadcast_if_small
from faregate.operators.layout import written

COMMIT, PART = "__commit", "__part"  # folders below data; columns of neither name may be in a table
LIST = "file string, bytes bigint, rows bigint, part string, stamp timestamp"


class VersionTaken(RuntimeError):
    """Another writer committed this version first."""


# ---------------------------------------------------------------- versions


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[dict]:
    """What each version's file says, oldest first; one short line each."""
    _, at, fs = _hadoop(spark, f"{root}/versions")
    if not fs.exists(at):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().isdigit())
    if not names:
        return []
    rows = spark.read.schema("version int, list string, kind string, delivery string, schema string").json([f"{root}/versions/{n}" for n in names])
    return sorted((r.asDict() for r in rows.collect()), key=lambda v: v["version"])


def _commit(spark: SparkSession, root: str, after: int, list_id: str, kind: str, delivery: str | None, schema: str) -> int:
    """Move the version's file into place; an existing one is never replaced."""
    number = after + 1
    said = json.dumps({"version": number, "list": list_id, "kind": kind, "delivery": delivery, "schema": schema}) + "\n"
    jvm, target, fs = _hadoop(spark, f"{root}/versions/{number:010d}")
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(f"{root}/versions/_{list_id}")
    stream = fs.create(draft, False)
    stream.write(bytearray(said.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    if fs.exists(target):
        raise VersionTaken(f"version {number} of {root} is there already")
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(target), never)
    except Exception as error:
        if fs.exists(target):
            raise VersionTaken(f"version {number} of {root} is there already") from error
        raise
    return number


def _at(spark: SparkSession, root: str, version: int | None) -> dict:
    known = versions(spark, root)
    found = [v for v in known if version is None or v["version"] == version]
    if not found:
        raise ValueError(f"{root} has no version {'' if version is None else version}")
    return found[-1]


def files(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """``file, bytes, rows, part, stamp`` of a version; ``file`` is relative to ``root``."""
    return spark.read.schema(LIST).parquet(f"{root}/lists/{_at(spark, root, version)['list']}")


# ---------------------------------------------------------------- files


def add_files(df: DataFrame, root: str, by: str | None) -> str:
    """Write rows as new files; the name of their folder."""
    clash = {COMMIT, PART} & set(df.columns)
    if clash:
        raise ValueError(f"columns that a table cannot have: {sorted(clash)}")
    commit = uuid.uuid4().hex
    if by is None:
        df.write.option("compression", "snappy").parquet(f"{root}/data/{COMMIT}={commit}")
    else:
        cut = df.withColumn(PART, F.col(f"`{by}`").cast("string"))
        cut.write.option("compression", "snappy").partitionBy(PART).parquet(f"{root}/data/{COMMIT}={commit}")
    return commit


def _below(root: str, path: Column) -> Column:
    """A file's path below ``root/data``, however the scheme is written."""
    return F.regexp_extract(path, f"/(data/{COMMIT}=.*)$", 1)


def _new_files(spark: SparkSession, root: str, commit: str, schema: T.StructType) -> DataFrame:
    """The list of what one writer added."""
    folder = f"{root}/data/{COMMIT}={commit}"
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
        .select(_below(root, F.col("path")).alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("stamp"))
    )
    counted = (
        spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)
        .groupBy(_below(root, F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))).alias("of"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    coded = F.regexp_extract("file", f"/{PART}=([^/]*)/", 1)
    value = F.when((coded != "") & (coded != "__HIVE_DEFAULT_PARTITION__"), F.url_decode(F.replace(coded, F.lit("+"), F.lit("%2B"))))
    with_rows = listed.join(counted, F.col("file") == F.col("of"))  # files without rows are none of the table's
    return with_rows.select("file", "bytes", "rows", value.alias("part"), "stamp")


def _list_and_commit(
    spark: SparkSession, root: str, after: int, kept: DataFrame | None, commit: str, kind: str, delivery: str | None, schema: T.StructType
) -> int:
    new = _new_files(spark, root, commit, schema)
    entries = new if kept is None else kept.unionByName(new)
    list_id = uuid.uuid4().hex
    entries.coalesce(1).write.parquet(f"{root}/lists/{list_id}")  # a line per file of the table
    return _commit(spark, root, after, list_id, kind, delivery, schema.json())


def _rows_of(spark: SparkSession, root: str, entries: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of listed files, with ``_metadata``; their names go through the driver, as for any scan."""
    names = [f"{root}/{r['file']}" for r in entries.select("file").collect()]
    if not names:  # a folder without a file that the table could have
        return spark.read.schema(schema).option("pathGlobFilter", "no file").parquet(f"{root}/lists")
    # no discovery of folder values: the columns are all in the files
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*names)


# ---------------------------------------------------------------- operations


def create(df: DataFrame, root: str, by: str | None = None, delivery: str | None = None) -> int:
    """The first version of a table."""
    spark = df.sparkSession
    if versions(spark, root):
        raise VersionTaken(f"{root} is a table already")
    spread = df if by is None else df.hint("rebalance", F.col(f"`{by}`"))
    return _list_and_commit(spark, root, 0, None, add_files(spread, root, by), "create", delivery, df.schema)


def read(spark: SparkSession, root: str, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
    """The rows of a version, or only those of some values of the column it is cut by."""
    entries, schema = files(spark, root, version), T.StructType.fromJson(json.loads(_at(spark, root, version)["schema"]))
    if parts is not None:
        entries = entries.where(F.col("part").isin(*parts))
    return _rows_of(spark, root, entries, schema)


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])


def last_changes(changes: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """One change per key as ``k0, k1, ..., change``: the last by ``order``; of equal ones always the same."""
    plain = [f.name for f in changes.schema if "map<" not in f.dataType.simpleString()]
    rank = F.struct(*([F.col(f"`{order}`")] if order else []), F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    row = F.struct(*[F.col(f"`{c}`") for c in changes.columns])
    named = changes.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], row.alias("row"), rank.alias("rank"))
    return named.groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.max_by("row", "rank").alias("change"))


def merge(
    changes: DataFrame,
    root: str,
    keys: Sequence[str],
    delivery: str,
    deleted: str | None = None,
    order: str | None = None,
    by: str | None = None,
) -> int:
    """Insert, update or delete by key; the version that holds the delivery.

    ``changes`` has the table's columns and, optionally, ``deleted`` (boolean: remove
    this key) and ``order`` (of several changes of one key the last one counts). A
    missing key equals a missing one. A key that the table holds several times is
    updated in each of its rows.
    """
    spark = changes.sparkSession
    known = versions(spark, root)
    done = [v["version"] for v in known if v["delivery"] == delivery]
    if done:
        return done[0]
    if by is not None and by not in keys:
        raise ValueError(f"the key of a table cut by {by!r} has to include it")
    current = known[-1]["version"]
    listed = files(spark, root, current)
    changes = last_changes(changes, keys, order)
    changes = broadcast_if_small(written(changes))
    fields = [F.col(f"k{i}") for i in range(len(keys))]

    looked_at = listed
    schema = T.StructType.fromJson(json.loads(known[-1]["schema"]))
    if by is not None:  # only files of the delivery's days
        days = changes.select(F.col(f"k{list(keys).index(by)}").cast("string").alias("day")).distinct()
        looked_at = listed.join(broadcast_if_small(written(days)), F.col("part").eqNullSafe(F.col("day")), "left_semi")
    rows = _rows_of(spark, root, looked_at, schema)
    own = [F.col(f"`{k}`") for k in keys]
    path = _below(root, F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))))

    # which files hold a key of the delivery, and which keys they are: only key columns are read
    hits = written(
        rows.select(path.alias("file"), *own).join(changes.select(*fields), _same(own, fields))
        .select("file", *fields).distinct()
    )
    touched = written(hits.select("file").distinct())
    untouched = listed.join(broadcast_if_small(touched), "file", "left_anti")

    gone = F.coalesce(F.col("change")[deleted], F.lit(False)) if deleted else F.lit(False)
    mine = F.struct(*[F.col(f"`{c}`") for c in schema.names])
    theirs = F.struct(*[F.col("change")[c].cast(schema[c].dataType).alias(c) for c in schema.names])
    rewritten = (
        _rows_of(spark, root, touched, schema).select(mine.alias("mine"), *[F.col(f"`{k}`").alias(f"m{i}") for i, k in enumerate(keys)])
        .join(changes, _same([F.col(f"m{i}") for i in range(len(keys))], fields), "left")
        .where(F.col("change").isNull() | ~gone)
        .select(F.when(F.col("change").isNull(), F.col("mine")).otherwise(theirs).alias("row"))
    )
    met = hits.select(*[F.col(f"k{i}").alias(f"h{i}") for i in range(len(keys))]).distinct()
    inserted = (
        changes.where(~gone)
        .join(met, _same(fields, [F.col(f"h{i}") for i in range(len(keys))]), "left_anti")
        .select(theirs.alias("row"))
    )
    out = rewritten.unionByName(inserted).select("row.*")
    spread = out if by is None else out.hint("rebalance", F.col(f"`{by}`"))
    return _list_and_commit(spark, root, current, untouched, add_files(spread, root, by), "merge", delivery, schema)


def bins(entries: DataFrame, file_bytes: int, small_bytes: int) -> DataFrame:
    """``file, part, bin`` of files below ``small_bytes``, packed by part into bins of about ``file_bytes``.

    Bins of a single file are left out: rewriting them gains nothing.
    """
    line = Window.partitionBy("part").orderBy("bytes", "file")
    ahead = F.coalesce(F.sum("bytes").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    binned = entries.where(F.col("bytes") < small_bytes).select("file", "part", F.floor(ahead / file_bytes).alias("bin"))
    shared = F.count(F.lit(1)).over(Window.partitionBy("part", "bin"))
    return binned.withColumn("together", shared).where("together > 1").drop("together")


def compact(spark: SparkSession, root: str, file_bytes: int = 256 << 20, small_bytes: int | None = None, by: str | None = None) -> int:
    """Rewrite undersized files only, each bin as one file; the version that results (the present one if none is)."""
    last = _at(spark, root, None)
    current, schema = last["version"], T.StructType.fromJson(json.loads(last["schema"]))
    listed = files(spark, root, current)
    small = written(bins(listed, file_bytes, small_bytes or file_bytes // 2))
    count = small.select("part", "bin").distinct().count()
    if not count:
        return current
    path = _below(root, F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))))
    mine = F.struct(*[F.col(f"`{c}`") for c in schema.names])
    placed = small.select("file", F.xxhash64("part", "bin").alias("bin"))
    rows = (
        _rows_of(spark, root, small, schema).select(path.alias("file"), mine.alias("row"))
        .join(broadcast_if_small(placed), "file")
        .repartition(count, "bin")
        .select("row.*")
    )
    kept = listed.join(broadcast_if_small(small.select("file")), "file", "left_anti")
    return _list_and_commit(spark, root, current, kept, add_files(rows, root, by), "compact", None, schema)
