"""Build every table layout from a raw trip file and a zone lookup.

The curated table is written once and read back for each layout: later steps
scan it instead of repeating the joins, and a lost executor costs a re-read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregate import schemas
from faregate.operators import (
    curate,
    defects,
    fingerprint,
    gates,
    layout,
    normalise,
    ranks,
    replicate,
    sampling,
    shares,
)
from faregate.operators.defects import DirtyColumns
from faregate.sources import tables

ROW_ID = "row_id"
DIRTY = DirtyColumns(key=ROW_ID)
DOMINANCE_FLOOR = 0.5  # fixed value: below this share the skew lessons do not work
MIN_CURATED_COLUMNS = 30  # fixed value: fewer columns make column pruning pointless


@dataclass(frozen=True)
class Profile:
    """How large each layout is made; None takes every row (the dirty table the first half)."""

    csv_bytes: int | None
    slice_rows: int | None
    format_rows: int | None
    small_files: int
    skewed_rows: int | None
    dirty_rows: int | None


# The three build sizes; ``whole`` has none.
PROFILES = {
    "whole": Profile(None, None, None, 10_000, None, None),
    "full": Profile(2_200_000_000, 2_000_000, 1_000_000, 10_000, 10_000_000, 1_500_000),
    "small": Profile(220_000_000, 200_000, 100_000, 1_000, 1_000_000, 150_000),
    "tiny": Profile(12_000_000, 20_000, 10_000, 100, 50_000, 15_000),
}

# What a complete build consists of.
EXPECTED_PATHS = (
    "zones/taxi_zone_lookup.csv",
    "s1/trips_big.csv",
    "shared/trips_slice.parquet",
    "shared/trips_slice.csv",
    "s6/trips.csv",
    "s6/trips.json",
    "s6/trips.parquet",
    "s6/trips_flat.parquet",
    "s6/trips_partitioned",
    "s6/trips_smallfiles",
    "s7/trips_skewed",
    "s7/zones.parquet",
    "s8/trips_dirty.parquet",
    "s8/defect_manifest.json",
    "s8/trips_day2.parquet",
)


def load_zones(spark: SparkSession, path: str | None) -> DataFrame:
    """The zone lookup, or the fallback lookup where none (or a broken one) is given."""
    if path:
        try:
            return normalise.check_dimension(tables.read_foreign_csv(spark, path, schemas.ZONE_SCHEMA))
        except (PySparkException, normalise.ShapeError) as error:
            # a missing file, an HTML page named .csv, a file cut short
            print(f"zone lookup {path} not usable ({str(error)[:200]}); using the fallback")
    return sampling.fallback_zones(spark)


def load_trips(spark: SparkSession, path: str) -> DataFrame:
    """A raw trip file on the fixed schema."""
    return normalise.normalise(tables.read_parquet(spark, path))


def curated_table(trips: DataFrame, zones: DataFrame, path: str) -> DataFrame:
    """Write the curated table with a unique row id, and read it back.

    The id is given once, while writing; every later step sees the same ids.
    """
    wide = curate.curate(trips.withColumn(ROW_ID, F.monotonically_increasing_id()), zones)
    layout.write_parquet(wide, path)
    return trips.sparkSession.read.parquet(path)


def is_built(spark: SparkSession, out: str, profile: Profile | None = None) -> bool:
    """Whether a build is finished; with a profile, whether it was built to that one."""
    try:
        rows = spark.read.json(f"{out}/manifest")
        if profile is not None:
            rows = rows.where((F.col("metric") == "profile") & (F.col("detail") == repr(profile)))
        return rows.limit(1).count() == 1
    except AnalysisException:  # the folder is not there
        return False


def missing_paths(spark: SparkSession, out: str) -> DataFrame:
    """Expected paths of a build below which no file lies."""
    expected = spark.createDataFrame([(p,) for p in EXPECTED_PATHS], "path string")
    below = F.regexp_extract("path", "/([^/]+/[^/]+)/[^/]+$", 1)
    nested = F.regexp_extract("path", "/([^/]+/[^/]+)/[^/]+=[^/]+/[^/]+$", 1)
    present = layout.listing(spark, out).select(
        F.when(nested != "", nested).otherwise(below).alias("path")
    )
    return layout.missing_artifacts(expected, present.distinct(), "path")


def build(
    spark: SparkSession,
    out: str,
    trips: DataFrame,
    zones: DataFrame,
    profile: str | Profile = "whole",
    force: bool = False,
) -> DataFrame:
    """Write all layouts below ``out`` and return the manifest.

    A finished build of the same profile is left alone unless ``force`` is set.
    """
    size = PROFILES[profile] if isinstance(profile, str) else profile
    if not force and is_built(spark, out, size):
        return spark.read.json(f"{out}/manifest")
    began = time.monotonic()

    layout.write_csv(zones, f"{out}/zones/taxi_zone_lookup.csv")
    wide = curated_table(trips, zones, f"{out}/curated")
    columns = [name for name in wide.columns if name != ROW_ID]

    def head(rows: int | None) -> DataFrame:
        return wide if rows is None else ranks.first_rows(wide, ROW_ID, rows)

    big = wide if size.csv_bytes is None else replicate.replicate_to_csv_bytes(wide, ROW_ID, size.csv_bytes)
    layout.write_csv(big.select(*columns), f"{out}/s1/trips_big.csv")

    shared = head(size.slice_rows).select(*columns)
    layout.write_parquet(shared, f"{out}/shared/trips_slice.parquet")
    layout.write_csv(shared, f"{out}/shared/trips_slice.csv")

    base = head(size.format_rows).select(*columns)
    layout.write_parquet(base, f"{out}/s6/trips.parquet")
    base = tables.read_parquet(spark, f"{out}/s6/trips.parquet")
    layout.write_csv(base, f"{out}/s6/trips.csv")
    layout.write_ndjson(base, f"{out}/s6/trips.json")
    layout.write_parquet(base, f"{out}/s6/trips_flat.parquet")
    layout.write_partitioned(base, f"{out}/s6/trips_partitioned", "pickup_date")
    layout.write_small_files(base, f"{out}/s6/trips_smallfiles", size.small_files)

    skewed = wide if size.skewed_rows is None else replicate.replicate_rows(wide, ROW_ID, size.skewed_rows)
    layout.write_partitioned(skewed.select(*columns), f"{out}/s7/trips_skewed", "pickup_day")
    layout.write_parquet(zones, f"{out}/s7/zones.parquet")

    dirty_rows = (lambda n: F.floor(n / 2)) if size.dirty_rows is None else (lambda n: F.lit(size.dirty_rows))
    clean = ranks.first_rows(wide, ROW_ID, dirty_rows)
    dirty = defects.inject_defects(clean, DIRTY).drop(ROW_ID)
    layout.write_parquet(dirty, f"{out}/s8/trips_dirty.parquet")
    dirty = tables.read_parquet(spark, f"{out}/s8/trips_dirty.parquet")
    layout.write_manifest(gates.manifest(clean, dirty, DIRTY), f"{out}/s8/defect_manifest.json")
    next_day = ranks.slice_rows(wide, ROW_ID, dirty_rows, lambda n: 2 * dirty_rows(n))
    layout.write_parquet(
        defects.second_day(next_day.select(*columns)), f"{out}/s8/trips_day2.parquet"
    )

    facts = manifest_rows(spark, wide, out, len(columns), time.monotonic() - began, size)
    layout.write_manifest(facts, f"{out}/manifest")
    return spark.read.json(f"{out}/manifest")


def manifest_rows(
    spark: SparkSession, wide: DataFrame, out: str, columns: int, seconds: float, profile: Profile
) -> DataFrame:
    """``metric, value, detail`` rows about a finished build."""
    top = shares.dominant_key(wide, "pickup_borough", DOMINANCE_FLOOR)
    shared = tables.read_parquet(spark, f"{out}/shared/trips_slice.parquet")
    size = layout.listing(spark, out).agg(F.sum("length").cast("double").alias("value"))
    none = F.lit(None).cast("string")
    rows = [
        top.select(
            F.lit("dominant_key_share").alias("metric"),
            F.round("share", 4).alias("value"),
            F.col("pickup_borough").alias("detail"),
        ),
        top.select(
            F.lit("dominance_ok").alias("metric"),
            F.col("dominates").cast("double").alias("value"),
            none.alias("detail"),
        ),
        fingerprint.short_fingerprint(shared).select(
            F.lit("fingerprint").alias("metric"),
            F.lit(None).cast("double").alias("value"),
            F.col("fingerprint").alias("detail"),
        ),
        wide.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("curated_rows").alias("metric"), "value", none.alias("detail")
        ),
        size.select(F.lit("total_bytes").alias("metric"), "value", none.alias("detail")),
        spark.createDataFrame(
            [
                ("curated_columns", float(columns), None),
                ("curated_columns_ok", float(columns >= MIN_CURATED_COLUMNS), None),
                ("build_seconds", round(seconds, 1), None),
                ("profile", None, repr(profile)),
            ],
            "metric string, value double, detail string",
        ),
    ]
    return replicate.union_versions(*rows)
