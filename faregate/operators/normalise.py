"""Schema normalisation: names, defaults, projection, shape gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate import schemas


class ShapeError(ValueError):
    """The input does not have the columns or rows the operator needs."""


def canonical_names(df: DataFrame, schema: T.StructType) -> dict[str, str]:
    """Map each schema column present in ``df`` to its actual spelling."""
    actual: dict[str, str] = {}
    for name in df.columns:
        folded = name.lower()
        if folded in actual:
            raise ShapeError(f"columns {actual[folded]!r} and {name!r} differ only by case")
        actual[folded] = name
    return {f.name: actual[f.name.lower()] for f in schema.fields if f.name.lower() in actual}


def normalise(
    df: DataFrame,
    schema: T.StructType = schemas.TRIP_SCHEMA,
    required: tuple[str, ...] = schemas.TRIP_REQUIRED,
    defaults: dict[str, object] = schemas.TRIP_DEFAULTS,
) -> DataFrame:
    """Fit a drifting input to a fixed schema.

    Names match in any case, absent optional columns get typed defaults,
    unknown columns are dropped. One projection, so unused columns of the file
    are never read.
    """
    found = canonical_names(df, schema)
    missing = [name for name in required if name not in found]
    if missing:
        raise ShapeError(f"required columns {missing} are missing; got {df.columns}")
    return df.select(
        *[
            (
                F.col(f"`{found[f.name]}`")
                if f.name in found
                else F.lit(defaults.get(f.name, 0.0))
            )
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def dimension_report(dim: DataFrame, name: str, key: str, more_than: int = 100) -> DataFrame:
    """One row on whether a lookup may be joined: enough rows, every key set and none twice.

    A key that occurs twice would multiply the rows it is joined to.
    """
    per_key = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(key).alias("key_count"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("missing_keys"),
        F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("repeated_keys"),
    )
    fit = (F.col("row_count") > more_than) & (F.col("missing_keys") == 0) & (F.col("repeated_keys") == 0)
    return counted.select(F.lit(name).alias("dimension"), "*", fit.alias("accepted"))


def check_dimension(
    zones: DataFrame,
    needed: tuple[str, ...] = ("LocationID", "Borough"),
    more_than: int = 100,
) -> DataFrame:
    """Reject a lookup that lacks its key columns or is too short to be real."""
    absent = [name for name in needed if name not in zones.columns]
    if absent:
        raise ShapeError(f"lookup has no {absent}; got {zones.columns[:4]}")
    if zones.limit(more_than + 1).count() <= more_than:
        raise ShapeError(f"lookup has no more than {more_than} rows")
    report = dimension_report(zones, "lookup", needed[0], more_than).first()
    if not report["accepted"]:
        raise ShapeError(f"lookup keys are missing or repeated: {report.asDict()}")
    return zones
