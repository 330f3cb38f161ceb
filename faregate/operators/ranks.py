"""Exact values at given ranks, first rows, slices and medians, without a global sort.

``orderBy().limit(k)`` brings k rows into one task, and an exact ``median``
keeps every distinct value of a group in one task. Both grow with the data.
Here approximate quantiles, whose rank error is bounded, bracket the wanted
rank; the next pass looks only inside the bracket; a last pass counts what is
left and finds the exact value. Each round keeps about 0.2 % of a group's rows,
and there are as many rounds (none for a small table) as the row count needs to
leave at most ``RANKED_ROWS`` of them; all else is counted inside the scan's own tasks. The
sketches of all groups are merged in ``SLOTS`` tasks, a large group's in many.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate.operators.joins import BROADCAST_ROWS, attach_per_group

ACCURACY = 10_000  # a sketch of m rows is off by at most m / ACCURACY ranks
SLOTS = 256  # tasks that merge sketches, shared out among the groups
FEW_GROUPS = 1_000  # up to here each group gets the fine grid of quantiles
FINE_GRID, COARSE_GRID = 1_000, 50
RANKED_ROWS = 1_000_000  # at most this many rows are ranked in one task
MISSED = "rank bracket missed its value"
_FORCED_ROUNDS: int | None = None  # set by tests

RankOf = Callable[[Column], Column]


def _whole(rank: RankOf) -> RankOf:
    return lambda n: F.floor(rank(n)).cast("bigint")


def _rounds_for(rows: int, grid: int) -> int:
    kept = 2.5 / grid  # two quantile steps and the sketch error on both sides
    rounds, left = 0, float(rows)
    while left > RANKED_ROWS:
        rounds, left = rounds + 1, left * kept
    return rounds


def _points(entries: DataFrame, keys: Sequence[str], grid: int, slots: int, slack: int = 1) -> DataFrame:
    """Quantile points of each group with bounds on their ranks.

    A null value stands for a row below the group's bracket: it counts, and
    has no quantile. ``reached`` is the number of rows the points up to this
    one stand for; between ``reached - off`` and ``reached + off + step`` rows
    are smaller than the point or equal to it.
    """
    v = F.col("__v")
    # As SQL text: a thousand literals are parsed at once instead of made one by one.
    quantiles = ", ".join(f"{i / grid}D" for i in range(1, grid + 1))
    sketch = F.expr(f"percentile_approx(__v, array({quantiles}), {ACCURACY})")
    sketches = (
        entries.withColumn("__slot", F.pmod(F.spark_partition_id(), F.lit(slots)))
        .groupBy(*keys, "__slot")
        .agg(
            F.any_value("n").alias("n"),
            F.count_if(v.isNull()).alias("below"),
            F.count(v).alias("m"),
            F.min(v).alias("low"),
            F.max(v).alias("high"),
            sketch.alias("grid"),
        )
    )
    group = Window.partitionBy(*keys)
    inside = F.sum("m").over(group)
    summed = sketches.select(
        *keys,
        F.coalesce(F.max("n").over(group), inside).alias("n"),
        F.sum("below").over(group).alias("below"),
        F.min("low").over(group).alias("low"),
        F.max("high").over(group).alias("high"),
        (inside / grid).alias("step"),
        ((inside / ACCURACY + F.count(F.lit(1)).over(group) + 1) * slack).alias("off"),
        (F.col("m") / grid).alias("weight"),
        "grid",
    )
    points = summed.withColumn("point", F.explode_outer("grid")).drop("grid")
    upto = Window.partitionBy(*keys).orderBy("point")
    return points.withColumn("reached", F.sum("weight").over(upto))


def _bracket(mine: Column, first: Column, last: Column, dtype: T.DataType) -> Column:
    """The tightest points that surely hold the values at two ranks between them."""
    point, reached, off = F.col("point"), F.col("reached"), F.col("off")
    low, high = F.min(F.when(mine, F.col("low"))), F.max(F.when(mine, F.col("high")))
    under = F.max(F.when(mine & (reached + off + F.col("step") <= first), point))
    over = F.min(F.when(mine & (reached - off > last), point))
    lo, hi = F.coalesce(under, low), F.coalesce(over, high)
    if isinstance(dtype, (T.LongType, T.DecimalType)):
        # The sketch keeps doubles; widen by what a large integer may lose on the way.
        lo, hi = F.greatest(low, lo - _lost(lo)), F.least(high, hi + _lost(hi))
    return F.struct(lo.cast(dtype).alias("lo"), hi.cast(dtype).alias("hi"))


def _lost(value: Column) -> Column:
    return F.ceil(F.abs(value.cast("double")) / F.lit(float(1 << 51))).cast("bigint")


def _ranked_at_once(
    rows: DataFrame, by: list[str], targets: dict[str, list[RankOf]], dtype: T.DataType
) -> DataFrame:
    """The same for a table of few enough rows: distinct values are counted, then ranked."""
    group = Window.partitionBy(*by)
    counted = rows.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__c"))
    reached = counted.withColumn("__cum", F.sum("__c").over(group.orderBy("__v")))
    reached = reached.withColumn("n", F.sum("__c").over(group))
    n, found = F.col("n"), []
    for name, ranks in targets.items():
        values = [F.min(F.when((F.col("__cum") > rank(n)) & (rank(n) >= 0), F.col("__v"))) for rank in ranks]
        found.append(F.array(*values).cast(T.ArrayType(dtype)).alias(name))
    return reached.groupBy(*by).agg(F.max("n").alias("n"), *found)


def values_at_ranks(
    df: DataFrame,
    value: str,
    targets: dict[str, Sequence[RankOf]],
    by: Sequence[str] = (),
    rounds: int | None = None,
    slack: int = 1,
    total: int | None = None,
) -> DataFrame:
    """Per group: ``n`` and, for each target, the exact values at its ranks.

    A target is a list of functions from the group's row count to a 0-based
    rank; the ranks of one target lie close together, in rising order (a median
    needs two neighbours). Its column is an array with one value per rank, null
    where the rank lies outside the group. Nulls in ``value`` do not count.
    ``slack`` widens the brackets; ``total`` is the table's row count, if known.
    """
    _checked_kind(df, value)
    by = list(by)
    targets = {name: [_whole(rank) for rank in ranks] for name, ranks in targets.items()}
    dtype = df.schema[value].dataType
    rows = df.select(*by, F.col(value).alias("__v")).where(F.col("__v").isNotNull())
    if rounds is None and (total := df.count() if total is None else total) <= RANKED_ROWS:
        rounds = 0
    if rounds == 0:
        return _ranked_at_once(rows, by, targets, dtype)
    groups = rows.select(*by).distinct().limit(BROADCAST_ROWS + 1).count() if by else 1
    few = groups <= BROADCAST_ROWS
    fine = groups <= FEW_GROUPS
    shape = (FINE_GRID, max(1, SLOTS // max(groups, 1))) if fine else (COARSE_GRID, 1)
    if rounds is None:
        rounds = _rounds_for(total, shape[0])
    v, n = F.col("__v"), F.col("n")

    def entries(brackets: DataFrame) -> DataFrame:
        """Per target the rows up to its bracket; below the bracket the value is null."""
        near = attach_per_group(rows, brackets, "__b", by, few)
        per_target = [
            F.when(
                v <= F.col(f"__b.{name}.hi"),
                F.struct(
                    F.lit(name).alias("target"),
                    F.when(v >= F.col(f"__b.{name}.lo"), v).alias("v"),
                ),
            )
            for name in targets
        ]
        return (
            near.select(*by, F.col("__b.n").alias("n"), F.explode(F.array(*per_target)).alias("e"))
            .where(F.col("e").isNotNull())
            .select(*by, "n", F.col("e.target").alias("__t"), F.col("e.v").alias("__v"))
        )

    def brackets_from(points: DataFrame, per_target: bool) -> DataFrame:
        found = []
        for name, ranks in targets.items():
            mine = (F.col("__t") == name) if per_target else F.lit(True)
            first, last = ranks[0](n) - F.col("below"), ranks[-1](n) - F.col("below")
            found.append(_bracket(mine, first, last, dtype).alias(name))
        return points.groupBy(*by).agg(F.struct(F.max("n").alias("n"), *found).alias("__b"))

    # one set of points serves all targets at first; later each has its own
    everything = rows.withColumn("n", F.lit(None).cast("bigint"))
    brackets = brackets_from(_points(everything, by, *shape, slack), per_target=False)
    for _ in range(rounds - 1):
        brackets = brackets_from(_points(entries(brackets), [*by, "__t"], *shape, slack), per_target=True)

    running = Window.partitionBy(*by, "__t").orderBy(v.asc_nulls_first())
    reached = (
        entries(brackets)
        .groupBy(*by, "__t", "__v")
        .agg(F.any_value("n").alias("n"), F.count(F.lit(1)).alias("__c"))
        .withColumn("__cum", F.sum("__c").over(running))
    )

    def picked(name: str, rank: RankOf) -> Column:
        mine = F.col("__t") == name
        hit = F.min(F.when(mine & (F.col("__cum") > rank(n)), v))
        before = F.coalesce(F.max(F.when(mine & v.isNull(), F.col("__cum"))), F.lit(0))
        return F.struct(hit.alias("hit"), before.alias("before"))

    def checked(name: str, i: int, rank: RankOf) -> Column:
        r, found = rank(n), F.col(f"__{name}_{i}")
        return (
            F.when(n.isNull() | r.isNull() | (r < 0) | (r >= n), F.lit(None).cast(dtype))
            .when((found["before"] <= r) & found["hit"].isNotNull(), found["hit"])
            .otherwise(F.raise_error(F.lit(MISSED)).cast(dtype))
        )

    return (
        reached.groupBy(*by)
        .agg(
            F.max("n").alias("n"),
            *[
                picked(name, rank).alias(f"__{name}_{i}")
                for name, ranks in targets.items()
                for i, rank in enumerate(ranks)
            ],
        )
        .select(
            *by,
            "n",
            *[
                F.array(*[checked(name, i, rank) for i, rank in enumerate(ranks)]).alias(name)
                for name, ranks in targets.items()
            ],
        )
    )


def median_by(df: DataFrame, value: str, by: Sequence[str] = (), rounds: int | None = None) -> DataFrame:
    """Per group: ``n`` and the exact median, the mean of the two middle values."""
    middle = [lambda n: F.floor((n - 1) / 2), lambda n: F.floor(n / 2)]
    found = values_at_ranks(df, value, {"middle": middle}, by, rounds)
    return found.select(
        *by, "n", ((F.col("middle")[0] + F.col("middle")[1]) / 2).alias("median")
    )


def _checked_kind(df: DataFrame, key: str) -> T.DataType:
    kind = df.schema[key].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{key} is {kind.simpleString()}; ranks need a key of numbers or times")
    return kind


def keys_at_ranks(df: DataFrame, key: str, ranks: Sequence[RankOf], total: int | None = None) -> list[Column]:
    """The exact keys at some ranks of the whole table, as constants.

    The keys are looked up now, and only they come back. As constants they are
    found once however often the result is used, and a filter on them reaches
    the file reader. A rank outside the table gives a null. Should a bracket
    miss its value, the search is repeated with brackets sixteen times as wide.
    """
    kind = _checked_kind(df, key)
    targets = {f"at{i}": [rank] for i, rank in enumerate(ranks)}
    as_text = isinstance(kind, T.DatetimeType)  # exact, whatever the zone of this process
    slack = 1
    while True:
        found = values_at_ranks(df, key, targets, rounds=_FORCED_ROUNDS, slack=slack, total=total)
        values = [F.col(name)[0].cast("string") if as_text else F.col(name)[0] for name in targets]
        try:
            row = found.select(*[v.alias(name) for v, name in zip(values, targets)]).first()
            break
        except Exception as error:
            if MISSED not in str(error) or slack > ACCURACY:
                raise
            slack *= 16
    return [F.lit(value).cast(kind) for value in (row or [None] * len(ranks))]


def first_rows(df: DataFrame, key: str, rows: int | RankOf) -> DataFrame:
    """The rows whose key is at most the key at rank ``rows - 1``, at every size alike.

    The key is of numbers or times. With a unique key these are exactly ``rows``
    rows; rows that tie with the last key all belong to them, rows without a key
    never do. The result is a narrow scan whose filter reaches the file.
    """
    wanted = (lambda n: F.lit(rows)) if isinstance(rows, int) else rows
    (limit,) = keys_at_ranks(df, key, [lambda n: F.least(wanted(n), n) - 1])
    return df.where(F.col(key) <= limit)


def slice_rows(df: DataFrame, key: str, start: int | RankOf, stop: int | RankOf) -> DataFrame:
    """Rows ``start`` (included) to ``stop`` (excluded) in the order of a key, as ``first_rows`` counts them.

    Ties: rows with the key at rank ``start`` or at rank ``stop - 1`` all belong.
    """
    begin = (lambda n: F.lit(start)) if isinstance(start, int) else start
    end = (lambda n: F.lit(stop)) if isinstance(stop, int) else stop
    lowest, highest = keys_at_ranks(df, key, [begin, lambda n: F.least(end(n), n) - 1])
    if isinstance(start, int) and isinstance(stop, int) and stop <= start:
        return df.where(F.lit(False))
    return df.where((F.col(key) >= lowest) & (F.col(key) <= highest))
