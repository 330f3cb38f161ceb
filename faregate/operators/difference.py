"""Which rows differ between two tables, without joining them.

Every row has a number of 128 bits. Three cells of a fixed number of cells take it in: each
keeps the signed count of its rows (one table adds, the other takes away) and the signed
sums of the numbers' parts and of a check on them. Equal rows cancel out, whatever their
order, files or partitions, and cells of several tasks simply add up, so all that is
shuffled is cells.

A cell that holds one differing row gives its number back: the sums divided by the count,
if the check agrees. Taking that row out of its other two cells may leave another cell
with one row, and so on, until all cells are empty; with up to some two thirds as many
differing rows as cells nearly always all come out. Only cells that are not empty reach
the driver, at most ``cells``. If some stay, there are too many differences for the
cells, and the numbers alone (not the rows) are grouped instead: exact at any size.

The rows themselves are then picked from either table by number.

Rows are multisets, as in EXCEPT ALL: a row that one table has three times and the other
once differs ``times`` two. Missing equals missing, NaN equals NaN. Columns are matched by
name. Maps have no order and are refused, as EXCEPT refuses them.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate.operators.joins import broadcast_if_small
from faregate.operators.layout import written

TABLES = 3  # cells that take in a row
CELLS = 3 << 14
HALF = 1 << 32
PARTS = ("a", "b", "c", "d")


def _plain(name: str, kind: T.DataType) -> list[Column]:
    """What of a column is hashed: hashes pass over missing values, so a mark goes with each."""
    column = F.col(f"`{name}`")
    if "map<" in kind.simpleString():
        raise ValueError(f"column {name} holds maps")
    if isinstance(kind, (T.ArrayType, T.StructType)):
        column = F.to_json(F.struct(column), {"ignoreNullFields": "false"})
    return [F.isnull(f"`{name}`"), column]


def row_numbers(df: DataFrame) -> list[Column]:
    """Two hashes of 64 bits over all columns, in name order."""
    fields = [c for f in sorted(df.schema.fields, key=lambda f: f.name) for c in _plain(f.name, f.dataType)]
    return [F.xxhash64(F.lit(salt), *fields).alias(name) for salt, name in ((1, "h1"), (2, "h2"))]


def _text(*numbers: Column) -> Column:
    return F.concat_ws(":", *[n.cast("string") for n in numbers])


def signed_cells(left: DataFrame, right: DataFrame, cells: int = CELLS) -> DataFrame:
    """``cell, n`` and the sums of the parts and the check, for cells that are not empty."""
    own = cells // TABLES
    both = left.select(*row_numbers(left), F.lit(1).alias("sign")).unionByName(
        right.select(*row_numbers(right), F.lit(-1).alias("sign"))
    )
    text = _text(F.col("h1"), F.col("h2"))
    halves = {
        "a": F.shiftrightunsigned("h1", 32), "b": F.col("h1").bitwiseAND(HALF - 1),
        "c": F.shiftrightunsigned("h2", 32), "d": F.col("h2").bitwiseAND(HALF - 1),
        "x": F.crc32(text),
    }
    places = F.array(*[F.crc32(F.concat(F.lit(f"{t}:"), text)) % own + t * own for t in range(TABLES)])
    taken = both.select("sign", *[v.alias(k) for k, v in halves.items()], F.explode(places).alias("cell"))
    summed = taken.groupBy("cell").agg(
        F.sum("sign").alias("n"), *[F.sum(F.col("sign") * F.col(k)).alias(k) for k in halves]
    )
    filled = F.lit(False)
    for name in ("n", *halves):
        filled = filled | (F.col(name) != 0)
    return summed.where(filled)


def _single(cell: list[int]) -> tuple[int, int, int] | None:
    """The row of a cell that holds copies of one row only: its number's halves joined, and how often."""
    n, parts, check = cell[0], cell[1:5], cell[5]
    if not n or any(p % n for p in parts) or check % n:
        return None
    a, b, c, d = (p // n for p in parts)
    if not all(0 <= p < HALF for p in (a, b, c, d)):
        return None
    h1, h2 = (_signed(a << 32 | b), _signed(c << 32 | d))
    return (h1, h2, n) if check == n * zlib.crc32(f"{h1}:{h2}".encode()) else None


def _signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def take_out(table: dict[int, list[int]], cells: int = CELLS) -> tuple[list[tuple[int, int, int]], bool]:
    """The rows that come out of the cells, and whether that empties them all."""
    own, out, todo = cells // TABLES, [], list(table)
    while todo:
        at = todo.pop()
        if at not in table or (row := _single(table[at])) is None:
            continue
        h1, h2, n = row
        text = f"{h1}:{h2}"
        places = [zlib.crc32(f"{t}:{text}".encode()) % own + t * own for t in range(TABLES)]
        if at not in places:
            continue  # sums of several rows that look like one
        u, v = h1 % (1 << 64), h2 % (1 << 64)
        less = (1, u >> 32, u % HALF, v >> 32, v % HALF, zlib.crc32(text.encode()))
        out.append(row)
        for place in places:
            left = [x - n * y for x, y in zip(table.get(place, [0] * 6), less)]
            if any(left):
                table[place] = left
                todo.append(place)
            else:
                table.pop(place, None)
    return out, not table


def differing_numbers(left: DataFrame, right: DataFrame, cells: int = CELLS) -> DataFrame:
    """``h1, h2, n``: numbers of rows of which ``left`` has n more than ``right`` (fewer if below zero)."""
    filled = signed_cells(left, right, cells).select("cell", "n", *PARTS, "x").collect()  # at most ``cells``
    rows, complete = take_out({r[0]: list(r)[1:] for r in filled}, cells)
    if complete:
        return left.sparkSession.createDataFrame(rows, "h1 bigint, h2 bigint, n bigint")
    both = left.select(*row_numbers(left), F.lit(1).alias("sign")).unionByName(
        right.select(*row_numbers(right), F.lit(-1).alias("sign"))
    )
    return both.groupBy("h1", "h2").agg(F.sum("sign").alias("n")).where("n <> 0")


def difference(left: DataFrame, right: DataFrame, cells: int = CELLS) -> DataFrame:
    """The columns, ``side`` (``left`` or ``right``: the table that has more of the row) and ``times`` (how many more)."""
    if set(left.columns) != set(right.columns):
        raise ValueError(f"columns of one table only: {sorted(set(left.columns) ^ set(right.columns))}")
    kinds = {f.name: f.dataType for f in left.schema}
    other = [f.name for f in right.schema if kinds[f.name] != f.dataType]
    if other:
        raise ValueError(f"columns of different types: {other}")
    numbers = broadcast_if_small(written(differing_numbers(left, right, cells)))
    out = None
    for side, df, sign in (("left", left, 1), ("right", right, -1)):
        row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
        more = numbers.where(F.col("n") * sign > 0).withColumnRenamed("n", "more")
        found = df.select(row.alias("row"), *row_numbers(df)).join(more, ["h1", "h2"])
        one = found.groupBy("h1", "h2").agg(F.first("row").alias("row"), F.first("more").alias("more"))  # equal rows
        part = one.select("row.*", F.lit(side).alias("side"), F.abs("more").alias("times"))
        out = part if out is None else out.unionByName(part)
    return out
