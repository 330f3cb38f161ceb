"""Helpers shared by the corpus operators: tables, shared scratch, texts as byte arrays, hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate.session import ship

SLAB_BYTES = 1 << 20  # texts worked on at once inside a task; one longer text is a slab of its own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _type_ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return f"array<{_type_ddl(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_type_ddl(kind.keyType)},{_type_ddl(kind.valueType)}>"
    if isinstance(kind, T.StructType):
        return f"struct<{','.join(f'{_quoted(f.name)}:{_type_ddl(f.dataType)}' for f in kind.fields)}>"
    return kind.simpleString()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def field_ddl(df: DataFrame, *names: str) -> str:
    """The named columns as a DDL list, with the types they have in ``df``; names inside structs are quoted too."""
    return ", ".join(f"{_quoted(n)} {_type_ddl(df.schema[n].dataType)}" for n in names)


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct column ``row``, so that no name can clash with an operator's own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def hashable(df: DataFrame, row: str) -> Column:
    """Of a struct of all columns of ``df`` what a hash takes: equal maps may list their keys in another order, so none."""
    names = [f.name for f in df.schema if not _holds_map(f.dataType)]
    if len(names) == len(df.columns):
        return F.col(row)
    return F.struct(*[F.col(row)[name] for name in names] or [F.lit(0)])


def bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make(value)`` with the value computed once, however often ``make`` and the functions inside it look at it."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


LEVELS = 2  # of blocks; each makes a plan deeper


def folded(items: Column, state: Column, out: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Carry a state along an array and gather what each step puts out: ``state`` and ``out``.

    ``step`` gives the next state and an array of type ``array<out>``. Appending to one
    growing array copies it at every step; here a block of about the cube root of the
    array's length gathers its own, blocks are appended to each other, and so on upwards.
    """
    none, kind = F.array().cast(f"array<{out}>"), f"array<array<{out}>>"

    def appended(s: Column, made: Column, out: Callable[[Column], Column]) -> Column:
        # a fold over one element: unlike in a transform, what is gathered so far is not copied deeply
        return F.aggregate(
            F.array(made), s, lambda s, x: F.struct(x["state"].alias("state"), F.concat(s["out"], out(x["out"])).alias("out"))
        )

    def one(s: Column, item: Column) -> Column:
        after, made = step(s["state"], item)
        return appended(s, F.struct(after.alias("state"), made.alias("out")), lambda x: x)

    def level(depth: int, width: Column, before: Column, x: Column) -> Column:
        if not depth:
            return F.aggregate(x, F.struct(before.alias("state"), none.alias("out")), one)
        size = F.pow(width, F.lit(depth)).cast("int")
        parts = F.transform(F.sequence(F.lit(1), F.size(x), size), lambda at: F.slice(x, at, size))
        return F.aggregate(
            F.when(F.size(x) > 0, parts).otherwise(F.array(x)),
            F.struct(before.alias("state"), F.array().cast(kind).alias("out")),
            lambda s, part: appended(s, level(depth - 1, width, s["state"], part), F.array),
            lambda s: F.struct(s["state"].alias("state"), F.flatten(s["out"]).alias("out")),
        )

    def whole(x: Column) -> Column:
        return bound(F.ceil(F.pow(F.size(x), F.lit(1.0 / (LEVELS + 1)))), lambda width: level(LEVELS, width, state, x))

    return bound(items, whole)


def held_out(doc_id: str):
    """Rows no model may learn from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows on end, and where each row starts; a missing text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.binary()).cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole, starts


def slabs(column: pa.Array, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, last row + 1, their bytes, their starts."""
    data, starts = byte_rows(column)
    rows, first = len(starts) - 1, 0
    while first < rows:
        last = int(np.searchsorted(starts, starts[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
        first = last


# Multipliers of a 64-bit finalizer (splitmix64) and an odd base with its inverse mod 2**64.
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """``base ** i`` mod 2**64 for i below ``count``; grown on demand and kept by the worker."""
    known = _POWERS.get(base)
    if known is None or len(known) < count:
        size = max(count, 2 * SLAB_BYTES)
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _POWERS[base] = known
    return known[:count]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hash`` gets the hash of any span."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span's bytes, the same wherever it lies."""
    return mix((sums[end] - sums[start]) * powers(BASE_INVERSE, len(sums))[start])


# The white space of the contracts (space, tab to carriage return) and A-Z to a-z.
WORD_BYTE = np.ones(256, dtype=bool)
WORD_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes that do not cross rows: their starts and ends."""
    before = np.empty(len(inside), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(inside), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    edges = starts[1:-1][(starts[1:-1] > 0) & (starts[1:-1] < len(inside))]
    before[edges] = False
    after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and per row where its words start in that list."""
    low = LOWER[data]
    begin, end = runs(WORD_BYTE[data], starts)
    return span_hash(prefix_hash(low), begin, end), np.searchsorted(begin, starts)


# Odd multipliers, one for each place in a shingle.
PLACE = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
    dtype=np.uint64,
)


def shingles(data: np.ndarray, starts: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its word shingles; a shorter row is one shingle, no words none."""
    hashes, first = words(data, starts)
    count = len(hashes)
    places = powers(int(PLACE[0]), width + 1)[1:] if width > len(PLACE) else PLACE
    joined = np.zeros(max(count - width + 1, 0), dtype=np.uint64)
    for i in range(width):
        joined += hashes[i : count - width + 1 + i] * places[i] if len(joined) else np.uint64(0)
    joined = mix(joined)
    out = []
    for begin, end in zip(first[:-1], first[1:]):
        if end - begin >= width:
            out.append(np.unique(joined[begin : end - width + 1]))
        elif end > begin:
            few = hashes[begin:end] * places[: end - begin]
            out.append(mix(np.array([few.sum(dtype=np.uint64) + np.uint64(end - begin)])))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
