"""Filter interaction audit: what each filter of a chain removes, in every order, for each part of the corpus.

Each document gets a mask of the filters it fails. Documents are counted by part
and mask, with their labels; a part is then at most 32 cells. A Gray-code walk
visits all 32 sets of active filters, one filter switched at a time: every mask
cell keeps a counter of the active filters it fails, and when that leaves or
reaches zero, the cell's documents leave or join the running survivors. The 32
states are stored, and everything reported is a difference of two of them, so no
document and no order is looked at again:

* kept, removed, good_lost, toxic_lost: the states before and after a step;
* redundant: what the filter fails by itself, less what it removes here;
* unique_fails: the state without the filter, less the one with all five;
* shapley: removals over all 120 orders, weighted by how many orders share a state.

Text rules (``words`` are maximal runs outside ``[\\x20\\x09-\\x0D]``): see ``FAILS``.
Filter E compares SHA-256 digests of whole texts. Rows are first counted by id,
digest and part, then by digest, part and labels, so that a large group of copies
is a few rows before its smallest id is looked up.

Null texts are empty, a null source is the part ``''`` (as is an empty one). A null
id has no label, is no copy of another document and makes no other document one.
Repeated rows count each; rows of one id with one text are no copies of each other.
If a label table holds an id several times, one row with the label is enough. An
empty table gives no rows. Further columns are not read. A text is worked on as one
value: a task needs some ten times its bytes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
MEASURES = ("n", "good", "toxic")
PARTS_AT_ONCE = 64  # of 600 rows each

RESULT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def text_fails(text: Column) -> Column:
    """The mask of the filters A to D that a text fails, bit 0 for A."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    counts = F.struct(F.size(words).alias("words"), F.size(F.array_distinct(words)).alias("kinds"))

    def mask(c: Column) -> Column:
        fails = (
            c["words"] < 200,
            c["kinds"] * 100 < c["words"] * 50,
            F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.char_length(text) * 2,
            text.rlike("[#$%&*|]"),
        )
        return sum((F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)), F.lit(0))

    # bound once: both numbers come from one list of words
    return F.get(F.transform(F.array(counts), mask), F.lit(0))


def _labels(labels: DataFrame) -> DataFrame:
    return (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(
            F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
            F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
        )
        .withColumn("label_salt", F.lit(0))
    )


def cells(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and by the filters they fail."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = (
        docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("part"), value.alias("value"))
        .select("id", "part", F.unhex(F.sha2("value", 256)).alias("digest"), text_fails(F.col("value")).alias("mask"))
        .groupBy("id", "digest", "part", "mask")
        .agg(F.count(F.lit(1)).alias("n"))
        # rows without an id match no label; a salt keeps them from meeting in one task
        .withColumn("salt", F.when(F.col("id").isNull(), F.pmod(F.hash("digest"), F.lit(1 << 16))).otherwise(0))
    )
    known = _labels(labels)
    labelled = rows.join(known, (rows.id == known.label_id) & (rows.salt == known.label_salt), "left").select(
        "id", "digest", "part", "mask", "n", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    )
    copies = labelled.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        # the smallest id here and its rows; an id stands once in a group
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
    )
    smallest = copies.groupBy(F.col("digest").alias("of")).agg(F.min("least.id").alias("smallest"))
    first = F.when(F.col("least.id") == F.col("smallest"), F.col("least.n")).otherwise(0)
    counted = copies.join(smallest, F.col("digest") == F.col("of")).select(
        "part", "mask", "good", "toxic", "n", (F.coalesce(first, F.lit(0)) + F.col("nameless")).alias("firsts")
    )
    pair = F.array(
        F.struct(F.col("mask"), F.col("firsts").alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")),
    )
    return (
        counted.select("part", "good", "toxic", F.explode(pair).alias("cell"))
        .groupBy("part", F.col("cell.mask").alias("mask"))
        .agg(
            F.sum("cell.n").alias("n"),
            F.sum(F.col("cell.n") * F.col("good")).alias("good"),
            F.sum(F.col("cell.n") * F.col("toxic")).alias("toxic"),
        )
    )


def walk(weights: np.ndarray) -> np.ndarray:
    """Survivors of all 32 sets of filters; ``weights`` and the result are parts x 32 x measures.

    Consecutive Gray codes differ in one bit, so each step switches one filter.
    """
    states = np.zeros_like(weights)
    failing = np.zeros(ALL + 1, dtype=np.int64)  # active filters that a cell fails
    survivors = weights.sum(axis=1)
    states[:, 0] = survivors
    active = 0
    for step in range(1, ALL + 1):
        code = step ^ (step >> 1)
        bit = code ^ active
        switched_on = bool(code & bit)
        has = np.flatnonzero(np.arange(ALL + 1) & bit)
        if switched_on:
            leaving = has[failing[has] == 0]
            survivors = survivors - weights[:, leaving].sum(axis=1)
            failing[has] += 1
        else:
            failing[has] -= 1
            joining = has[failing[has] == 0]
            survivors = survivors + weights[:, joining].sum(axis=1)
        active = code
        states[:, active] = survivors
    return states


def _orders() -> list[tuple[str, list[tuple[int, int, int]]]]:
    """All orders with their steps: filter, set before, set after."""
    out = []
    for order in itertools.permutations(range(len(FILTERS))):
        steps, before = [], 0
        for f in order:
            after = before | 1 << f
            steps.append((f, before, after))
            before = after
        out.append(("".join(FILTERS[f] for f in order), steps))
    return out


def report(names: list[str], states: np.ndarray) -> dict[str, list | np.ndarray]:
    """All orders and steps of some parts, by differences of their states."""
    orders = _orders()
    f, before, after = np.array([s for _, steps in orders for s in steps]).T
    n = states[:, :, 0]
    lost = states[:, before] - states[:, after]
    fails_alone = n[:, :1] - n[:, 1 << f]
    shapley = np.zeros((len(names), len(FILTERS)), dtype=np.int64)
    for i in range(len(FILTERS)):
        shapley[:, i] = lost[:, f == i, 0].sum(axis=1)
    steps = len(f)
    return {
        "part": [name for name in names for _ in range(steps)],
        "filter_order": [name for name, own in orders for _ in own] * len(names),
        "step": np.tile(np.arange(steps) % len(FILTERS) + 1, len(names)).astype(np.int32),
        "kept": n[:, after].ravel(),
        "removed": lost[:, :, 0].ravel(),
        "redundant": (fails_alone - lost[:, :, 0]).ravel(),
        "unique_fails": (n[:, ALL & ~(1 << f)] - n[:, ALL : ALL + 1]).ravel(),
        "good_lost": lost[:, :, 1].ravel(),
        "toxic_lost": lost[:, :, 2].ravel(),
        "shapley": shapley[:, f].ravel(),
    }


def _walk_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PARTS_AT_ONCE):
            rows = batch.slice(at, PARTS_AT_ONCE).to_pydict()
            weights = np.zeros((len(rows["part"]), ALL + 1, len(MEASURES)), dtype=np.int64)
            for i, own in enumerate(rows["cells"]):
                for cell in own:
                    weights[i, cell["mask"]] = [cell[m] for m in MEASURES]
            yield pa.RecordBatch.from_pydict(report(rows["part"], walk(weights)))


def audit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """One row per part, order and step: 600 per part."""
    cell = F.struct("mask", *MEASURES)
    parts = cells(docs, labels, doc_id, text, source).groupBy("part").agg(F.collect_list(cell).alias("cells"))  # at most 32
    return parts.mapInArrow(_walk_parts, RESULT)
