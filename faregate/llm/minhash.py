"""Near duplicates by b-bit MinHash.

1. Per document the distinct shingles of five lower-cased words as 64-bit
   hashes, 128 minima, and of these band keys of some minima each and the
   low four bits of every minimum, packed into eight words. Documents with equal
   shingle sets are one class from here on.
2. Classes that share a band key are a bucket. Bands and the minima of each
   follow from the threshold (``banding``): a pair of classes at any threshold
   shares no band with a probability of at most ``MISSED``, 5e-7. There are 25
   bands of five at 0.85 (4.3e-7) and 28 of four at 0.80 (4.0e-7).
3. A pair's packed words are compared by counting bits; with four bits unequal
   minima agree by chance one time in sixteen, and the estimate is corrected for
   that. Only estimates more than six standard deviations below the threshold
   are let go.
4. All other pairs are confirmed on full shingle sets.

A bucket is never expanded into all pairs. In the first round each member is
paired with the bucket's smallest class. After each round the links' components
are found, and a bucket whose members are all connected is closed. Buckets that
are still open and hold at most ``BUCKET_BYTES`` of text are closed by one task
each, which compares one member at a time with all others by counting shared
shingles, and stops as soon as the members not yet compared are all connected.
In larger ones some members outside the largest component are paired with all
members of other components; they are then done with and leave the bucket.
Rounds go on, with four times as many such members in each, until every bucket
is closed, so no link between two components is lost and nothing is capped.

Null and empty texts, and texts without a word, have an empty set and no link.
A text of fewer words is one shingle. Null ids are not counted as smallest id
unless a component has no other. Repeated rows are one class. An empty table
gives no rows. Column names of the input can't clash with the operator's own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregate.llm.common import hashable, mix, shingles, slabs
from faregate.llm.components import components
from faregate.operators.layout import written

MINIMA, LOW_BITS = 128, 4
MISSED = 5e-7  # the probability that a pair at the threshold shares no band, at most
SLACK = 0.2  # six standard deviations of the estimate at 0.85
BUCKET_BYTES = 16 << 20  # texts of a bucket that one task takes
LEADERS = 4  # members taken per open bucket in the second round; four times as many in each one after
FOLDS = 0x1111111111111111  # the lowest bit of each four


def banding(percent: int) -> tuple[int, int]:
    """Bands, and minima in each: the most minima a band for which as many bands as ``MISSED`` asks for take ``MINIMA``.

    Thresholds too low for that have bands of one minimum, and more minima.
    """
    if not 1 <= percent <= 100:
        raise ValueError(f"percent is a whole number from 1 to 100, not {percent}")

    def bands(rows: int) -> int:
        alike = (percent / 100) ** rows
        return 1 if alike == 1 else math.ceil(math.log(MISSED) / math.log1p(-alike))

    rows = max((r for r in range(2, 17) if r * bands(r) <= MINIMA), default=1)
    return bands(rows), rows


def slack(percent: int) -> float:
    """Six standard deviations of the estimate at the threshold, ``SLACK`` at least."""
    chance = 1.0 / (1 << LOW_BITS)
    agree = percent / 100 * (1 - chance) + chance
    return max(SLACK, 6 * math.sqrt(agree * (1 - agree) / MINIMA) / (1 - chance))


def _list_column(values: np.ndarray, width: int, rows: int, filled: np.ndarray) -> pa.Array:
    """Rows of ``width`` words each, empty where a document has no shingle."""
    offsets = np.zeros(rows + 1, dtype=np.int32)
    np.cumsum(np.where(filled, width, 0), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1).view(np.int64)))


def signatures(docs: DataFrame, doc_id: str, text: str, width: int, percent: int = 85) -> DataFrame:
    """``id, text_hash, n_shingles, node, bands, packed`` of every document."""
    n_bands, band_rows = banding(percent)
    n_minima = max(MINIMA, n_bands * band_rows)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = mix(np.arange(1, n_minima + 1, dtype=np.uint64)) | np.uint64(1)
        places = np.arange(3, 2 * band_rows + 3, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
        shifts = (np.arange(MINIMA, dtype=np.uint64) % np.uint64(16)) * np.uint64(LOW_BITS)
        for batch in batches:
            for first, last, data, starts in slabs(batch.column(2)):
                sets = shingles(data, starts, width)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                filled = sizes > 0
                begin = np.concatenate(([0], np.cumsum(sizes[filled])))[:-1]
                minima = np.empty((int(filled.sum()), n_minima), dtype=np.uint64)
                if len(minima):
                    every = np.concatenate([s for s in sets if len(s)])
                    for j in range(n_minima):
                        minima[:, j] = np.minimum.reduceat(every * multipliers[j], begin)
                grouped = minima[:, : n_bands * band_rows].reshape(-1, n_bands, band_rows)
                keys = mix((grouped * places).sum(axis=2, dtype=np.uint64) + mix(np.arange(n_bands, dtype=np.uint64)))
                low = (minima[:, :MINIMA] & np.uint64((1 << LOW_BITS) - 1)) << shifts
                words = low.reshape(-1, MINIMA // 16, 16).sum(axis=2, dtype=np.uint64)
                nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                rows = last - first
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        batch.column(1).slice(first, rows),
                        pa.array(sizes),
                        pa.array(nodes, pa.binary()),
                        _list_column(keys, n_bands, rows, filled),
                        _list_column(words, MINIMA // 16, rows, filled),
                    ],
                    ["id", "text_hash", "n_shingles", "node", "bands", "packed"],
                )

    source = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("text")
    )
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(
        sign,
        f"id {kind}, text_hash bigint, n_shingles bigint, node binary, bands array<bigint>, packed array<bigint>",
    )


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed low bits: agreeing minima counted by bits, less those that agree by chance."""

    def differing(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        bits = bits.bitwiseOR(F.shiftrightunsigned(bits, 1))
        bits = bits.bitwiseOR(F.shiftrightunsigned(bits, 2))
        return F.bit_count(bits.bitwiseAND(F.lit(FOLDS)))

    unlike = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda total, x: total + x)
    chance = 1.0 / (1 << LOW_BITS)
    return (1 - unlike / F.lit(float(MINIMA)) - chance) / (1 - chance)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Labels ``lu, lv`` of the pairs ``u, v`` whose full shingle sets are at least ``percent`` alike."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, dtype=bool)
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                both = pa.concat_arrays([part.column(2), part.column(3)])
                sets = [s for _, _, data, starts in slabs(both) for s in shingles(data, starts, width)]
                for k in range(part.num_rows):
                    a, b = sets[k], sets[k + part.num_rows]
                    shared = len(np.intersect1d(a, b, assume_unique=True))
                    linked[i + k] = 100 * shared >= percent * (len(a) + len(b) - shared)
            mask = pa.array(linked)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["lu", "lv"])

    one = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    two = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    return (
        pairs.join(one, "u")
        .join(two, "v")
        .select("lu", "lv", "text_u", "text_v")
        .mapInArrow(check, "lu binary, lv binary")
    )


def _pairs(leaders: DataFrame) -> DataFrame:
    """Rows of ``node, label, leader, leader_label`` as pairs ``u, v`` in one order, with their labels."""
    first = F.col("node") < F.col("leader")
    one, two = F.struct("node", "label"), F.struct(F.col("leader").alias("node"), F.col("leader_label").alias("label"))
    both = leaders.select(F.when(first, one).otherwise(two).alias("a"), F.when(first, two).otherwise(one).alias("b"))
    return both.select(
        F.col("a.node").alias("u"), F.col("b.node").alias("v"), F.col("a.label").alias("lu"), F.col("b.label").alias("lv")
    ).distinct()


def _still_open(members: DataFrame, merged: DataFrame) -> DataFrame:
    """Members with their labels renewed, of the buckets that hold more than one component."""
    known = written(
        members.join(merged.select(F.col("node").alias("label"), F.col("label").alias("new")), "label", "left").select(
            "band", "node", F.coalesce("new", "label").alias("label")
        )
    )
    open_bands = known.groupBy("band").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b")
    return written(known.join(open_bands.select("band"), "band", "left_semi"))


def _next_leaders(members: DataFrame, turn: int, wanted: int) -> DataFrame:
    """About ``wanted`` members outside each bucket's largest component, and one at least."""
    sizes = members.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least"))
    bands = sizes.groupBy("band").agg(
        F.sum("n").alias("all"),
        F.max(F.struct("n", "label")).alias("major"),
        F.min(F.struct("n", "label", "least")).alias("minor"),
    )
    bands = bands.select(
        "band",
        F.col("major.label").alias("major"),
        (F.col("all") - F.col("major.n")).alias("others"),
        F.col("minor.least").alias("sure"),
    )
    draw = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 30))
    return (
        members.join(bands, "band")
        .filter(
            (F.col("node") == F.col("sure"))
            | ((F.col("label") != F.col("major")) & (draw * F.col("others") < wanted << 30))
        )
        .select("band", F.col("node").alias("leader"), F.col("label").alias("leader_label"))
    )


def merged_labels(texts: list[str], labels: list[bytes], percent: int, width: int) -> list[tuple[bytes, bytes]]:
    """Pairs of labels that links between these texts connect, as few as it takes."""
    column = pa.array(texts, pa.string())
    sets = [x for _, _, data, starts in slabs(column) for x in shingles(data, starts, width)]
    sizes = np.array([len(x) for x in sets])
    _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(shingle, kind="stable")
    holders = owner[order]  # texts that hold each shingle, side by side
    first = np.searchsorted(shingle[order], np.arange(shingle.max(initial=-1) + 2))
    begin = np.concatenate(([0], np.cumsum(sizes)))
    names, group = np.unique(np.array(labels, dtype=object), return_inverse=True)
    out, waiting = [], np.ones(len(sets), dtype=bool)
    while True:
        found, count = np.unique(group[waiting], return_counts=True)
        if len(found) < 2:  # whatever is not compared yet is connected
            return out
        i = int(np.flatnonzero(waiting & (group == found[count.argmin()]))[0])
        waiting[i] = False
        own = shingle[begin[i] : begin[i + 1]]
        shared = np.bincount(
            np.concatenate([holders[first[x] : first[x + 1]] for x in own]), minlength=len(sets)
        )
        linked = np.flatnonzero(100 * shared >= percent * (sizes + sizes[i] - shared))
        for other in np.unique(group[linked]):
            if other != group[i]:
                out.append((names[group[i]], names[other]))
                group[group == other] = group[i]


def _close_small(left: DataFrame, texts: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """Links ``lu, lv`` between labels in buckets that one task can take, and the members of all others.

    Buckets with the same members are taken once.
    """
    name = F.xxhash64("node")
    bands = written(
        left.join(texts.select("node", "bytes"), "node")
        .groupBy("band")
        .agg(
            F.sum("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(name).alias("mixed"),
            F.sum(name.cast("decimal(38,0)")).alias("sum"),
        )
    )
    small = bands.filter(F.col("bytes") <= BUCKET_BYTES).groupBy("n", "mixed", "sum").agg(F.min("band").alias("band"))
    small = written(small.select("band"))
    large = bands.filter(F.col("bytes") > BUCKET_BYTES).select("band")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def pairs() -> pa.RecordBatch:
            found = merged_labels([t for _, t in held], [x for x, _ in held], percent, width)
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], ["lu", "lv"]
            )

        for batch in batches:
            for band, label, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if band != current:
                    if held:
                        yield pairs()
                    current, held = band, []
                held.append((label, text))
        if held:
            yield pairs()

    members = written(left.join(small, "band")).join(texts.select("node", "text"), "node").select("band", "label", "text")
    closed = members.repartition("band").sortWithinPartitions("band").mapInArrow(close, "lu binary, lv binary")
    return closed, left.join(large, "band", "left_semi")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85, width: int = 5
) -> DataFrame:
    """One row per document: ``id, text_hash, n_shingles, component_id, kept``."""
    signed = written(signatures(docs, doc_id, text, width, percent))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash"))
    classes = written(
        signed.filter("n_shingles > 0")
        .groupBy("node")
        .agg(first.alias("first"), F.first("bands").alias("bands"), F.first("packed").alias("packed"))
    )
    in_bands = classes.select("node", F.explode("bands").alias("band"))
    leaders = in_bands.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(in_bands.join(leaders.select("band", "leader"), "band"))

    wanted = members.select("node").distinct().join(classes.select("node", "first"), "node")
    wanted = wanted.select("node", F.col("first.id").alias("want_id"), F.col("first.text_hash").alias("want_hash"))
    source = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("text")
    )
    texts = source.join(
        wanted, F.col("id").eqNullSafe(F.col("want_id")) & (F.col("text_hash") == F.col("want_hash"))
    )
    texts = texts.select("node", "text", F.octet_length("text").alias("bytes"))
    texts = written(texts.dropDuplicates(["node"]))
    packed = classes.select("node", "packed")

    def likely(pairs: DataFrame) -> DataFrame:
        one = packed.select(F.col("node").alias("u"), F.col("packed").alias("a"))
        two = packed.select(F.col("node").alias("v"), F.col("packed").alias("b"))
        return pairs.join(one, "u").join(two, "v").filter(estimate(F.col("a"), F.col("b")) >= percent / 100 - slack(percent))

    star = members.filter("node <> leader").withColumns({"label": F.col("node"), "leader_label": F.col("leader")})
    now = written(likely(_pairs(star)).select("u", "v", "lu", "lv"))
    tested = now.select("u", "v")
    merges = []
    left = members.filter("node <> leader").select("band", "node", F.col("node").alias("label"))

    def merge(linked: DataFrame, members_: DataFrame) -> DataFrame:
        merges.append(components(linked.select(F.col("lu").alias("u"), F.col("lv").alias("v"))))
        return _still_open(members_, merges[-1])

    left = merge(confirm(now, texts, percent, width), left)
    if not left.isEmpty():
        left = merge(*_close_small(left, texts, percent, width))
    turn = 0
    while not left.isEmpty():
        chosen = written(_next_leaders(left, turn, LEADERS << (2 * turn)))
        pairs = _pairs(left.join(chosen, "band").filter("label <> leader_label"))
        now = written(likely(pairs.join(tested, ["u", "v"], "left_anti")).select("u", "v", "lu", "lv"))
        tested = tested.unionByName(now.select("u", "v"))
        left = left.join(chosen.select("band", F.col("leader").alias("node")), ["band", "node"], "left_anti")
        left = merge(confirm(now, texts, percent, width), left)
        turn += 1

    labels = classes.select("node", F.col("node").alias("label"), "first")
    for merged in merges:
        renewed = merged.select(F.col("node").alias("label"), F.col("label").alias("new"))
        labels = labels.join(renewed, "label", "left").select("node", F.coalesce("new", "label").alias("label"), "first")
    least = labels.groupBy("label").agg(F.min("first").alias("least"))
    by_node = labels.join(least, "label").select("node", "least")
    own = F.col("node").isNull()
    same_row = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("text_hash") == F.col("least.text_hash"))
    return signed.join(by_node, "node", "left").select(
        "id",
        "text_hash",
        "n_shingles",
        F.when(own, F.col("id")).otherwise(F.col("least.id")).alias("component_id"),
        (own | same_row).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85, width: int = 5
) -> DataFrame:
    """The rows that stay, one of each component and all without a word, with the columns they came with."""
    marked = near_duplicates(docs, doc_id, text, percent, width).filter("kept")
    stay = marked.select(
        F.col("id").alias("stay_id"), F.col("text_hash").alias("stay_hash"), (F.col("n_shingles") == 0).alias("bare")
    ).distinct()
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"),
        F.xxhash64(f"`{text}`").alias("text_hash"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    kept = rows.join(
        stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("text_hash") == F.col("stay_hash"))
    ).withColumn("copy", F.when(F.col("bare"), F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    # of rows alike in id and text the same one whenever a task is run again
    chosen = F.min_by("row", F.xxhash64(hashable(docs, "row"))).alias("row")
    return kept.groupBy("id", "text_hash", "copy").agg(chosen).select("row.*")
