"""Removal of every byte covered by a string of ``length`` bytes that also starts elsewhere.

1. Each window of ``length`` bytes is owned by an anchor: of the 64-byte grams it
   holds, the one with the smallest hash, the leftmost of equals. Equal windows
   have equal anchors at equal offsets. Consecutive windows with one anchor are
   a block; on average a block covers some seventy window starts. Of a block that
   follows itself again and again two rows stay; very long texts are cut into
   overlapping pieces first.
2. Blocks whose anchor's hash occurs once in the corpus hold no repeated window
   and are dropped: anchors are counted, then blocks are semi-joined.
3. Equal blocks of one anchor are repeated as a whole. Where an anchor also has
   blocks that occur once, these may share part of their windows with others:
   the distinct blocks' bytes are cut out of the texts and grouped by anchor.
   Windows with nearby offsets share a core; ranges whose core no other block
   has drop out, and a suffix array over the rest of many groups at a time finds
   their repeated windows. All suffixes that share a window are neighbours in
   it; neighbours are compared symbol by symbol.
4. An anchor with more than ``GROUP`` distinct blocks goes another exact way, as
   no task may hold all of them: cores that occur once drop out by a shuffle, and
   the remaining windows are counted by hash within anchor and core.
5. Repeated windows become spans per document, which join the texts once more.

Matches never cross rows. Null counts as empty. A text shorter than ``length``
loses nothing. Rows that repeat an id with the same text count as documents of
their own, so they remove each other. Null ids are kept apart by their texts. An
empty table gives no rows. Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregate.llm.common import byte_rows, mix, prefix_hash, slabs, span_hash
from faregate.llm.suffix_array import suffix_array
from faregate.operators.layout import written

LENGTH, GRAM = 200, 64
GROUP = 2_048  # distinct blocks of one anchor that one task takes
RUN = 1 << 16  # symbols of one suffix array
STEP = 16  # offsets that share a core
PLACE_BITS = np.uint64(28)
CUT = 1 << 24  # window starts of one text that are looked at at once; places need fewer bits than PLACE_BITS


def blocks(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Per block of a slab: row, first and last window start, anchor's place, anchor's and content's hash."""
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    sums = prefix_hash(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = span_hash(sums, at, at + GRAM)
    least = (grams >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64)
    span, count = 1, length - GRAM + 1
    while span * 2 <= count:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < count:
        least = np.minimum(least[: len(least) - (count - span)], least[count - span :])
    anchor = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    # windows that end within their row
    sizes = np.diff(starts)
    row_end = np.repeat(starts[1:], sizes)[: len(anchor)]
    whole = np.arange(len(anchor)) + length <= row_end
    new = np.ones(len(anchor), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new & whole)
    stop = np.ones(len(anchor), dtype=bool)
    stop[:-1] = new[1:] | ~whole[1:]
    last = np.flatnonzero(stop & whole)
    place = anchor[first]
    content = mix(span_hash(sums, first, last + length) + (place - first).astype(np.uint64))
    row = np.searchsorted(starts, first, side="right") - 1
    return row, first - starts[row], last - starts[row], place - starts[row], grams[place], content


def pieces(data: np.ndarray, starts: np.ndarray, length: int, cut: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A slab as it is, or a long text in pieces of ``cut`` window starts: where a piece begins, its bytes, its starts.

    A block that a cut divides becomes two; any division of windows into blocks gives the same result.
    """
    if len(starts) > 2 or len(data) < cut + length:
        yield 0, data, starts
        return
    for low in range(0, len(data) - length + 1, cut):
        piece = data[low : low + cut + length - 1]
        yield low, piece, np.array([0, len(piece)])


def collapsed(found: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Blocks with ``span``, the windows after the first that a block stands for.

    In text of a short period (a rule, padding) one block follows itself again and
    again. The first two of such a run stay, which is enough for it to occur more than
    once, and the first one stands for the whole run.
    """
    row, first, last, lead, anchor, content = found
    again = np.zeros(len(row), dtype=bool)
    again[1:] = first[1:] == last[:-1] + 1
    for values in (row, last - first, lead - first, anchor, content):
        again[1:] &= values[1:] == values[:-1]
    heads = np.flatnonzero(~again)
    span = last - first
    span[heads] = last[np.append(heads[1:], len(row)) - 1] - first[heads] if len(heads) else 0
    keep = ~again
    keep[1:] |= again[1:] & ~again[:-1]
    return tuple(values[keep] for values in (*found, span))


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    value = F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.hash(value).alias("text_hash"), value.alias("text"))


def _blocks(source: DataFrame, length: int) -> DataFrame:
    size = CUT

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = (
                (begin, low, collapsed(blocks(piece, edges, length)))
                for begin, _, data, starts in slabs(batch.column(2))
                for low, piece, edges in pieces(data, starts, length, size)
            )
            for begin, low, (row, first, last, place, anchor, content, span) in parts:
                rows = pa.array(row + begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array((first + low).astype(np.int32)),
                        pa.array((last - first).astype(np.int32)),
                        pa.array((place - first).astype(np.int32)),
                        pa.array(anchor.view(np.int64)),
                        pa.array(content.view(np.int64)),
                        pa.array(span.astype(np.int32)),
                    ],
                    ["id", "text_hash", "first", "more", "lead", "anchor", "content", "span"],
                )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(
        scan, f"id {kind}, text_hash int, first int, more int, lead int, anchor bigint, content bigint, span int"
    )


def _cut(source: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted blocks with their bytes, or, where hot, one row per range of offsets with the windows' hashes."""
    by_text = wanted.groupBy(F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash")).agg(
        F.collect_list(F.struct("first", "more", "lead", "anchor", "single", "hot")).alias("wanted")
    )  # at most the blocks of one text
    both = source.join(by_text, _same_text("own_id", "own_hash")).select("id", "text_hash", "text", "wanted")
    names = ["id", "text_hash", "first", "more", "lead", "anchor", "single", "bytes", "core", "windows"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = byte_rows(batch.column(2))
            out: dict[str, list] = {name: [] for name in names[2:]}
            rows = []
            for i in range(batch.num_rows):
                body = data[starts[i] : starts[i + 1]]
                for x in batch.column(3)[i].as_py():
                    first, last = x["first"], x["first"] + x["more"]
                    piece = body[first : last + length]
                    if not x["hot"]:
                        rows.append(i)
                        _add(out, first, x["more"], x, piece.tobytes(), None, None)
                        continue
                    sums, lead = prefix_hash(piece), x["lead"]
                    at = np.arange(x["more"] + 1)
                    hashes = span_hash(sums, at, at + length)
                    ranges = (lead - at) // STEP  # offsets to the anchor, falling
                    for part in np.unique(ranges):
                        own = at[ranges == part]
                        core = lead - part * STEP  # where the last window of the whole range starts
                        middle = span_hash(sums, np.array([core]), np.array([core - STEP + 1 + length]))
                        rows.append(i)
                        key = int(mix(middle + np.uint64(part % (1 << 32)))[0].view(np.int64))
                        _add(out, first + int(own[0]), len(own) - 1, x, None, key, hashes[own].view(np.int64))
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array(out["first"], pa.int32()),
                    pa.array(out["more"], pa.int32()),
                    pa.array(out["lead"], pa.int32()),
                    pa.array(out["anchor"], pa.int64()),
                    pa.array(out["single"], pa.bool_()),
                    pa.array(out["bytes"], pa.binary()),
                    pa.array(out["core"], pa.int64()),
                    pa.array(out["windows"], pa.list_(pa.int64())),
                ],
                names,
            )

    kind = source.schema["id"].dataType.simpleString()
    return both.mapInArrow(
        cut,
        f"id {kind}, text_hash int, first int, more int, lead int, anchor bigint, single boolean, "
        "bytes binary, core bigint, windows array<bigint>",
    )


def _add(out: dict[str, list], first: int, more: int, block: dict, data: bytes | None, core, windows) -> None:
    for name, value in (
        ("first", first),
        ("more", more),
        ("lead", block["lead"]),
        ("anchor", block["anchor"]),
        ("single", block["single"]),
        ("bytes", data),
        ("core", core),
        ("windows", windows),
    ):
        out[name].append(value)


def repeated_windows(strings: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Per string of symbols (all above 1), which of its windows start elsewhere in the strings as well."""
    sizes = np.array([len(x) for x in strings])
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))
    symbols = np.ones(begin[-1] + 1, dtype=np.int64)
    for start, string in zip(begin, strings):
        symbols[start : start + len(string)] = string
    symbols[-1] = 0
    order = suffix_array(symbols)[1:]
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    fits = np.arange(len(owner)) + width < begin[1:][owner]
    order = order[fits[order]]
    same = np.zeros(max(len(order) - 1, 0), dtype=bool)
    every, short = np.arange(width), symbols.astype(np.int32)
    for low in range(0, len(same), 4096):
        a, b = order[low : low + 4096], order[low + 1 : low + 4097]
        a = a[: len(b)]
        same[low : low + len(b)] = (short[a[:, None] + every] == short[b[:, None] + every]).all(axis=1)
    found = np.zeros(len(symbols), dtype=bool)
    found[order[:-1][same]] = True
    found[order[1:][same]] = True
    return [found[begin[i] : begin[i] + max(sizes[i] - width + 1, 0)] for i in range(len(strings))]


def candidates(blocks_: list[tuple[bytes, int, int, bool]], length: int) -> list[tuple[int, int, int]]:
    """Block, first and last offset of the window runs that may be repeated.

    Blocks are (bytes, anchor's place, anchor's hash, occurs once). Windows whose
    offsets to the anchor fall into one range share a core; where no other block
    of the anchor has that core, none of them is repeated. A run of blocks that
    are all repeated as a whole anyway is left out.
    """
    sizes = np.array([len(b[0]) for b in blocks_], dtype=np.int64)
    lead = np.array([b[1] for b in blocks_], dtype=np.int64)
    anchor = np.array([b[2] for b in blocks_], dtype=np.int64).view(np.uint64)
    once = np.array([b[3] for b in blocks_], dtype=bool)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    sums = prefix_hash(np.frombuffer(b"".join(b[0] for b in blocks_), dtype=np.uint8))
    more = sizes - length
    low, high = (lead - more) // STEP, lead // STEP
    owner = np.repeat(np.arange(len(blocks_)), high - low + 1)
    part = np.arange(len(owner)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[owner]
    core = begin[owner] + lead[owner] - part * STEP
    # a range at the anchor's own place can be negative no further than one step
    hashes = span_hash(sums, core, core + length - STEP + 1)
    key = mix(mix(hashes + part.astype(np.uint64)) + anchor[owner])
    _, number, count = np.unique(key, return_inverse=True, return_counts=True)
    single = np.bincount(number, weights=once[owner]) > 0
    alive = (count[number] > 1) & single[number]
    out = []
    edge = np.flatnonzero(alive & ~np.concatenate(([False], alive[:-1] & (owner[1:] == owner[:-1]))))
    stop = np.flatnonzero(alive & ~np.concatenate((alive[1:] & (owner[1:] == owner[:-1]), [False])))
    for a, b in zip(edge, stop):
        i = int(owner[a])
        out.append(
            (i, max(0, int(lead[i] - part[b] * STEP) - STEP + 1), min(int(more[i]), int(lead[i] - part[a] * STEP)))
        )
    return out


def repeats_of_blocks(blocks_: list[tuple[bytes, int, int, bool]], length: int) -> list[tuple[int, int, int]]:
    """Block, first and last offset of runs of repeated windows, of blocks that occur once.

    Every window of a block holds the anchor's gram whole, so the gram is one
    symbol, and windows are so much shorter.
    """
    runs_ = candidates(blocks_, length)
    grams: dict[bytes, int] = {}
    strings = []
    for i, a, b in runs_:
        body, lead = blocks_[i][0], blocks_[i][1]
        gram = grams.setdefault(body[lead : lead + GRAM], 258 + len(grams))
        data = np.frombuffer(body, dtype=np.uint8)
        strings.append(np.concatenate((data[a:lead] + np.int64(2), [gram], data[lead + GRAM : b + length] + np.int64(2))))
    out = []
    if strings:
        for (i, a, _), marked in zip(runs_, repeated_windows(strings, length - GRAM + 1)):
            if blocks_[i][3]:  # others are repeated as a whole
                edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
                out += [(i, a + int(x), a + int(y) - 1) for x, y in zip(edges[::2], edges[1::2])]
    return out


def _by_suffix_array(cut: DataFrame, length: int) -> DataFrame:
    """Spans of windows that blocks of one anchor share."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind, id_type = cut.schema["id"].dataType.simpleString(), to_arrow_type(cut.schema["id"].dataType)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, current = 0, None
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for row in zip(*columns):
                if row[0] != current:
                    if size >= RUN:
                        yield spans(held)
                        held, size = [], 0
                    current = row[0]
                held.append(row)
                size += len(row[6])
        if held:
            yield spans(held)

    def spans(held: list[tuple]) -> pa.RecordBatch:
        found = repeats_of_blocks([(r[6], r[4], r[0], r[5]) for r in held], length)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([held[i][1] for i, _, _ in found], id_type),
                pa.array([held[i][2] for i, _, _ in found], pa.int32()),
                pa.array([held[i][3] + a for i, a, _ in found], pa.int32()),
                pa.array([held[i][3] + b + length for i, _, b in found], pa.int32()),
            ],
            ["id", "text_hash", "low", "high"],
        )

    grouped = (
        cut.filter("bytes is not null")
        .select("anchor", "id", "text_hash", "first", "lead", "single", "bytes")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
    )
    return grouped.mapInArrow(find, f"id {kind}, text_hash int, low int, high int")


def _by_window(cut: DataFrame, length: int) -> DataFrame:
    """Spans of repeated windows of anchors with very many blocks."""
    ranges = cut.filter("core is not null").select("id", "text_hash", "first", "anchor", "single", "core", "windows")
    often = ranges.groupBy("anchor", "core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    single = ranges.join(often.select("anchor", "core"), ["anchor", "core"], "left_semi").select(
        "id", "text_hash", "first", "anchor", "single", "core", F.posexplode("windows").alias("nth", "window")
    )
    key = ["anchor", "core", "window"]
    again = single.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("single").alias("single"))
    again = again.filter("n > 1 or not single").select(*key)
    low = F.col("first") + F.col("nth")
    return (
        single.filter("single")
        .join(again, key, "left_semi")
        .select("id", "text_hash", low.alias("low"), (low + length).alias("high"))
    )


def _same_text(doc_id: str, text_hash: str) -> Column:
    return F.col("id").eqNullSafe(F.col(doc_id)) & (F.col("text_hash") == F.col(text_hash))


def repeated_spans(source: DataFrame, length: int) -> DataFrame:
    """``id, text_hash, low, high``: byte ranges covered by repeated windows; they may overlap."""
    found = _blocks(source, length)
    # written: a join side that is only read can be split where one anchor has very many blocks
    often = written(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"))
    found = written(found.join(often, "anchor", "left_semi"))

    one = F.min(F.struct("id", "text_hash", "first", "more", "lead")).alias("one")
    distinct = written(found.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), one))
    whole = found.join(distinct.filter("n > 1").select("anchor", "content"), ["anchor", "content"], "left_semi")
    whole = whole.select(
        "id", "text_hash", F.col("first").alias("low"), (F.col("first") + F.col("span") + length).alias("high")
    )

    counts = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("blocks"), F.min("n").alias("least"))
    mixed = written(counts.filter("blocks > 1 and least = 1"))
    wanted = distinct.join(mixed.select("anchor", (F.col("blocks") > GROUP).alias("hot")), "anchor").select(
        "one.*", "anchor", (F.col("n") == 1).alias("single"), "hot"
    )
    cut = written(_cut(source, wanted, length))
    return whole.unionByName(_by_suffix_array(cut, length)).unionByName(_by_window(cut, length))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, with_kept: bool = False
) -> DataFrame:
    """One row per document: its id, ``n_bytes, n_removed, n_spans, kept_sha256, spans`` (and ``kept`` bytes)."""
    source = _source(docs, doc_id, text)
    spans = written(repeated_spans(source, length))
    by_text = spans.groupBy(F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash")).agg(
        F.collect_list(F.struct("low", "high")).alias("spans")
    )  # at most the windows of one text
    both = source.join(by_text, _same_text("own_id", "own_hash"), "left").select("id", "text", "spans")
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = byte_rows(batch.column(1))
            sizes, gone, runs_, sums, places, kept = [], [], [], [], [], []
            for i, found in enumerate(batch.column(2).to_pylist()):
                body = data[starts[i] : starts[i + 1]]
                edges: list[list[int]] = []
                for low, high in sorted((s["low"], s["high"]) for s in found or ()):
                    if edges and low <= edges[-1][1]:
                        edges[-1][1] = max(edges[-1][1], high)
                    else:
                        edges.append([low, high])
                cuts = [0, *(x for pair in edges for x in pair), len(body)]
                rest = b"".join(body[a:b].tobytes() for a, b in zip(cuts[::2], cuts[1::2]))
                sizes.append(len(body))
                gone.append(len(body) - len(rest))
                runs_.append(len(edges))
                sums.append(hashlib.sha256(rest).hexdigest())
                places.append([{"start": a, "end": b} for a, b in edges])
                if with_kept:
                    kept.append(rest)
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(runs_, pa.int64()),
                pa.array(sums, pa.string()),
                pa.array(places, span_type),
            ]
            names = [doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            if with_kept:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = source.schema["id"].dataType.simpleString()
    schema = (
        f"`{doc_id}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "spans array<struct<start:int,end:int>>"
    )
    return both.mapInArrow(remove, schema + (", kept binary" if with_kept else ""))
