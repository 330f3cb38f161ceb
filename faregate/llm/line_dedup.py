"""Line dedup: a line that many documents hold stays in one of them.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at either end, A-Z in lower
case. A key of ``least_chars`` code points or more that ``least_docs`` documents
hold loses all its lines except in the largest id that holds it.

1. Each task splits whole texts and gives, per line with a key long enough, its
   128-bit hash, the document and the line's place; and one row per document with
   its number of lines. Both are written once, as a table without texts.
2. Lines are range-partitioned by hash and document and sorted by hash, document
   (largest first) and place. A task streams its range: the first document of a key
   keeps its lines, the lines of at most ``least_docs - 2`` further ones wait, and
   from the document that makes up the number on, lines are dropped as they come.
3. A key with many lines spans ranges. Of a range only the first and the last key
   can be cut off, so their open lines leave with the key, beside one row with the
   documents counted here and the largest; those rows are added up by key, and the
   open lines are settled by a join with the sums. Such rows number at most two per
   range. The lines of one document with one key are never cut apart.
4. Dropped places are gathered by document into a compressed bitmap of kept lines.

``keep_bitmaps`` returns those bitmaps; ``deduped`` joins them to the texts.

Null and empty texts are one empty line. Rows of one id count as one document; they
may differ in their texts, so a row is known by its id and a hash of its text. Rows
without an id count for no key and are never the one that keeps it. Equal rows have
equal bitmaps. An empty table gives no rows. Further columns are not read; ids may
have any type that sorts. Two keys are held equal by 128 bits of BLAKE2b. A text is
split as one value: a task needs a few times its bytes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregate.llm.common import field_ddl
from faregate.operators.joins import broadcast_if_small
from faregate.operators.layout import written

LEAST_CHARS = 40
LEAST_DOCS = 5
BLANKS = b" \t\n\x0b\x0c\r"  # fixed value: what the contract strips
ROWS_OUT = 50_000  # of lines in one batch


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """The hash of a line's key, or None where that is too short."""
    key = line.strip(BLANKS).lower()  # of bytes, so A-Z only
    if len(key) < least_chars or (len(key) < 4 * least_chars and len(key.decode()) < least_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _split(least_chars: int):
    """Rows ``id, tag, key, place`` of long enough lines, and of each document one with the number of lines."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            keys: list[bytes | None] = []
            places: list[int] = []

            def made() -> pa.RecordBatch:
                at = pa.array(rows, pa.int64())
                columns = [batch.column("id").take(at), batch.column("tag").take(at), pa.array(keys, pa.binary()), pa.array(places, pa.int32())]
                return pa.RecordBatch.from_arrays(columns, ["id", "tag", "key", "place"])

            texts = batch.column("value").cast(pa.binary())
            for row in range(batch.num_rows):
                lines = (texts[row].as_py() or b"").split(b"\n")
                rows.append(row), keys.append(None), places.append(len(lines))
                for place, line in enumerate(lines):
                    if len(line) >= least_chars and (key := line_key(line, least_chars)) is not None:
                        rows.append(row), keys.append(key), places.append(place)
                if len(rows) >= ROWS_OUT:
                    yield made()
                    rows, keys, places = [], [], []
            if rows:
                yield made()

    return task


def _stream(least_docs: int):
    """Decide a sorted range: rows ``id, tag, place`` to drop, open ones with their key, and sums of cut keys."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: bytes | None = None  # the key at hand
        first_key = True  # it may have begun in the range before
        docs = 0  # its documents so far, those without an id left out
        top = last = None  # its first document and the one at hand
        waiting: list[pa.RecordBatch] = []  # lines that drop if enough documents follow
        schema: pa.Schema | None = None

        def out(lines: pa.RecordBatch, open_key: bytes | None) -> pa.RecordBatch:
            n = lines.num_rows
            return pa.RecordBatch.from_arrays(
                [
                    lines.column("id"), lines.column("tag"), lines.column("place"),
                    pa.array([open_key] * n, pa.binary()), pa.nulls(n, pa.int64()),
                ],
                ["id", "tag", "place", "key", "docs"],
            )

        def summed() -> pa.RecordBatch:
            values = [pa.array([top], schema.field("id").type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32())]
            return pa.RecordBatch.from_arrays(
                [*values, pa.array([key], pa.binary()), pa.array([docs], pa.int64())], ["id", "tag", "place", "key", "docs"]
            )

        for batch in batches:
            schema = batch.schema
            n = batch.num_rows
            if not n:
                continue
            # starts of the runs of one key and document in this batch
            ids, keys = batch.column("id"), batch.column("key")
            same = pc.and_(
                pc.equal(keys[1:], keys[:-1]),
                pc.or_(pc.fill_null(pc.equal(ids[1:], ids[:-1]), False), pc.and_(pc.is_null(ids[1:]), pc.is_null(ids[:-1]))),
            )
            starts = [0, *(np.flatnonzero(~np.asarray(same)) + 1).tolist()] if n > 1 else [0]
            run_ids, run_keys = ids.take(pa.array(starts)).to_pylist(), keys.take(pa.array(starts)).to_pylist()
            gone: list[pa.RecordBatch] = []
            opened = [0, 0, key]  # lines of the first key in this batch
            for begin, end, doc, own in zip(starts, [*starts[1:], n], run_ids, run_keys):
                if own != key:
                    if key is not None and first_key:
                        yield summed()
                    first_key = key is None
                    key, docs, top, last, waiting = own, 0, doc, None, []
                    new_doc = True
                else:
                    new_doc = doc != last
                if new_doc and doc is not None:
                    docs += 1
                last = doc
                if first_key:
                    opened = [opened[0], end, key]
                elif docs == 1 and doc is not None:
                    continue  # the largest document keeps its lines
                elif docs >= least_docs:
                    gone += [*waiting, batch.slice(begin, end - begin)]
                    waiting = []
                elif doc is not None:  # ids that are missing come last, so without enough others they stay
                    waiting.append(batch.slice(begin, end - begin))
            if opened[1]:
                yield out(batch.slice(0, opened[1]), opened[2])
            if gone:
                yield out(pa.Table.from_batches(gone).combine_chunks().to_batches()[0], None)
        if key is not None:
            if not first_key:
                for held in waiting:
                    yield out(held, key)
            yield summed()

    return task


def dropped_lines(lines: DataFrame, least_docs: int) -> DataFrame:
    """``id, tag, place`` of the lines that go; ``lines`` is a written table of ``id, tag, key, place``."""
    order = ["key", F.col("id").desc_nulls_last()]
    ranged = lines.where("key IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order, "tag", "place")
    ddl = f"{field_ddl(lines, 'id', 'tag', 'place')}, key binary, docs bigint"
    decided = written(ranged.mapInArrow(_stream(least_docs), ddl))
    cut = (
        decided.where("docs IS NOT NULL")
        .groupBy("key")
        .agg(F.sum("docs").alias("total"), F.max("id").alias("top"))
        .where(F.col("total") >= least_docs)
    )
    cut = broadcast_if_small(written(cut))
    opened = decided.where("docs IS NULL AND key IS NOT NULL").join(cut, "key")
    settled = opened.where(~F.col("id").eqNullSafe(F.col("top"))).select("id", "tag", "place")
    return decided.where("docs IS NULL AND key IS NULL").select("id", "tag", "place").unionByName(settled)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, bits = [], []
        for n, places in zip(batch.column("n_lines").to_pylist(), batch.column("places")):
            keep = np.ones(n, dtype=bool)
            keep[np.asarray(places.values)] = False
            counts.append(n - int(keep.sum()))
            bits.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("tag"), batch.column("n_lines"), pa.array(counts, pa.int64()), pa.array(bits, pa.binary())],
            ["id", "tag", "n_lines", "n_dropped", "keep"],
        )


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").alias("id"), value.alias("value")).withColumn("tag", F.xxhash64("value"))


def keep_bitmaps(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """``id, tag, n_lines, n_dropped, keep`` per id and text: packed bits of the lines that stay, deflated."""
    if least_docs < 2:
        raise ValueError("a line is a repeated one from two documents on")
    named = _named(docs, doc_id, text)
    ddl = field_ddl(named, "id", "tag")
    lines = written(named.mapInArrow(_split(least_chars), f"{ddl}, key binary, place int"))
    heads = lines.where("key IS NULL").select("id", "tag", F.col("place").alias("n"), F.lit(None).cast("int").alias("place"))
    gone = dropped_lines(lines, least_docs).select("id", "tag", F.lit(None).cast("int").alias("n"), "place")
    # a set, so that equal rows collapse: a document has fewer places than lines
    gathered = (
        heads.unionByName(gone)
        .groupBy("id", "tag")
        .agg(F.max("n").cast("bigint").alias("n_lines"), F.collect_set("place").alias("places"))
    )
    return gathered.mapInArrow(_bitmaps, f"{ddl}, n_lines bigint, n_dropped bigint, keep binary")


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("value").cast(pa.binary())
        out = []
        for row, (n, gone, bits) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n_lines", "n_dropped", "keep")))):
            if not gone:
                out.append(texts[row].as_py())
                continue
            keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8), count=n)
            lines = texts[row].as_py().split(b"\n")
            out.append(b"\n".join([lines[i] for i in np.flatnonzero(keep)]))
        kept = pa.array(out, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n_lines"), batch.column("n_dropped"), kept], ["id", "n_lines", "n_dropped", "kept"]
        )


def deduped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """``id, n_lines, n_dropped, kept`` per document; ``kept`` is its text without the dropped lines.

    The only place where texts are shuffled: each meets its bitmap once.
    """
    named = _named(docs, doc_id, text)
    bits = keep_bitmaps(docs, doc_id, text, **bounds).withColumnsRenamed({"id": "of", "tag": "mark"})
    joined = named.join(bits, F.col("id").eqNullSafe(F.col("of")) & (F.col("tag") == F.col("mark")))
    ddl = f"{field_ddl(named, 'id')}, n_lines bigint, n_dropped bigint, kept string"
    return joined.select("id", "value", "n_lines", "n_dropped", "keep").mapInArrow(_join_lines, ddl)
