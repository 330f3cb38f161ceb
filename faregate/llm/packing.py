"""Best-fit packing planned on the histogram of lengths.

Documents are cut into pieces of at most ``size`` tokens. Only the count of
pieces of each length goes to the driver (``size`` numbers at most, however
large the corpus is). Best fit decreasing runs over these counts: it fills the
fullest sequences that still have room, many at a time, and leaves slot ranges
such as "pieces of length 300 with ranks 5000 to 9000 go to sequences 70 and
on, at offset 724". Every piece then takes its slot by its rank within its
length. Ranks need no shuffle of texts or tokens: a task numbers its own pieces
per length, and a running sum over tasks gives each task its first rank.

Null and empty texts are documents of one token, the end id. Repeated rows and
repeated ids are packed as often as they come. Null ids stay null. An empty
table gives no rows. Further columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faregate.llm.common import field_ddl
from faregate.operators.layout import written

# The vocabulary's files, its special token, its word pattern written without backtracking.
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
BEYOND = re.compile("[^\x00-ԯ]")

_ENCODERS: dict[tuple[str, str], tuple] = {}


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids as the vocabulary file gives them.

    Texts of characters up to U+052F, whose classes every library knows alike,
    go through the same vocabulary's rank file, which is about five times as
    fast; all other texts go through the vocabulary file itself. The tests hold
    both ways against each other.
    """

    def __init__(self, vocabulary: str, ranks: str) -> None:
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.quick = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={SPECIAL: SPECIAL_ID}
        )
        self.slow = Tokenizer.from_file(vocabulary)

    def __call__(self, text: str) -> np.ndarray:
        if BEYOND.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.quick.encode_to_numpy(text, allowed_special="all")


def encoder(vocabulary: str | None, ranks: str | None) -> Encoder:
    key = (vocabulary or public_path(VOCABULARY), ranks or public_path(RANKS))
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 1024,
    end_id: int = 2,
    vocabulary: str | None = None,
    ranks: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Tokens of each document in pieces, with the writing task and the rank within length there."""
    ids_ddl = ", ids array<int>" if with_ids else ""
    schema = (
        f"{field_ddl(docs, doc_id)}, piece int, start bigint, length bigint, ids_crc32 bigint, "
        f"task int, local_rank bigint{ids_ddl}"
    )
    chunk = 512

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(vocabulary, ranks), np.zeros(size + 1, dtype=np.int64)
        task = TaskContext.get().partitionId()
        for whole in batches:
            for first in range(0, whole.num_rows, chunk):
                batch = whole.slice(first, chunk)
                row, number, start, length, check, ids = [], [], [], [], [], []
                for i, value in enumerate(batch.column(1).to_pylist()):
                    tokens = np.append(encode(value or ""), end_id).astype("<u4")
                    cuts = [0, *range(len(tokens) % size or size, len(tokens) + 1, size)]
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                        row.append(i)
                        number.append(k)
                        start.append(a)
                        length.append(b - a)
                        check.append(zlib.crc32(tokens[a:b].tobytes()))
                        if with_ids:
                            ids.append(tokens[a:b].astype(np.int32))
                lengths = np.array(length, dtype=np.int64)
                order = np.argsort(lengths, kind="stable")
                same = lengths[order]
                place = np.arange(len(same)) - np.searchsorted(same, same)
                rank = np.empty(len(same), dtype=np.int64)
                rank[order] = place + seen[same]
                seen += np.bincount(lengths, minlength=size + 1)
                columns = [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(lengths),
                    pa.array(check, pa.int64()),
                    pa.array(np.full(len(row), task, dtype=np.int32)),
                    pa.array(rank),
                ]
                names = [doc_id, "piece", "start", "length", "ids_crc32", "task", "local_rank"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(doc_id, text).mapInArrow(cut, schema)


def plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slot ranges by best fit decreasing over counts.

    Each is (length, first rank, last rank + 1, first sequence, pieces per
    sequence, offset of the first). Sequences with equal room are kept as
    ranges, so the work follows the number of lengths, not of pieces.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
    slots, unused = [], 0
    for length in range(size, 0, -1):
        left, rank = histogram.get(length, 0), 0
        while left:
            best = next((r for r in range(length, size) if room[r]), None)
            if best is not None:
                lo, hi = room[best].pop()
                take = min(left, hi - lo)
                slots.append((length, rank, rank + take, lo, 1, size - best))
                if lo + take < hi:
                    room[best].append((lo + take, hi))
                if best > length:
                    room[best - length].append((lo, lo + take))
            else:
                each = size // length
                full, rest = divmod(left, each)
                take = left
                slots.append((length, rank, rank + left, unused, each, 0))
                if full and size > each * length:
                    room[size - each * length].append((unused, unused + full))
                if rest:
                    room[size - rest * length].append((unused + full, unused + full + 1))
                unused += full + bool(rest)
            rank += take
            left -= take
    return slots


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 1024, **options) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``)."""
    table = written(pieces(docs, doc_id, text, size, **options))
    counts = table.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        F.col("task").alias("base_task"),
        F.col("length").alias("base_length"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
    )
    ranked = table.join(
        bases, (F.col("task") == F.col("base_task")) & (F.col("length") == F.col("base_length"))
    ).withColumn("rank", F.col("base") + F.col("local_rank"))

    slots = np.array(sorted(plan(histogram, size)), dtype=np.int64).reshape(-1, 6)
    kept = [doc_id, "piece", "start", "length", "ids_crc32", *(["ids"] if "ids" in table.columns else [])]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # (length, rank) as one sorted key: a length's ranks lie between two whole parts
        span = int(slots[:, 2].max(initial=0)) + 1
        lows = slots[:, 0] * span + slots[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            slot = slots[np.searchsorted(lows, length * span + rank, side="right") - 1]
            nth = rank - slot[:, 1]
            columns = [batch.column(n) for n in kept]
            columns += [pa.array(slot[:, 3] + nth // slot[:, 4]), pa.array(slot[:, 5] + nth % slot[:, 4] * length)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    schema = field_ddl(ranked, *kept) + ", sequence_id bigint, offset bigint"
    return ranked.select(*kept, "rank").mapInArrow(take, schema)
