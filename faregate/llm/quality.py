"""Quality classifier: logistic regression on hashed word n-grams, learnt by follow-the-regularised-leader.

Tokens are runs of word bytes (letters, digits, everything beyond ASCII) and
runs of punctuation. Features are single tokens and pairs of lower-cased tokens,
and one to three tokens in a row with words replaced by their shape (case,
digits), all hashed into ``2 ** BITS`` slots. A feature's value is its share of
the text's n-grams times ``SCALE``, so a score is a sparse dot product of shares
and weights, whatever the length of the text.

Learning reads at most about ``sample_rows`` labelled rows (a documented bound;
which ones follows from a hash of the id), so their ids can be broadcast, no
text of the table is shuffled, and one task can learn from them. Scoring covers
every whole text; the weights it carries are ``2 ** BITS`` numbers at most.

Ids with contradicting labels, null labels and held-out ids are not learnt from.
Null and empty texts have no feature and get the score of the bias alone.
Without any usable label all scores are one half. Repeated rows are scored alike.
An empty table gives no rows. Further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregate.llm.common import BASE, LOWER, PLACE, WORD_BYTE, field_ddl, held_out, mix, prefix_hash, slabs, span_hash

BITS, SCALE = 18, 10.0
SAMPLE_ROWS = 12_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
TRAINING = "slot int, weight double"

# Byte classes: 0 white space, 1 word, 2 punctuation; and the flags that make up a word's shape.
KIND = np.where(WORD_BYTE, 2, 0).astype(np.uint8)
FLAG = np.zeros(256, dtype=np.uint8)
for _low, _high, _flag in ((48, 58, 1), (65, 91, 2), (97, 123, 4), (128, 256, 4)):
    KIND[_low:_high] = 1
    FLAG[_low:_high] = _flag


def ngrams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of a slab, in the order of its rows, and where each row's begin."""
    kind = KIND[data]
    change = np.ones(len(data), dtype=bool)
    change[1:] = kind[1:] != kind[:-1]
    change[starts[1:-1][starts[1:-1] < len(data)]] = True
    edges = np.flatnonzero(change)
    ends = np.append(edges[1:], len(data))
    real = kind[edges] > 0
    begin, end = edges[real], ends[real]
    if not len(begin):
        return np.zeros(0, dtype=np.int64), np.zeros(len(starts), dtype=np.int64)
    token = span_hash(prefix_hash(LOWER[data]), begin, end)
    flags = np.bitwise_or.reduceat(FLAG[data], begin).astype(np.uint64)
    # a word's shape: its flags and whether it starts with a capital
    shape = mix(flags * np.uint64(8) + FLAG[data[begin]].astype(np.uint64) + np.uint64(BASE))
    shape = np.where(kind[begin] == 2, token, shape)

    first = np.searchsorted(begin, starts)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(first))
    parts, owners = [], []
    for salt, source, longest in ((1, token, 2), (2, shape, 3)):
        joined = np.full(len(source), mix(np.array([salt], dtype=np.uint64))[0])
        for n in range(longest):
            count = len(source) - n
            if count <= 0:
                break
            joined = joined[:count] + source[n:] * PLACE[n]
            inside = row[:count] == row[n:]
            parts.append((mix(joined[inside] + np.uint64(n)) & np.uint64((1 << BITS) - 1)).astype(np.int64))
            owners.append(row[:count][inside])
    slots, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return slots[order], np.searchsorted(owner[order], np.arange(len(starts)))


def learn(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> dict[int, float]:
    """Weights after all epochs; slot -1 is the bias."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(EPOCHS):
        for slots, values, label in rows:
            zi, ni = z[slots], n[slots]
            weight = np.where(
                np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
            )
            guess = 1.0 / (1.0 + np.exp(-np.clip(weight @ values, -30, 30)))
            step = (guess - label) * values
            z[slots] = zi + step - (np.sqrt(ni + step * step) - np.sqrt(ni)) / ALPHA * weight
            n[slots] = ni + step * step
    weight = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return {int(i) if i < size else -1: float(weight[i]) for i in np.flatnonzero(weight)}


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> dict[int, float]:
    """Weights learnt from a bounded sample of the labelled rows that are not held out."""
    usable = (
        labels.filter(~held_out(doc_id) & F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("label_id"))
        .agg(F.min(label).alias("least"), F.max(label).alias("label"))
        .filter("least = label and label_id is not null")
    )
    share = min(1.0, sample_rows / max(usable.count(), 1))
    draw = F.pmod(F.xxhash64("label_id", F.lit("sample")), F.lit(1 << 30))
    sample = usable.filter(draw < int(share * (1 << 30))).select("label_id", F.col("label").cast("int").alias("label"))
    # of bounded size: about sample_rows ids
    rows = (
        docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
        .join(F.broadcast(sample), F.col("id") == F.col("label_id"))
        .select("label", "text", F.xxhash64("id", "text").alias("draw"))
        .repartition(1)
        .sortWithinPartitions("draw", "text")
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            answers = batch.column(0).to_pylist()
            for first, last, data, starts in slabs(batch.column(1)):
                slots, at = ngrams(data, starts)
                for i in range(last - first):
                    own, counts = np.unique(slots[at[i] : at[i + 1]], return_counts=True)
                    values = np.append(counts * (SCALE / max(at[i + 1] - at[i], 1)), 1.0)
                    seen.append((np.append(own, 1 << BITS).astype(np.int32), values.astype(np.float32), answers[first + i]))
        weights = learn(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(weights), pa.int32()), pa.array(list(weights.values()), pa.float64())], ["slot", "weight"]
        )

    return {r["slot"]: r["weight"] for r in rows.select("label", "text").mapInArrow(train, TRAINING).collect()}


def score(docs: DataFrame, weights: dict[int, float], text: str = "text", keep: list | None = None) -> DataFrame:
    """``keep`` (columns named or built by the caller) and ``score`` between 0 and 1."""
    dense = np.zeros(1 << BITS, dtype=np.float32)
    for slot, weight in weights.items():
        if slot >= 0:
            dense[slot] = weight
    bias = weights.get(-1, 0.0)
    table = docs.sparkSession.sparkContext.broadcast(dense)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last_column = batch.num_columns - 1
            totals = np.zeros(batch.num_rows)
            for first, last, data, starts in slabs(batch.column(last_column)):
                slots, at = ngrams(data, starts)
                sums = np.concatenate(([0.0], np.cumsum(table.value[slots], dtype=np.float64)))
                totals[first:last] = (sums[at[1:]] - sums[at[:-1]]) * SCALE / np.maximum(np.diff(at), 1)
            scores = 1.0 / (1.0 + np.exp(-np.clip(np.round(totals + bias, 9), -30, 30)))
            columns = [batch.column(i) for i in range(last_column)] + [pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:last_column], "score"])

    source = docs.select(*(keep or []), F.col(f"`{text}`").alias("__text"))
    kept = field_ddl(source, *source.columns[:-1])
    return source.mapInArrow(judge, f"{kept}, score double")


def judge_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """One row per document: its id, ``held_out``, ``score``, ``predicted``."""
    weights = fit(docs, labels, doc_id, text, **options)
    scored = score(docs, weights, text, [F.col(f"`{doc_id}`").alias(doc_id), held_out(doc_id).alias("held_out")])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The rows that are not rejected, with the columns they came with."""
    weights = fit(docs, labels, doc_id, text, **options)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return score(docs, weights, text, [row]).filter("score >= 0.5").select("row.*")
