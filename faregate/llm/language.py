"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ones and minus ones, drawn from its code
point. A trigram's vector binds its letters: the first letter's vector permuted
twice, the second's once, the third's as it is, multiplied place by place. A
text's vector bundles (adds) the vectors of its trigrams, and a language's
prototype bundles the normalised vectors of the texts known to be in it. The
prediction is the prototype with the greatest cosine, the score is that cosine.

Texts are lower-cased; everything that is no letter is one space. Bundling is a
product of trigram counts with the trigrams' vectors, a few hundred texts at a
time, so memory follows neither the corpus nor the alphabet.

Prototypes are learnt from about ``sample_rows`` texts per language (a documented
bound; which ones follows from a hash). Sums are of whole numbers, so the order
in which tasks finish does not matter.

Null texts and texts without a letter are ``und`` with score 0, as is every text
when there is nothing to learn from. Null ids count as not held out; rows with a
null language are not learnt from. Repeated rows are predicted alike. An empty
table gives no rows. Further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregate.llm.common import field_ddl, held_out, mix
from faregate.operators.joins import broadcast_if_small

SIZE = 1024  # places of a vector
SAMPLE_ROWS = 2_000
TEXTS, CHARS, TRIGRAMS = 256, 1 << 20, 8_192  # worked on at once
UNIT = 1 << 20  # a normalised vector in whole numbers
SPACE, POINTS = 32, 0x110000
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(POINTS)), dtype=bool, count=POINTS))
    return _LETTERS[0]


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """A row of ``SIZE`` ones and minus ones per code point."""
    words = np.arange(SIZE // 64, dtype=np.uint64)
    bits = mix(mix(points.astype(np.uint64) + np.uint64(1))[:, None] + words * np.uint64(0x9E3779B97F4A7C15))
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points present, per trigram its three places among them, and per trigram its text."""
    padded = [f" {(t or '').lower()} " for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(padded)), [len(p) for p in padded])
    points = np.where(letters()[points], points, SPACE)
    new_text = np.ones(len(points), dtype=bool)
    new_text[1:] = owner[1:] != owner[:-1]
    again = np.zeros(len(points), dtype=bool)
    again[1:] = (points[1:] == SPACE) & (points[:-1] == SPACE)
    stays = ~again | new_text
    points, owner = points[stays], owner[stays]
    present = np.zeros(POINTS, dtype=bool)
    present[points] = True
    known = np.flatnonzero(present)
    place = np.zeros(POINTS, dtype=np.int64)
    place[known] = np.arange(len(known))
    code = place[points]
    gap = points == SPACE
    # texts meet in two spaces, which no trigram spans
    whole = ~(gap[1:-1] & (gap[:-2] | gap[2:])) if len(code) > 2 else np.zeros(0, dtype=bool)
    three = np.stack([code[:-2], code[1:-1], code[2:]]) if len(code) > 2 else np.zeros((3, 0), dtype=np.int64)
    return known, three[:, whole], owner[1:-1][whole] if len(code) > 2 else np.zeros(0, dtype=np.int64)


def bundles(texts: list[str | None]) -> np.ndarray:
    """One vector per text; all zeros where it has no letter."""
    known, three, owner = trigrams(texts)
    out = np.zeros((len(texts), SIZE), dtype=np.float64)
    if not three.size:
        return out
    wide = len(known)
    keys = (three[0] * wide + three[1]) * wide + three[2]
    if wide**3 <= 1 << 22:
        seen = np.zeros(wide**3, dtype=bool)
        seen[keys] = True
        distinct = np.flatnonzero(seen)
        number = np.zeros(wide**3, dtype=np.int64)
        number[distinct] = np.arange(len(distinct))
        number = number[keys]
    else:
        distinct, number = np.unique(keys, return_inverse=True)
    if len(distinct) > TRIGRAMS:
        order = np.argsort(number, kind="stable")
        number, owner = number[order], owner[order]
    third = letter_vectors(known)
    second, first = np.roll(third, 1, axis=1), np.roll(third, 2, axis=1)
    for low in range(0, len(distinct), TRIGRAMS):
        part = distinct[low : low + TRIGRAMS]
        bound = first[part // (wide * wide)] * second[part // wide % wide] * third[part % wide]
        a, b = (0, len(number)) if len(distinct) <= TRIGRAMS else np.searchsorted(number, [low, low + len(part)])
        cells = owner[a:b] * len(part) + (number[a:b] - low)
        counts = np.bincount(cells, minlength=len(texts) * len(part)).reshape(len(texts), len(part))
        out += counts.astype(np.float32) @ bound.astype(np.float32)
    return out


def batches_of(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts small enough to be worked on at once."""
    first, held = 0, 0
    for i, value in enumerate(texts):
        size = len(value or "")
        if i > first and (i - first >= TEXTS or held + size > CHARS):
            yield first, texts[first:i]
            first, held = i, 0
        held += size
    if first < len(texts):
        yield first, texts[first:]


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 0, length, 1.0)


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS
) -> dict[str, np.ndarray]:
    """A prototype per language, learnt from a bounded sample of its texts."""
    known = docs.select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), F.xxhash64(f"`{doc_id}`", f"`{text}`").alias("draw")
    ).filter(~held_out_of(docs, doc_id) & F.col("lang").isNotNull())
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sample = known.join(broadcast_if_small(counts), "lang").filter(
        F.pmod("draw", F.lit(1 << 30)) < F.lit(sample_rows) / F.col("n") * (1 << 30)
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, texts in batches_of(batch.column(1).to_pylist()):
                vectors = np.rint(unit(bundles(texts)) * UNIT).astype(np.int64)
                for i, vector in enumerate(vectors):
                    total[names[first + i]] = total.get(names[first + i], 0) + vector
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), pa.array(list(total.values()), pa.list_(pa.int64()))], ["lang", "vector"]
            )

    parts = sample.select("lang", "text").mapInArrow(learn, "lang string, vector array<bigint>")
    summed = parts.select("lang", F.posexplode("vector").alias("place", "value"))
    summed = summed.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    vectors = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("vector"))
    # one vector per language, however many texts there are
    found = {r["lang"]: np.array([v["value"] for v in r["vector"]], dtype=np.float64) for r in vectors.collect()}
    return {name: found[name] for name in sorted(found) if found[name].any()}


def held_out_of(docs: DataFrame, doc_id: str):
    return held_out(f"`{doc_id}`")


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **options
) -> DataFrame:
    """One row per document: its id, ``held_out``, ``lang_pred``, ``score``."""
    prototypes = fit(docs, doc_id, text, lang, **options)
    names = [*prototypes, UNKNOWN]
    table = unit(np.stack(list(prototypes.values()))) if prototypes else np.zeros((0, SIZE))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = np.full(batch.num_rows, len(table)), np.zeros(batch.num_rows)
            for first, texts in batches_of(batch.column(2).to_pylist()):
                vectors = bundles(texts)
                if len(table):
                    cosine = np.round(unit(vectors) @ table.T, 9)
                    rows = slice(first, first + len(texts))
                    blank = ~vectors.any(axis=1)
                    best[rows] = np.where(blank, len(table), cosine.argmax(axis=1))
                    score[rows] = np.where(blank, 0.0, np.clip(cosine.max(axis=1), 0.0, 1.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([names[i] for i in best], pa.string()), pa.array(score)],
                [doc_id, "held_out", "lang_pred", "score"],
            )

    source = docs.select(
        F.col(f"`{doc_id}`").alias(doc_id), held_out_of(docs, doc_id).alias("held_out"), F.col(f"`{text}`").alias("__text")
    )
    return source.mapInArrow(
        predict, f"{field_ddl(source, doc_id)}, held_out boolean, lang_pred string, score double"
    )
