import math
import zlib
from collections import Counter

import numpy as np
import pytest

from faregate.llm import language, quality
from faregate.llm.common import table
from tests.llm.frames import awkward, documents, prose

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def labelled(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


def test_quality_on_held_out_rows(labelled):
    docs, labels = labelled
    rows = quality.judge_quality(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == held(r["doc_id"]) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in out) >= 0.97 * len(out)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_change_nothing(labelled):
    from faregate.llm.common import held_out
    from pyspark.sql import functions as F

    docs, labels = labelled
    turned = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(docs, labels) == quality.fit(docs, turned)


def test_scores_are_sparse_dot_products(spark):
    rows = awkward()
    weights = {int(s): float(w) for s, w in zip(range(0, 1 << quality.BITS, 7), np.sin(np.arange(1 << 16)))}
    weights[-1] = 0.25
    got = quality.score(documents(spark, rows), weights, keep=["text"]).collect()
    for r in got:
        data = np.frombuffer((r["text"] or "").encode(), dtype=np.uint8)
        slots, _ = quality.ngrams(data, np.array([0, len(data)]))
        share = Counter(slots.tolist())
        total = sum(weights.get(s, 0.0) * n for s, n in share.items()) * quality.SCALE / max(len(slots), 1)
        assert abs(r["score"] - 1 / (1 + math.exp(-(total + 0.25)))) < 1e-5


def test_ngrams_do_not_cross_rows():
    texts = [b"One two!! three", b"", b"  ", b"One two!! three", b"x"]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    slots, at = quality.ngrams(data, starts)
    each = [slots[a:b].tolist() for a, b in zip(at, at[1:])]
    for text, own in zip(texts, each):
        alone = np.frombuffer(text, dtype=np.uint8)
        assert own == quality.ngrams(alone, np.array([0, len(text)]))[0].tolist()
    # one, two, !!, three: four tokens, three pairs; shapes: four, three, two
    assert len(each[0]) == 16 and each[1] == each[2] == [] and len(each[4]) == 2


def test_ftrl_learns_a_separating_slot():
    rows = [(np.array([i % 2, 2, 1 << quality.BITS]), np.array([1.0, 1.0, 1.0]), i % 2) for i in range(200)]
    weights = quality.learn(rows)
    assert weights[1] > 0.5 > -0.5 > weights[0]


def test_quality_without_labels_and_on_awkward_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    docs = documents(spark, awkward())
    assert {r["score"] for r in quality.judge_quality(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1), (8, 0), (8, 1), (None, 1), (9, None)], "doc_id bigint, quality int")
    kept = quality.drop_low_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(awkward())
    assert quality.judge_quality(documents(spark, []), labels).count() == 0


def test_languages_of_held_out_rows(labelled):
    docs, _ = labelled
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in out) >= 0.98 * len(out)
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)


def plain_bundle(text):
    """One vector at a time, bound and added as the definition says."""
    cleaned = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
    while "  " in cleaned:
        cleaned = cleaned.replace("  ", " ")
    total = np.zeros(language.SIZE)
    for a, b, c in zip(cleaned, cleaned[1:], cleaned[2:]):
        v = language.letter_vectors(np.array([ord(a), ord(b), ord(c)]))
        total += np.roll(v[0], 2).astype(int) * np.roll(v[1], 1) * v[2]
    return total


def test_bundles_like_one_at_a_time(monkeypatch):
    texts = [None, "", "12 !", "a", "Été, naïve", "漢字 かな " * 5, prose(5, 30), "a" * 50]
    expected = np.stack([plain_bundle(t) for t in texts])
    assert (language.bundles(texts) == expected).all()
    monkeypatch.setattr(language, "TRIGRAMS", 7)  # many parts
    assert (language.bundles(texts) == expected).all()


def test_language_of_awkward_rows(spark):
    got = language.identify(documents(spark, awkward())).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(awkward())
    for i in (5, 6, 7):
        assert by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0
    unknown = [(i, "some words", None, "s") for i in range(4)]
    assert {r["lang_pred"] for r in language.identify(documents(spark, unknown)).collect()} == {"und"}
    assert language.identify(documents(spark, [])).count() == 0
