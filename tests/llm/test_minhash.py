import random
import re

import numpy as np
import pytest

from faregate.llm import minhash
from faregate.llm.common import shingles
from faregate.llm.components import components
from tests.llm.frames import awkward, documents, prose


def shingle_set(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                group[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        key = find(i)
        rank = (r[0] is None, r[0] or 0)
        least[key] = min(least.get(key, rank), rank)
    return sorted(((r[0], len(sets[i]), None if least[find(i)][0] else least[find(i)][1]) for i, r in enumerate(rows)), key=str)


def result(df):
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def edited(words, draw, edits):
    out = list(words)
    for _ in range(edits):
        out[draw.randrange(len(out))] = f"w{draw.randrange(10**6)}"
    return out


def near_copies(seed, groups, copies, words, edits):
    """Chains and clouds of copies around the threshold."""
    draw, rows = random.Random(seed), []
    for g in range(groups):
        base = prose(seed * 1000 + g, words).split()
        for _ in range(copies):
            rows.append((len(rows), " ".join(base), "en", "s0"))
            base = edited(base, draw, draw.randint(0, edits))
    draw.shuffle(rows)
    return rows


def test_awkward_rows(spark):
    assert result(minhash.near_duplicates(documents(spark, awkward()))) == brute(awkward())


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_links_like_brute_force(spark, seed, limit, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET_BYTES", limit)  # 0: all buckets go the way of large ones
    rows = near_copies(seed, groups=6, copies=8, words=60, edits=2)
    assert result(minhash.near_duplicates(documents(spark, rows, clash=False))) == brute(rows)


def test_cloud_whose_centre_is_missing(spark):
    draw = random.Random(5)
    base = prose(77, 100).split()
    rows = [(i, " ".join(edited(base, draw, draw.randint(1, 3))), "en", "s0") for i in range(60)]
    assert result(minhash.near_duplicates(documents(spark, rows, clash=False))) == brute(rows)


def test_labels_merge_like_all_pairs():
    draw = random.Random(8)
    for seed in range(20):
        rows = near_copies(seed, groups=2, copies=8, words=40, edits=2)
        texts, labels = [r[1] for r in rows], [bytes([draw.randrange(10)]) for _ in rows]
        found = minhash.merged_labels(texts, labels, 85, 5)
        sets = [shingle_set(t) for t in texts]
        links = {
            frozenset((labels[i], labels[j]))
            for i, a in enumerate(sets)
            for j, b in enumerate(sets[:i])
            if labels[i] != labels[j] and 100 * len(a & b) >= 85 * len(a | b)
        }

        def groups(pairs):
            of = {x: {x} for x in set(labels)}
            for pair in pairs:
                joined = set().union(*(of[x] for x in pair))
                for x in joined:
                    of[x] = joined
            return {frozenset(g) for g in of.values()}

        assert groups(found) == groups(links)


def test_one_of_each_component_stays(spark):
    docs = documents(spark, awkward())
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 4, 5, 6, 7, 8, 9, 10, None], key=str)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert minhash.near_duplicates(docs).count() == 0
    assert minhash.drop_near_duplicates(docs).count() == 0


def test_estimate_is_corrected_for_collisions(spark):
    from pyspark.sql import functions as F

    rows = [(i, prose(500 + i, 400), "en", "s0") for i in range(20)]
    signed = minhash.signatures(documents(spark, rows, clash=False), "doc_id", "text", 5).select("id", "packed")
    pairs = signed.crossJoin(signed.select(F.col("id").alias("other"), F.col("packed").alias("b"))).filter("id < other")
    mean = pairs.agg(F.avg(minhash.estimate(F.col("packed"), F.col("b")))).first()[0]
    assert abs(mean) < 0.02  # unrelated texts


def test_components_of_a_long_chain(spark):
    chain = [(bytes([i]), bytes([i + 1])) for i in range(60)] + [(b"x", b"y")]
    found = components(spark.createDataFrame(chain, "u binary, v binary")).collect()
    labels = {bytes(r["node"]): bytes(r["label"]) for r in found}
    assert len(found) == 63 and {labels[bytes([i])] for i in range(61)} == {b"\0"} and labels[b"y"] == b"x"


def test_shingles_depend_on_words_only():
    def of(text):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        return shingles(data, np.array([0, len(data)]))[0].tolist()

    assert of("A b  c\td e F") == of("a B c d\ne f")
    assert of("a b") != of("ab") != of("b a") and len(of("a b c d")) == 1 and of(" ") == []
