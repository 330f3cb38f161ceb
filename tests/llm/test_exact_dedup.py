import hashlib
import re

import pytest

from faregate.llm import exact_dedup
from tests.llm.frames import awkward, documents


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(normal, []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for doc_id, text, *_ in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[normal])
        kept = best[:3] == (-len(text or ""), doc_id is None, doc_id or 0)
        out.append((doc_id, best[3], len(groups[normal]), kept, hashlib.sha256(normal.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [1, 4, 20])
def test_marks_like_brute_force(spark, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        got = exact_dedup.mark_duplicates(documents(spark, awkward())).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == brute(awkward())


def test_one_row_of_each_text_stays(spark):
    docs = documents(spark, awkward())
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    # 1, 2, 3 and the blank texts collapse, the repeated row of 4 and its copy without an id too
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([2, 4, 7, 8, 9, 10, 11, None], key=str)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert exact_dedup.mark_duplicates(docs).count() == 0
    assert exact_dedup.drop_duplicates(docs).count() == 0
