"""Line dedup against a plain version, with ranges so narrow that keys span several."""

import hashlib
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faregate.llm import line_dedup
from tests.llm.frames import awkward, documents, prose

BLANK = " \t\n\x0b\x0c\r"


def plain(rows, least_chars=40, least_docs=5):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))

    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders.get(key(line), set()) - {None}
            if len(ids) < least_docs or doc_id == max(ids):
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(docs, **bounds):
    return sorted((tuple(r) for r in line_dedup.deduped(docs, **bounds).collect()), key=str)


def rows_with_shared_lines(n=400, seed=3):
    draw = random.Random(seed)
    common = ["The very common line that every third document of this corpus holds. "] + [
        prose(i, 9) for i in range(30)
    ] + ["ÀÉ" * 19 + "x", "ÀÉ" * 20, "short line"]
    rows = []
    for i in range(n):
        lines = [prose(1000 + i * 7 + k, draw.randint(0, 14)) for k in range(draw.randint(0, 4))]
        lines += [draw.choice(["", " ", "\t"]) + draw.choice(common).upper() + draw.choice(["", "\r", " \x0b"]) for _ in range(draw.randint(0, 3))]
        lines += [draw.choice(common) for _ in range(draw.randint(0, 4))]
        if i % 3 == 0:
            lines += [common[0]] * draw.randint(1, 3)
        draw.shuffle(lines)
        rows.append((i // 2 if i < 20 else i, "\n".join(lines), None, "s0"))
    return rows


def test_equals_a_plain_version(spark):
    rows = awkward() + [(None if r[0] == 30 else r[0] + 100, *r[1:]) for r in rows_with_shared_lines()]
    assert found(documents(spark, rows)) == plain(rows)


@pytest.mark.parametrize("least_docs", [2, 3, 30])
def test_keys_that_span_ranges(spark, least_docs):
    rows = rows_with_shared_lines(250, seed=least_docs)
    width, adaptive = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = found(documents(spark, rows), least_docs=least_docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert got == plain(rows, least_docs=least_docs)


def ranges(rows, cuts):
    """Sorted rows (key, id) cut into ranges, each in batches of two."""
    edges = [0, *cuts, len(rows)]
    for begin, end in zip(edges, edges[1:]):
        yield [
            pa.RecordBatch.from_pydict({
                "id": pa.array([r[1] for r in rows[at : min(at + 2, end)]], pa.int64()),
                "tag": pa.array([0] * (min(at + 2, end) - at), pa.int64()),
                "key": pa.array([r[0] for r in rows[at : min(at + 2, end)]], pa.binary()),
                "place": pa.array(list(range(at, min(at + 2, end))), pa.int32()),
            })
            for at in range(begin, end, 2)
        ]


def test_wherever_ranges_are_cut():
    """All cuts between documents give the same dropped lines."""
    rows = [(b"a", 9), (b"a", 9), (b"a", 7), (b"a", 5), (b"a", 4), (b"b", 8), (b"b", 3), (b"b", None), (b"c", 2), (b"c", 1), (b"c", 0)]
    between = [i for i in range(1, len(rows)) if rows[i] != rows[i - 1]]
    for mask in range(1 << len(between)):
        cuts = [c for i, c in enumerate(between) if mask >> i & 1]
        dropped, opened, sums = [], [], defaultdict(lambda: [0, -1])
        for part in ranges(rows, cuts):
            for batch in line_dedup._stream(3)(iter(part)):
                for r in batch.to_pylist():
                    if r["docs"] is not None:
                        sums[r["key"]][0] += r["docs"]
                        sums[r["key"]][1] = max(sums[r["key"]][1], -1 if r["id"] is None else r["id"])
                    elif r["key"] is None:
                        dropped.append(r["place"])
                    else:
                        opened.append((r["key"], r["id"], r["place"]))
        dropped += [p for k, i, p in opened if sums[k][0] >= 3 and i != sums[k][1]]
        assert sorted(dropped) == [2, 3, 4, 9, 10], cuts


def test_bitmaps_and_lengths(spark):
    rows = [(i, f"{prose(9, 12)}\nown line {i}", None, "s") for i in range(6)]
    got = {r["id"]: r for r in line_dedup.keep_bitmaps(documents(spark, rows)).collect()}
    import zlib

    assert {i: (r["n_lines"], r["n_dropped"], zlib.decompress(r["keep"])) for i, r in got.items()} == {
        **{i: (2, 1, b"\x40") for i in range(5)}, 5: (2, 0, b"\xc0")
    }


def test_key_lengths_are_code_points():
    assert line_dedup.line_key(("é" * 39).encode(), 40) is None
    assert line_dedup.line_key(("é" * 40).encode(), 40) is not None
    assert line_dedup.line_key(("  " + "X" * 40 + "\r").encode(), 40) == line_dedup.line_key(b"x" * 40, 40)
    assert line_dedup.line_key(("\x1c" + "X" * 39).encode(), 40) == hashlib.blake2b(b"\x1c" + b"x" * 39, digest_size=16).digest()


def test_empty_table_and_other_ids(spark):
    assert line_dedup.deduped(documents(spark, [])).count() == 0
    docs = documents(spark, rows_with_shared_lines(60)).withColumn("doc_id", F.format_string("d%05d", "doc_id"))
    rows = [(f"d{r[0]:05d}", *r[1:]) for r in rows_with_shared_lines(60)]
    assert found(docs) == plain(rows)
