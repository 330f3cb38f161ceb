"""Versioned tables: merges by key, failed and repeated writers, compaction."""

import random

import pytest
from pyspark.sql import functions as F

from faregate.operators import snapshots

SCHEMA = "day string, id bigint, v string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def listed(spark, root, version=None):
    return {r["file"]: (r["bytes"], r["rows"], r["stamp"], r["part"]) for r in snapshots.files(spark, root, version).collect()}


def start(spark, root, by="day", n=300):
    base = [(f"2024-01-0{1 + i % 4}" if i % 17 else None, i, f"v{i}") for i in range(n)]
    snapshots.create(spark.createDataFrame(base, SCHEMA), root, by=by, delivery="d0")
    return base


def merged(base, changes):
    """Plain: last change of a key by its order."""
    table = {(d, i): v for d, i, v in base}
    for d, i, v, gone, _ in sorted(changes, key=lambda c: c[4]):
        table.pop((d, i), None) if gone else table.__setitem__((d, i), v)
    return sorted(((d, i, v) for (d, i), v in table.items()), key=str)


CHANGES = SCHEMA + ", gone boolean, at int"


@pytest.mark.parametrize("by", ["day", None])
def test_merge_equals_a_plain_one(spark, out, by):
    base = start(spark, out, by)
    draw = random.Random(2)
    changes = [(None if i % 17 == 0 else f"2024-01-0{1 + i % 4}", i, f"new{k}", draw.random() < 0.3, k) for k, i in enumerate(draw.choices(range(0, 330, 3), k=120))]
    df = spark.createDataFrame(changes, CHANGES)
    assert snapshots.merge(df, out, ["day", "id"], "d1", deleted="gone", order="at", by=by) == 2
    assert rows_of(snapshots.read(spark, out)) == merged(base, changes)
    assert rows_of(snapshots.read(spark, out, version=1)) == sorted(base, key=str)


def test_other_days_keep_their_files(spark, out):
    base = start(spark, out)
    before = listed(spark, out)
    change = spark.createDataFrame([("2024-01-02", 1, "x", False, 0), ("2024-01-02", 9001, "y", False, 0)], CHANGES)
    snapshots.merge(change, out, ["day", "id"], "d1", deleted="gone", order="at", by="day")
    after = listed(spark, out)
    for file, entry in before.items():
        assert (entry[3] == "2024-01-02") or after.get(file) == entry
    assert rows_of(snapshots.read(spark, out, parts=["2024-01-02"])) == merged(
        [r for r in base if r[0] == "2024-01-02"], [("2024-01-02", 1, "x", False, 0), ("2024-01-02", 9001, "y", False, 0)]
    )


def test_failed_and_repeated_writers(spark, out, monkeypatch):
    base = start(spark, out)
    changes = [("2024-01-02", 1, "x", False, 0), ("2024-01-03", 2, "y", True, 0)]
    df = spark.createDataFrame(changes, CHANGES)

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(snapshots, "_commit", fails)  # files and list are there, the version is not
        with pytest.raises(OSError):
            snapshots.merge(df, out, ["day", "id"], "d1", deleted="gone", by="day")
    assert rows_of(snapshots.read(spark, out)) == sorted(base, key=str)
    for _ in range(2):
        assert snapshots.merge(df, out, ["day", "id"], "d1", deleted="gone", by="day") == 2
    assert rows_of(snapshots.read(spark, out)) == merged(base, changes)
    assert [v["delivery"] for v in snapshots.versions(spark, out)] == ["d0", "d1"]


def test_a_version_is_committed_once(spark, out):
    start(spark, out)
    before = rows_of(snapshots.read(spark, out))
    commit = snapshots.add_files(spark.createDataFrame([("x", 1, "lost")], SCHEMA), out, "day")
    with pytest.raises(snapshots.VersionTaken):
        snapshots._list_and_commit(spark, out, 0, None, commit, "merge", "late", snapshots.read(spark, out).schema)
    assert rows_of(snapshots.read(spark, out)) == before
    with pytest.raises(snapshots.VersionTaken):
        start(spark, out)


def test_compaction_leaves_large_files(spark, out):
    big = spark.range(20_000).select(F.lit("d").alias("day"), "id", F.md5(F.col("id").cast("string")).alias("v")).coalesce(1)
    small = spark.range(20_000, 20_400).select(F.lit("d").alias("day"), "id", F.lit("s").alias("v")).repartition(20)
    snapshots.create(big.unionByName(small), out)
    before = listed(spark, out)
    largest = max(before, key=lambda f: before[f][0])
    size = before[largest][0]
    assert snapshots.compact(spark, out, file_bytes=size) == 2
    after = listed(spark, out)
    assert after[largest] == before[largest] and len(after) == 2 and sum(e[1] for e in after.values()) == 20_400
    assert rows_of(snapshots.read(spark, out)) == rows_of(snapshots.read(spark, out, version=1))
    assert snapshots.compact(spark, out, file_bytes=size, small_bytes=100) == 2  # nothing to gain


def test_compaction_by_day(spark, out):
    days = spark.range(600).select(F.concat(F.lit("day "), (F.col("id") % 3).cast("string")).alias("day"), "id", F.lit("v").alias("v"))
    snapshots.create(days.where("id < 200"), out, by="day")
    for k in (200, 400):
        part = days.where(f"id >= {k} AND id < {k + 200}")
        snapshots.merge(part, out, ["day", "id"], f"d{k}", by="day")
    assert len(listed(spark, out)) == 9
    snapshots.compact(spark, out, by="day")
    after = listed(spark, out)
    assert sorted(e[3] for e in after.values()) == ["day 0", "day 1", "day 2"]
    assert rows_of(snapshots.read(spark, out)) == rows_of(days)


def test_empty_tables(spark, out):
    snapshots.create(spark.createDataFrame([], SCHEMA), out, by="day")
    assert rows_of(snapshots.read(spark, out)) == []
    rows = spark.createDataFrame([("d", 1, "v"), (None, None, None)], SCHEMA)
    snapshots.merge(rows, out, ["day", "id"], "d1", by="day")
    assert rows_of(snapshots.read(spark, out)) == rows_of(rows)
    snapshots.merge(rows.withColumn("gone", F.lit(True)), out, ["day", "id"], "d2", deleted="gone", by="day")
    assert rows_of(snapshots.read(spark, out)) == []


def test_bins(spark):
    rows = [(f"f{i}", size, None) for i, size in enumerate([10, 20, 30, 40, 95, 5])]
    packed = snapshots.bins(spark.createDataFrame(rows, "file string, bytes bigint, part string"), 50, 90)
    assert {r["file"]: r["bin"] for r in packed.collect()} == {"f5": 0, "f0": 0, "f1": 0, "f2": 0}
