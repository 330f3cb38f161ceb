"""CSV with quoted line breaks: the same rows however small the splits are."""

import random

import pandas as pd
import pytest
from pyspark.sql import types as T

from faregate.sources import quoted_csv, tables

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def frame(seed=1, count=120):
    draw = random.Random(seed)
    bits = ["\n", "\n\n", "\r\n", '"', '""', ",", "word", "é🙂", " ", "\\", "x" * 40, '",', '\n"a","b"\n1,2,3']
    value = lambda: draw.choice([None, "plain", "".join(draw.choice(bits) for _ in range(draw.randint(1, 12)))])
    return pd.DataFrame({"id": range(count), "a": [value() for _ in range(count)], "b": [value() for _ in range(count)]})


def written(path, rows, **options):
    rows.to_csv(path, index=False, **options)
    return [(r.id, None if pd.isna(r.a) else r.a, None if pd.isna(r.b) else r.b) for r in rows.itertuples()]


def read(spark, path, split):
    rows = tables.read_foreign_csv(spark, str(path), SCHEMA, multi_line=True, split_bytes=split)
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("split", [17, 64, 333, 1 << 20])
def test_pandas_files(spark, tmp_path, split):
    want = written(tmp_path / "a.csv", frame())
    more = frame(2)
    more["id"] += 1000
    want += written(tmp_path / "b.csv", more, encoding="utf-8-sig")  # a byte order mark
    assert read(spark, tmp_path, split) == sorted(want, key=lambda r: r[0])


def test_other_line_ends(spark, tmp_path):
    rows = frame(3)
    want = written(tmp_path / "a.csv", rows, lineterminator="\r\n")
    assert read(spark, tmp_path, 50) == want


def test_one_field_over_many_splits(spark, tmp_path):
    rows = pd.DataFrame({"id": [1, 2, 3], "a": ["x", "line, \"quoted\"\n" * 3000, "y"], "b": ["\n", None, "z\n"]})
    want = written(tmp_path / "a.csv", rows)
    lines = quoted_csv.physical_lines(spark, str(tmp_path), 500)
    assert lines.rdd.getNumPartitions() > 50
    assert quoted_csv.settled_splits(lines).where("inside AND owner IS NULL").count() == 0
    assert read(spark, tmp_path, 500) == want


def test_large_tables_of_splits_are_not_broadcast(spark, tmp_path, monkeypatch):
    want = written(tmp_path / "a.csv", frame(4))
    monkeypatch.setattr(quoted_csv, "broadcast_if_small", lambda side: side)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert read(spark, tmp_path, 100) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_other_header_or_shape_is_an_error(spark, tmp_path):
    frame(5).rename(columns={"a": "z"}).to_csv(tmp_path / "a.csv", index=False)
    with pytest.raises(Exception, match="other columns"):
        read(spark, tmp_path, 100)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.csv").write_text('id,a,b\n1,"x\ny",z,too,many\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read(spark, tmp_path / "b", 100)


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("id,a,b\n")
    assert read(spark, tmp_path, 100) == []
