"""Change points, quarantined lines and weighted samples against plain versions."""

import datetime
import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate.operators import drift, sampling
from faregate.sources import quarantine


def day(i):
    return str(datetime.date(2024, 1, 1) + datetime.timedelta(i))


def table(spark, shares, per_day=400, seed=1):
    """Rows of days with given shares of missing values per column."""
    draw = random.Random(seed)
    days = len(next(iter(shares.values())))
    rows = [
        (day(i), *[None if draw.random() < share[i] else 1 for share in shares.values()]) for i in range(days) for _ in range(per_day)
    ]
    return spark.createDataFrame(rows, "day string, " + ", ".join(f"`{c}` int" for c in shares))


def test_planted_days(spark):
    shares = {
        "new": [1.0] * 6 + [0.0] * 14,
        "gone": [0.1] * 15 + [1.0] * 5,
        "steps": [0.1] * 5 + [0.5] * 5 + [0.2] * 5 + [0.7] * 5,
        "steady": [0.3] * 20,
        "full": [0.0] * 20,
        "a.b": [0.0] * 19 + [0.6],
    }
    got = drift.change_points(table(spark, shares), "day", list(shares)).collect()
    assert sorted((r["column"], r["day"], r["kind"]) for r in got) == sorted([
        ("new", day(6), "appeared"), ("gone", day(15), "vanished"), ("steps", day(5), "drifted"),
        ("steps", day(10), "drifted"), ("steps", day(15), "drifted"), ("a.b", day(19), "drifted"),
    ])
    for r in got:
        at = (datetime.date.fromisoformat(r["day"]) - datetime.date(2024, 1, 1)).days
        assert abs(r["share_before"] - shares[r["column"]][at - 1]) < 0.07 and abs(r["share_after"] - shares[r["column"]][at]) < 0.07


def test_best_cut_is_the_best_of_all(spark):
    shares = {"x": [random.Random(i).random() for i in range(12)]}
    df = table(spark, shares, per_day=60)
    rows = Counter((r["day"], r["x"] is None) for r in df.collect())
    scores = {}
    for cut in range(1, 12):
        cells = [[sum(rows[day(i), missing] for i in side) for missing in (True, False)] for side in (range(cut), range(cut, 12))]
        (a, b), (c, d) = cells
        scores[cut] = (a * d - b * c) ** 2 * (a + b + c + d) / ((a + b) * (c + d) * (a + c) * (b + d))
    best = max(scores, key=scores.get)
    days = drift.missing_per_day(df, "day", ["x"]).withColumn("stretch", F.lit(0))
    found = drift.best_cuts(days, 0.0, 0.0).first()
    assert found["day"] == day(best) and abs(found["score"] - scores[best]) < 1e-9


def test_days_missing_and_no_rows(spark):
    df = spark.createDataFrame([(None, None), ("2024-01-01", None), ("2024-01-01", 1)], "day string, x int")
    assert drift.change_points(df, "day", ["x"]).count() == 0
    assert drift.change_points(df.limit(0), "day", ["x"]).count() == 0


SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("odd name.x", T.DoubleType()),
    T.StructField("list", T.ArrayType(T.LongType())),
])
LINES = [
    ('{"id": 1, "a": "é🙂", "odd name.x": 1.5, "list": [1, 2]}', None),
    ("", "blank"), ("   ", "blank"), ("{", "not JSON"), ('{"id": 1} trailing', "not JSON"), ("[1]", "not an object"), ("7", "not an object"),
    ("null", "not an object"), ('{"id": 1}], [2', "not JSON"), ('{"id": 1}, {"id": 2}', "not JSON"), ('{"id": 1}, "y": 2', "not JSON"),
    ('{"id": "x"}', "type of id"), ('{"id": 2, "odd name.x": "wide"}', "type of odd name.x"), ('{"id": 3, "list": [1, "b"]}', "type of list"),
    ('{"a": "no id"}', "no id"), ('{"id": null}', "no id"), ('{"id": 4}', None), ('{"id": 5, "more": {"x": 1}}', None),
]


@pytest.mark.parametrize("split", [90, 1 << 20])
def test_quarantine(spark, tmp_path, split):
    draw, want = random.Random(3), []
    for name in ("one.json", "two.json"):
        lines = [draw.choice(LINES) for _ in range(150)]
        (tmp_path / name).write_text("\n".join(text for text, _ in lines) + "\n")
        want += [(name, *line) for line in lines]
    path = str(tmp_path)
    bad = quarantine.bad_lines(spark, path, SCHEMA, ["id"], split).collect()
    assert Counter((r["file"].rsplit("/", 1)[1], r["line"], r["reason"]) for r in bad) == Counter(w for w in want if w[2])
    for r in bad:  # each stands where it says
        raw = (tmp_path / r["file"].rsplit("/", 1)[1]).read_bytes()
        assert raw[r["offset"] :].split(b"\n", 1)[0].decode() == r["line"]
    good = Counter(r["id"] for r in quarantine.good_rows(spark, path, SCHEMA, ["id"], split).collect())
    assert good == Counter(json.loads(text)["id"] for _, text, reason in want if reason is None)
    counts = quarantine.reconciled(spark, path, SCHEMA, ["id"], split).collect()
    assert len(counts) == 2 and all(r["lines"] == 150 and r["reconciles"] for r in counts)


def test_values_of_good_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text(LINES[0][0])
    assert [tuple(r) for r in quarantine.good_rows(spark, str(tmp_path), SCHEMA).collect()] == [(1, "é🙂", 1.5, [1, 2])]


def test_weighted_sample_is_the_first_of_the_race(spark):
    rows = [(i, (i % 7) * 1.5 if i % 11 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, w double")
    timed = df.withColumn("t", sampling.race_time(F.col("id"), F.col("w"), "s")).where("t IS NOT NULL").collect()
    for size in (0, 1, 50, 5000):
        want = sorted(r["id"] for r in sorted(timed, key=lambda r: r["t"])[:size])
        assert sorted(r["id"] for r in sampling.weighted_sample(df, "id", "w", "s", size).collect()) == want


def test_weights_are_followed(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("w"))
    heavy = sampling.weighted_sample(df, "id", "w", "s", 1000).where("id % 2 = 0").count()
    assert abs(heavy - 750) < 4 * math.sqrt(1000 * 0.75 * 0.25)
