"""The whole build on trips made of the driver tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faregate import __main__ as cli
from faregate.operators import layout, sampling
from faregate.plans import build, trips
from tests.conftest import SF

SMALL = build.Profile(
    csv_bytes=3_000_000, slice_rows=4_000, format_rows=2_000, small_files=20, skewed_rows=15_000, dirty_rows=2_500
)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("build"))
    seed = f"{out}-seed"
    layout.write_parquet(trips.trips(spark, SF).withColumnRenamed("airport_fee", "Airport_fee"), seed)
    with pytest.MonkeyPatch.context() as patch:
        patch.setitem(build.PROFILES, "tiny", SMALL)
        width = spark.conf.get("spark.sql.shuffle.partitions")
        assert cli.main(["build", "--seed-file", seed, "--out", out, "--profile", "tiny"]) == 0
        spark.conf.set("spark.sql.shuffle.partitions", width)
    manifest = {r["metric"]: r for r in spark.read.json(f"{out}/manifest").collect()}
    return out, manifest, build.load_trips(spark, seed), build.load_zones(spark, None)


def test_every_layout_has_its_rows(spark, built):
    out, manifest, raw, _ = built
    n = raw.count()

    def rows(path):
        return spark.read.parquet(f"{out}/{path}").count()

    assert manifest["curated_columns"]["value"] == 38
    assert manifest["curated_rows"]["value"] == n
    assert rows("shared/trips_slice.parquet") == SMALL.slice_rows
    assert rows("s6/trips_flat.parquet") == rows("s6/trips_partitioned") == rows("s6/trips_smallfiles") == 2_000
    assert rows("s7/trips_skewed") == SMALL.skewed_rows
    assert rows("s8/trips_dirty.parquet") == 2_500 + int(2_500 * 0.02)
    assert rows("s8/trips_day2.parquet") == 2_500
    assert len(spark.read.parquet(f"{out}/s8/trips_dirty.parquet").columns) == 39
    size = layout.listing(spark, f"{out}/s1/trips_big.csv").agg(F.sum("length")).first()[0]
    assert size >= 0.95 * SMALL.csv_bytes


def test_nothing_is_missing_until_something_is(spark, built):
    out = built[0]
    assert build.missing_paths(spark, out).count() == 0
    assert build.is_built(spark, out) and not build.is_built(spark, f"{out}-nowhere")


def test_a_finished_build_is_left_alone(spark, built):
    out, manifest, raw, zones = built
    again = {r["metric"]: r for r in build.build(spark, out, raw, zones, SMALL).collect()}
    assert again["build_seconds"] == manifest["build_seconds"]


def test_a_broken_lookup_gives_the_fallback(spark, tmp_path):
    page = tmp_path / "zones.csv"
    page.write_text("<html><body>not found</body></html>\n")
    assert build.load_zones(spark, str(page)).count() == sum(sampling.FALLBACK_BOROUGHS.values())


def test_command_line(spark, built, event_dir, capsys):
    out = built[0]
    assert cli.main(["verify", "--out", out]) == 0
    assert "every expected table is there" in capsys.readouterr().out
    assert cli.main(["verify", "--out", f"{out}-nowhere"]) == 1
    assert cli.main(["stages", "--event-dir", event_dir]) == 0
    assert "skew_ratio" in capsys.readouterr().out
    assert cli.main(["tasks", "--event-dir", event_dir, "--stage", "0", "--buckets", "4"]) == 0
    assert cli.main(["diagnose", "--out", out]) in (0, 1)
    assert "session and shuffle: ok" in capsys.readouterr().out
