"""Command line: build the layouts, verify a build, check a session, read event logs.

python -m faregate build --seed-file trips.parquet --zones-file zones.csv --out /data
python -m faregate verify --out /data
python -m faregate diagnose --out /data
python -m faregate stages --event-dir /logs
python -m faregate tasks --event-dir /logs --stage 3
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from faregate.operators import layout, shares
from faregate.plans import build
from faregate.session import build_session, size_shuffles
from faregate.sources import eventlog


def _build(spark: SparkSession, args: argparse.Namespace) -> int:
    seed_bytes = layout.listing(spark, args.seed_file).agg(F.sum("length")).first()[0]
    size_shuffles(spark, seed_bytes or 0)
    zones = build.load_zones(spark, args.zones_file)
    trips = build.load_trips(spark, args.seed_file)
    manifest = build.build(spark, args.out, trips, zones, args.profile, args.force)
    manifest.orderBy("metric").show(manifest.count(), truncate=False)
    return 0


def _verify(spark: SparkSession, args: argparse.Namespace) -> int:
    if not build.is_built(spark, args.out):
        print(f"FAIL: there is no finished build below {args.out}")
        return 1
    missing = build.missing_paths(spark, args.out)
    absent = missing.count()
    if absent:
        missing.orderBy("path").show(truncate=False)
    print(f"FAIL: {absent} expected tables are not there" if absent else "OK: every expected table is there")
    return 1 if absent else 0


def _diagnose(spark: SparkSession, args: argparse.Namespace) -> int:
    """A shuffle with a known answer, then the build's completeness and skew."""
    groups = shares.group_total(spark.range(200_000).select((F.col("id") % 97).alias("k")), "k")
    shuffle_ok = groups.first()["groups"] == 97
    print(f"session and shuffle: {'ok' if shuffle_ok else 'FAILED'} (Spark {spark.version})")
    code = _verify(spark, args)
    if code:
        return code
    skew = spark.read.json(f"{args.out}/manifest").where("metric = 'dominant_key_share'").first()
    skew_ok = skew["value"] >= build.DOMINANCE_FLOOR
    print(f"dominant key: {skew['detail']} = {skew['value']:.1%}{'' if skew_ok else '  TOO LOW'}")
    return 0 if shuffle_ok and skew_ok else 1


def _stages(spark: SparkSession, args: argparse.Namespace) -> int:
    report = eventlog.latest_stage_report(spark, args.event_dir).orderBy("stage")
    report.show(report.count(), truncate=False)
    return 0


def _tasks(spark: SparkSession, args: argparse.Namespace) -> int:
    events = eventlog.read_events(spark, eventlog.latest_log(spark, args.event_dir))
    bins = eventlog.task_histogram(events, args.stage, args.buckets)
    bins.orderBy("bin").show(args.buckets, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="faregate")
    commands = parser.add_subparsers(required=True)

    make = commands.add_parser("build")
    make.add_argument("--seed-file", required=True)
    make.add_argument("--zones-file")
    make.add_argument("--out", required=True)
    make.add_argument("--profile", choices=list(build.PROFILES), default="whole")
    make.add_argument("--force", action="store_true")
    make.set_defaults(run=_build)

    for name, run in (("verify", _verify), ("diagnose", _diagnose)):
        command = commands.add_parser(name)
        command.add_argument("--out", required=True)
        command.set_defaults(run=run)

    report = commands.add_parser("stages")
    report.add_argument("--event-dir", required=True)
    report.set_defaults(run=_stages)

    tasks = commands.add_parser("tasks")
    tasks.add_argument("--event-dir", required=True)
    tasks.add_argument("--stage", type=int, required=True)
    tasks.add_argument("--buckets", type=int, default=10)
    tasks.set_defaults(run=_tasks)

    args = parser.parse_args(argv)
    return args.run(build_session(), args)


if __name__ == "__main__":
    sys.exit(main())
