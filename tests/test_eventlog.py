from __future__ import annotations

import json
import statistics

import pytest
from pyspark.sql import functions as F

from faregate.session import flush_events
from faregate.sources import eventlog


def task(stage, launch, finish, write=0, **metrics):
    return {
        "Event": "SparkListenerTaskEnd",
        "Stage ID": stage,
        "Task Info": {"Launch Time": launch, "Finish Time": finish, "Failed": False},
        "Task Metrics": {"Shuffle Write Metrics": {"Shuffle Bytes Written": write}, **metrics},
    }


def done(stage, name, details, attempt=0):
    info = {"Stage ID": stage, "Stage Attempt ID": attempt, "Stage Name": name, "Details": details}
    return {"Event": "SparkListenerStageCompleted", "Stage Info": info}


@pytest.fixture
def log(tmp_path):
    events = [
        {"Event": "SparkListenerLogStart", "Spark Version": "4"},
        task(0, 1_000, 2_000, write=1024**2),
        task(0, 1_000, 2_000, write=1024**2),
        task(0, 1_000, 21_400),
        task(0, 0, 5_000, write=7),  # never launched: no time, bytes count
        task(0, 9_000, 8_000),  # finish before launch
        task(1, 5, 5),
        task(2, 0, 0),
        {"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Task Info": {"Launch Time": 1, "Finish Time": 1}},
        done(0, "collect at A.scala:1", "A.main(A.scala)\nB.run", attempt=1),
        done(0, "old at A.scala:1", "old", attempt=0),
        done(1, "count", ""),
    ]
    path = tmp_path / "app-1"
    path.write_text("\n".join(json.dumps(e) for e in events) + "\n\n" + json.dumps(task(0, 1, 2))[:40])
    (tmp_path / ".app-1.crc").write_text("x")
    return path


def test_stage_report_of_a_written_log(spark, log):
    found = eventlog.latest_log(spark, str(log.parent))
    assert found.endswith("/app-1")
    rows = {r["stage"]: r for r in eventlog.stage_report(eventlog.read_events(spark, found)).collect()}
    assert set(rows) == {0, 1}  # stage 2 has no timed task
    r = rows[0]
    assert (r["tasks"], r["median_s"], r["max_s"], r["total_s"]) == (3, 1.0, 20.4, 22.4)
    assert (r["skew_ratio"], r["straggler"], r["name"], r["details"]) == (20.4, True, "collect", "A.main(A.scala)")
    assert r["shuffle_write"] == 2 * 1024**2 + 7
    assert (rows[1]["skew_ratio"], rows[1]["straggler"], rows[1]["details"]) == (None, False, "")


def test_histogram_and_run_table(spark, log, out):
    events = eventlog.read_events(spark, str(log))
    bins = eventlog.task_histogram(events, 0, 4).orderBy("bin").collect()
    assert [b["n"] for b in bins] == [2, 0, 0, 1]
    assert eventlog.task_histogram(events, 77).count() == 0
    report = eventlog.stage_report(events)
    eventlog.record_run(report, "baseline", 4.005, out)
    runs = eventlog.record_run(report.limit(0), "empty", 1.0, out).orderBy("variant").collect()
    assert [(r["variant"], r["stages"], r["max_skew"], r["shuffle_write_mb"]) for r in runs] == [
        ("baseline", 2, 20.4, 2.0),
        ("empty", 0, 0.0, 0.0),
    ]


def test_no_log_is_an_error_that_says_how(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception, match="spark.eventLog|PATH_NOT_FOUND|Unable to infer"):
        eventlog.latest_log(spark, str(tmp_path / "empty"))


def test_the_running_sessions_own_log(spark, event_dir):
    """Against plain Python over the same lines."""
    spark.range(0, 50_000, 1, 7).groupBy((F.col("id") % 11).alias("k")).count().collect()
    flush_events(spark)
    path = eventlog.latest_log(spark, event_dir)
    assert "/eventlog_v2_" in path
    frozen = spark.read.option("pathGlobFilter", "events_*").text(path).collect()
    times: dict[int, list[float]] = {}
    for (line,) in frozen:
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            info = event["Task Info"]
            times.setdefault(event["Stage ID"], []).append((info["Finish Time"] - info["Launch Time"]) / 1000)
    report = {r["stage"]: r for r in eventlog.stage_report(eventlog.read_events(spark, path)).collect()}
    for stage, seconds in list(times.items())[:-1]:  # the log grows while it is read
        assert report[stage]["tasks"] == len(seconds)
        assert report[stage]["median_s"] == pytest.approx(statistics.median(seconds), abs=0.011)
        assert report[stage]["max_s"] == pytest.approx(max(seconds), abs=0.011)
