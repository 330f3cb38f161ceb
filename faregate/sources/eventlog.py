"""Spark event logs as DataFrames, and the stage evidence read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregate import schemas
from faregate.functions import text
from faregate.operators import histogram as bins
from faregate.operators import stages
from faregate.operators.layout import listing, write_parquet, written


def latest_log(spark: SparkSession, event_dir: str) -> str:
    """The newest log below a folder: a single file, or the folder of a rolled log.

    Checksum and status files do not count. Only the newest name comes back.
    """
    files = listing(spark, event_dir).where(
        ~F.col("path").endswith(".crc") & ~F.col("path").contains("/appstatus_")
    )
    rolled = F.regexp_extract("path", "^(.*/eventlog_v2_[^/]+)/", 1)
    name = F.when(rolled != "", rolled).otherwise(F.col("path"))
    newest = files.agg(F.max_by(name, F.struct("modificationTime", "path")).alias("log")).first()
    if newest is None or newest["log"] is None:
        raise FileNotFoundError(
            f"no event log in {event_dir}; start Spark with spark.eventLog.enabled=true "
            f"and spark.eventLog.dir={event_dir}"
        )
    return newest["log"]


def read_events(spark: SparkSession, log: str) -> DataFrame:
    """The events of one log. A line cut off while the log grows is skipped."""
    reader = spark.read.schema(schemas.EVENT_LOG_DDL).option("mode", "DROPMALFORMED")
    if "/eventlog_v2_" in log:
        reader = reader.option("pathGlobFilter", "events_*")
    return reader.json(log)


def evidence(events: DataFrame) -> DataFrame:
    """Only the two kinds of event the tables below need, parsed once and written.

    Most of a log is other events; the report passes over its input several
    times and should not parse JSON each time.
    """
    kinds = ("SparkListenerTaskEnd", "SparkListenerStageCompleted")
    return written(events.where(F.col("Event").isin(*kinds)))


def task_table(events: DataFrame) -> DataFrame:
    """One row per finished task attempt: time, shuffle, spill, records.

    Failed and speculative attempts are kept, with the flag beside them. A
    task without a sane launch and finish has no time.
    """
    ended = events.where(F.col("Event") == "SparkListenerTaskEnd")
    launch, finish = F.col("`Task Info`.`Launch Time`"), F.col("`Task Info`.`Finish Time`")
    sane = (launch != 0) & (finish != 0) & (finish >= launch)

    def metric(path: str):
        return F.coalesce(F.col(f"`Task Metrics`.{path}"), F.lit(0))

    return ended.select(
        F.col("`Stage ID`").alias("stage"),
        F.when(sane, (finish - launch) / 1000).alias("seconds"),
        F.coalesce(F.col("`Task Info`.`Failed`"), F.lit(False)).alias("failed"),
        (
            metric("`Shuffle Read Metrics`.`Remote Bytes Read`")
            + metric("`Shuffle Read Metrics`.`Local Bytes Read`")
        ).alias("shuffle_read"),
        metric("`Shuffle Write Metrics`.`Shuffle Bytes Written`").alias("shuffle_write"),
        metric("`Disk Bytes Spilled`").alias("spill_disk"),
        metric("`Input Metrics`.`Records Read`").alias("records_read"),
    ).where(F.col("stage").isNotNull())


def stage_names(events: DataFrame) -> DataFrame:
    """``stage, name, details`` of the last completed attempt of each stage."""
    info = F.col("`Stage Info`")
    done = events.where(F.col("Event") == "SparkListenerStageCompleted").select(
        info["Stage ID"].alias("stage"),
        F.coalesce(info["Stage Attempt ID"], F.lit(0)).alias("attempt"),
        text.before(F.coalesce(info["Stage Name"], F.lit("")), " at ").alias("name"),
        text.first_line_head(info["Details"]).alias("details"),
    )
    return done.groupBy("stage").agg(
        F.max_by("name", "attempt").alias("name"), F.max_by("details", "attempt").alias("details")
    )


SUMS = ("shuffle_read", "shuffle_write", "spill_disk", "records_read")


def stage_report(events: DataFrame) -> DataFrame:
    """Per stage: tasks, median, maximum, skew ratio, straggler flag, bytes, name."""
    events = evidence(events)
    stats = stages.stage_stats(task_table(events), "stage", "seconds", SUMS)
    named = stats.join(stage_names(events), "stage", "left")
    return named.withColumn("name", F.coalesce("name", F.lit("?")))


def latest_stage_report(spark: SparkSession, event_dir: str) -> DataFrame:
    return stage_report(read_events(spark, latest_log(spark, event_dir)))


def task_histogram(events: DataFrame, stage_id: int, buckets: int = 10) -> DataFrame:
    """Histogram of the task times of one stage."""
    tasks = task_table(events).where(F.col("stage") == F.lit(stage_id))
    return bins.histogram(tasks, "seconds", buckets)


def record_run(report: DataFrame, variant: str, wall_seconds: float, runs_path: str) -> DataFrame:
    """Add one run to the table of runs at ``runs_path`` and return the table."""
    write_parquet(stages.run_summary(report, variant, wall_seconds), runs_path, mode="append")
    return report.sparkSession.read.parquet(runs_path)
