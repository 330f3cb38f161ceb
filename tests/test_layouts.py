from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faregate.functions.calendar import iso_date
from faregate.operators import fingerprint, layout
from faregate.schemas import ZONE_SCHEMA
from faregate.sources import tables
from tests.conftest import SF


@pytest.fixture
def daily(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    return events.withColumn("pickup_date", iso_date(F.col("ts")))


def same_rows(a, b):
    return fingerprint.fingerprint(a).first() == fingerprint.fingerprint(b).first()


def test_text_formats_keep_microseconds_quotes_and_nulls(spark, out):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 0, 0, 0, 7), '{"k": "a, b"}', True, 0.1), (2, None, None, False, None)],
        "k int, t timestamp_ntz, s string, b boolean, x double",
    )
    layout.write_csv(df, f"{out}/csv")
    layout.write_ndjson(df, f"{out}/json")
    assert same_rows(tables.read_csv(spark, f"{out}/csv", df.schema), df)
    assert same_rows(tables.read_ndjson(spark, f"{out}/json", df.schema), df)
    assert '"t":null' in "".join(r[0] for r in spark.read.text(f"{out}/json").collect())


def test_csv_null_tokens_and_pandas_booleans(spark, tmp_path):
    path = tmp_path / "z.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n264,N/A,NV,nan\n265,,Outside,NA\n')
    rows = tables.read_foreign_csv(spark, str(path), ZONE_SCHEMA).orderBy("LocationID").collect()
    assert [tuple(r) for r in rows] == [
        (1, "EWR", "Newark, Airport", "EWR"),
        (264, None, "NV", None),
        (265, None, "Outside", None),
    ]
    flags = tmp_path / "b.csv"
    flags.write_text("b\nTrue\nFalse\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("b", T.BooleanType())])
    assert [r[0] for r in tables.read_foreign_csv(spark, str(flags), schema).collect()] == [True, False]


def test_partition_column_stays_text_and_prunes(spark, daily, out):
    layout.write_partitioned(daily, out, "pickup_date")
    df = tables.read_partitioned(spark, out, daily.schema)
    assert dict(df.dtypes)["pickup_date"] == "string"
    one = df.where(F.col("pickup_date") == "2024-01-10").select("value")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
    assert "ReadSchema: struct<value:double>" in plan
    assert same_rows(df, daily)


def test_partitioned_write_makes_few_files_per_day(spark, daily, out):
    layout.write_partitioned(daily.repartition(16), out, "pickup_date")
    files = layout.partition_files(spark, out, "pickup_date")
    assert files.agg(F.max("files")).first()[0] <= 2
    assert files.count() == daily.select("pickup_date").distinct().count()


def test_small_files_lose_no_row_and_compact_without_a_shuffle(spark, daily, out):
    layout.write_small_files(daily, f"{out}/small", 30)
    layout.compact(spark, f"{out}/small", f"{out}/compact")
    sizes = {r["layout"]: r["files"] for r in layout.layout_sizes(spark, out).collect()}
    assert sizes == {"small": 30, "compact": 1}
    assert same_rows(spark.read.parquet(f"{out}/small"), daily)
    assert same_rows(spark.read.parquet(f"{out}/compact"), daily)


def test_replaying_a_day_changes_nothing_else(spark, daily, out):
    layout.write_partitioned(daily, out, "pickup_date")
    day = daily.where(F.col("pickup_date") == "2024-01-03")
    for _ in range(2):
        layout.replace_days(day, out, "pickup_date")
    assert same_rows(tables.read_partitioned(spark, out, daily.schema), daily)


def test_appending_a_day_twice_is_the_trap(spark, daily, out):
    day = daily.where(F.col("pickup_date") == "2024-01-03")
    for _ in range(2):
        layout.write_partitioned(day, out, "pickup_date", mode="append")
    assert tables.read_partitioned(spark, out, daily.schema).count() == 2 * day.count() > 0


def test_ignore_mode_leaves_a_built_table_alone(spark, out):
    layout.write_parquet(spark.range(5), out, mode="ignore")
    layout.write_parquet(spark.range(9), out, mode="ignore")
    assert spark.read.parquet(out).count() == 5
    layout.write_parquet(spark.range(9), out)
    assert spark.read.parquet(out).count() == 9


def test_dataset_floor_with_bytes(spark, daily, out):
    layout.write_parquet(daily, out)
    row = layout.dataset_floor(
        daily, "ts", layout.bytes_below(spark, [out]), rows=100, months=2, size=1_000
    ).first()
    assert row["rows_ok"] and not row["months_ok"] and row["bytes_ok"]
    assert row["raw_bytes"] == layout.listing(spark, out).agg(F.sum("length")).first()[0]


def test_nanosecond_timestamps_are_named(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = str(tmp_path / "ns.parquet")
    pq.write_table(pa.table({"t": pa.array([1], pa.timestamp("ns"))}), path, version="2.6")
    with pytest.raises(tables.UnreadableTimestamps):
        tables.read_parquet(spark, path)


def test_awkward_texts_survive_text_formats(spark, out):
    texts = ["a\nb", "a\r\nb", "\\n", "\\\\s\\", "NA", "None", "", " lead", "trail ", '"q", \'', "\n", None, "x,y", "\u2028é"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, s string")
    layout.write_csv(df, f"{out}/csv")
    layout.write_ndjson(df, f"{out}/json")
    for back in (tables.read_csv(spark, f"{out}/csv", df.schema), tables.read_ndjson(spark, f"{out}/json", df.schema)):
        assert [r["s"] for r in back.orderBy("k").collect()] == texts


def test_a_broken_json_line_is_an_error(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    from pyspark.sql import types as T

    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_ndjson(spark, str(path), T.StructType([T.StructField("a", T.LongType())])).collect()


def test_sizes_below_a_root_whose_name_recurs(spark, out):
    root = f"{out}/data/x/data"
    layout.write_parquet(spark.range(5), f"{root}/one")
    layout.write_parquet(spark.range(5), f"{root}/two")
    assert {r["layout"] for r in layout.layout_sizes(spark, root).collect()} == {"one", "two"}


def test_partition_values_are_read_as_they_were(spark, out):
    days = ["31/02/2024", "a b", "a+b", "100%", "2024-01-01", None]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "day string, v int")
    layout.write_partitioned(df, out, "day")
    files = layout.partition_files(spark, out, "day")
    assert {r["day"] for r in files.collect()} == set(days)
    assert layout.missing_artifacts(df, files, "day").count() == 0


def test_quoted_line_breaks_of_other_tools(spark, tmp_path):
    from pyspark.sql import types as T

    path = tmp_path / "p.csv"
    path.write_text('a,b\n1,"x\ny"\n2,NA\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    rows = tables.read_foreign_csv(spark, str(path), schema, multi_line=True).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "x\ny"), (2, None)]
