"""The registered queries: each reads whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregate.functions import calendar, rounding, text
from faregate.operators import (
    cluster,
    curate,
    defects,
    difference,
    drift,
    duplicates,
    fingerprint,
    gates,
    histogram,
    joins,
    layout,
    normalise,
    ranks,
    replicate,
    sampling,
    shares,
    snapshots,
    stages,
)
from faregate.plans import trips
from faregate.plans.trips import TRIP_EVENTS, table
from faregate.schemas import CHARGE_COLUMNS, PAYMENT_LABELS
from faregate.session import SQL_PROFILES, shared_folder, variant_session
from faregate.sources import footers, quarantine, tables

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# ---------------------------------------------------------------- curate, shares


def key_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips, share and average fare by pick-up borough."""
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    zones = curate.pickup_zones(trips.zones(spark, sf_dir))
    measures = {
        "trips": F.count(F.lit(1)),
        "fare_cents": F.sum(rounding.cents(F.col("l_extendedprice"))),
        "distance": F.sum(F.col("l_quantity").cast("bigint")),
    }

    def to_nation(sums: DataFrame) -> tuple[DataFrame, list[str]]:
        return sums.join(supplier, "l_suppkey", "left"), ["s_nationkey"]

    def to_borough(sums: DataFrame) -> tuple[DataFrame, list[str]]:
        named = sums.join(
            joins.broadcast_if_small(zones), sums.s_nationkey == zones.PULocationID, "left"
        ).withColumn("pickup_borough", F.coalesce("pickup_borough", F.lit(curate.UNKNOWN)))
        return named, ["pickup_borough"]

    line = table(spark, sf_dir, "lineitem")
    sums = shares.rolled_up_through(line, "l_suppkey", measures, [to_nation, to_borough])
    shared = shares.with_share(sums, "trips", total=shares.row_total_of(line))
    return shares.by_share(shared, "pickup_borough").select(
        "pickup_borough",
        "trips",
        "share",
        (F.col("share") >= 0.5).alias("dominates"),
        (F.col("fare_cents") / 100.0 / F.col("trips")).alias("avg_fare"),
        (F.col("distance") / F.col("trips")).alias("avg_distance"),
    )


def curate_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.curate(trips.trips(spark, sf_dir), trips.zones(spark, sf_dir))


def dominant_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares.dominant_key(table(spark, sf_dir, "documents"), "lang")


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares.distinct_values(table(spark, sf_dir, "part"), "p_type")


def bucket_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of groups of ``key % 97``: a shuffle with a known answer."""
    keyed = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 97).alias("k"))
    return shares.group_total(keyed, "k")


def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 97).alias("k"))
    return shares.key_counts(keyed, "k")


# ---------------------------------------------------------------- scalars


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    k = F.get_json_object("props", "$.k").cast("int")
    dropoff = calendar.plus_seconds(ts, k)
    return table(spark, sf_dir, "events").select(
        "event_id",
        *[expr.alias(name) for name, expr in curate.calendar_columns(ts).items()],
        dropoff.alias("dropoff"),
        calendar.duration_seconds(ts, dropoff).alias("trip_duration_sec"),
        calendar.duration_seconds(ts, ts.cast("date").cast("timestamp_ntz")).alias(
            "seconds_to_midnight"
        ),
    )


def guarded_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    seconds = calendar.duration_seconds(F.col("o_orderdate"), F.col("l_shipdate"))
    return line.join(order, line.l_orderkey == order.o_orderkey).select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        seconds.alias("duration_sec"),
        rounding.half_even(seconds / 60).alias("duration_min"),
        F.when(seconds > 0, rounding.half_even(F.col("l_quantity") / (seconds / 3600))).alias("speed"),
        rounding.guarded_ratio(F.col("l_tax"), F.col("l_discount"), 100.0).alias("tip_pct"),
        rounding.guarded_ratio(F.col("l_extendedprice"), F.col("l_quantity")).alias("fare_per_unit"),
    )


def charge_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    charges = line.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_quantity").alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("tip_amount"),
        F.lit(6.94).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (F.col("l_tax") + F.lit(0.0)).alias("congestion_surcharge"),
        (F.col("l_discount") + F.lit(0.0)).alias("airport_fee"),
    )
    return charges.select(
        "l_orderkey",
        "l_linenumber",
        "fare_amount",
        rounding.row_total(CHARGE_COLUMNS).alias("total_amount"),
        rounding.half_even(rounding.clamp_at_zero(F.col("fare_amount") - 50_000)).alias("above_50000"),
        (-F.abs(F.col("fare_amount")) + F.lit(0.0)).alias("negated"),
    )


def label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.nullif(F.substring("o_orderpriority", 1, 1).cast("bigint"), F.lit(4))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.label_of(code, PAYMENT_LABELS).alias("payment_label"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit(curate.UNKNOWN)).alias("status"),
    )


def string_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.numbered_label("Zone", F.col("page_id")).alias("zone"),
        text.before(F.col("url"), "?").alias("address"),
        text.first_line_head(F.col("html")).alias("head"),
    )


def nested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with a nested field that may be missing, in other units."""
    props = F.from_json("props", "k bigint, net struct<bytes: bigint>")
    clicks = table(spark, sf_dir, "events").where(F.col("event_type") == "click").withColumn("p", props)
    return clicks.select(
        "event_id",
        F.coalesce("p.k", F.lit(0)).alias("k"),
        F.coalesce("p.net.bytes", F.lit(0)).alias("net_bytes"),
        (F.col("value") / 1000).alias("seconds"),
        (F.coalesce("p.k", F.lit(0)) / (1024.0 * 1024.0)).alias("megabytes"),
    )


def sane_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time from order to shipping where both are set and in order, else none."""
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    start = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))  # not set yet
    end = F.col("l_shipdate")
    sane = start.isNotNull() & end.isNotNull() & (end >= start)
    return line.join(order, line.l_orderkey == order.o_orderkey).select(
        "l_orderkey",
        "l_linenumber",
        sane.alias("sane"),
        F.when(sane, calendar.duration_seconds(start, end)).alias("seconds"),
    )


def dimension_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which tables may serve as a lookup on which key."""
    candidates = (
        ("nation", "n_nationkey"), ("customer", "c_custkey"), ("customer", "c_nationkey"),
        ("part", "p_partkey"), ("pages", "page_id"), ("labels", "doc_id"), ("lineitem", "l_orderkey"),
    )
    reports = [
        normalise.dimension_report(table(spark, sf_dir, name), f"{name}.{key}", key) for name, key in candidates
    ]
    return replicate.union_versions(*reports)


def schema_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer file with other spellings, a missing and an extra column."""
    drifted = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("C_Name"),
        F.col("c_custkey").alias("C_CUSTKEY"),
        F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
        F.lit(0.75).alias("cbd_congestion_fee"),
    )
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    )
    return normalise.normalise(
        drifted, schema, ("c_custkey", "c_name"), {"c_acctbal": 1.5, "c_mktsegment": "N"}
    )


# ---------------------------------------------------------------- joins


def _supplied_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    line = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("suppkey"), "l_orderkey", "l_linenumber", "l_quantity"
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), "s_nationkey"
    )
    return line, supplier


def _by_nation(joined: DataFrame) -> DataFrame:
    return joined.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
    )


def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, supplier = _supplied_lines(spark, sf_dir)
    return _by_nation(joins.join_dimension(line, supplier, "suppkey", "broadcast"))


def join_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, supplier = _supplied_lines(spark, sf_dir)
    spread = ["l_orderkey", "l_linenumber"]
    return _by_nation(joins.salted_join(line, supplier, "suppkey", spread, "hash", "inner"))


def join_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, supplier = _supplied_lines(spark, sf_dir)
    spread = ["l_orderkey", "l_linenumber"]
    return _by_nation(joins.salted_join(line, supplier, "suppkey", spread, "merge"))


def _languages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents and their languages as a lookup; one language holds most documents."""
    fact = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    # as a table of its own: a join side that still has to be summed can't be read in pieces
    return fact, layout.written(fact.groupBy("lang").agg(F.min("source").alias("first_source")))


def _by_source(joined: DataFrame) -> DataFrame:
    return joined.groupBy("source", "first_source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars")
    )


def join_skew_aqe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge join on a key that holds most rows; adaptive execution splits its partition.

    Thresholds follow the input: a partition counts as skewed from twice an
    even share on, and is cut into pieces of a quarter of one. A split needs
    several map tasks, so a table that one task would scan is dealt out first.
    """
    fact = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = fact.agg(F.sum(joins.held_bytes(fact))).first()[0] or 0
    even = max(size // parts // 4, 1)  # what is shuffled is packed
    adaptive = variant_session(
        spark,
        {
            **SQL_PROFILES["production"],
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(even),
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(max(even // 4, 1)),
        },
    )
    fact, languages = _languages(adaptive, sf_dir)
    if fact.rdd.getNumPartitions() < parts:
        fact = fact.repartition(parts)
    return _by_source(joins.join_dimension(fact, languages, "lang", "merge"))


def join_skew_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join with adaptive execution off; the hot key is salted instead."""
    width = spark.conf.get("spark.sql.shuffle.partitions")
    fixed = variant_session(
        spark, {**SQL_PROFILES["teaching"], "spark.sql.shuffle.partitions": width}
    )
    fact, languages = _languages(fixed, sf_dir)
    return _by_source(joins.salted_join(fact, languages, "lang", ["doc_id"], "merge"))


# ---------------------------------------------------------------- samples, slices, unions


def key_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return sampling.sample_exact(events, "event_id", "sample", sampling.share_of_rows(0.02))


def weighted_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    skewed = trips.skewed_trips(spark, sf_dir)
    return shares.key_shares(skewed, "pickup_borough")


def slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return ranks.slice_rows(events, "event_id", lambda n: n / 4, lambda n: n / 2)


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.first_rows(table(spark, sf_dir, "orders"), "o_orderkey", lambda n: n * 0.3)


def replicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return replicate.replicate_rows(events, "event_id", lambda n: n * 5 // 2)


def union_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days before and after a column appeared, in one table."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    change = F.lit("2024-01-16").cast("date")
    day = F.col("ts").cast("date")
    later = defects.second_day(events.where(day >= change))
    return replicate.union_versions(events.where(day < change), later)


# ---------------------------------------------------------------- duplicates, defects, gates


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    dirty = _dirty(spark, sf_dir)
    return (
        duplicates.duplicate_count(documents, ["text", "lang", "source"])
        .withColumn("source", F.lit("documents"))
        .unionByName(
            duplicates.duplicate_count(documents, ["text"]).withColumn("source", F.lit("texts"))
        )
        .unionByName(duplicates.duplicate_count(dirty).withColumn("source", F.lit("dirty_events")))
    )


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.inject_defects(trips.trip_events(spark, sf_dir), TRIP_EVENTS)


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.drop_duplicates(_dirty(spark, sf_dir))


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty(spark, sf_dir)


def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gate_counts(_dirty(spark, sf_dir), TRIP_EVENTS)


def gate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = gates.split_by_gates(_dirty(spark, sf_dir), TRIP_EVENTS)
    return split.select(
        "trip_id", "pickup_date", F.concat_ws(",", "reasons").alias("reasons"), "is_clean"
    )


def defect_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.reconcile(
        trips.trip_events(spark, sf_dir), _dirty(spark, sf_dir), TRIP_EVENTS
    )


def defect_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest as written and read back."""
    path = f"{shared_folder(spark)}/manifest"
    dirty = layout.written(_dirty(spark, sf_dir))
    layout.write_manifest(
        gates.manifest(trips.trip_events(spark, sf_dir), dirty, TRIP_EVENTS), path
    )
    return spark.read.schema("metric string, value bigint, detail string").json(path)


def drift_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = _dirty(spark, sf_dir).withColumn(
        "day", calendar.iso_date(F.col("tpep_pickup_datetime"))
    )
    return gates.drift_profile(dirty, defects.DRIFT_COLUMN, "day")


# ---------------------------------------------------------------- evidence


def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram.histogram(table(spark, sf_dir, "events"), "value", 10)


def stage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.stage_stats(table(spark, sf_dir, "events"), "event_type", "value")


def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and maxima over the table of event types."""
    report = stages.stage_stats(table(spark, sf_dir, "events"), "event_type", "value")
    return stages.report_totals(report)


def table_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = None
    for name in TABLES:
        one = fingerprint.fingerprint(table(spark, sf_dir, name)).withColumn("source", F.lit(name))
        prints = one if prints is None else prints.unionByName(one)
    return prints


# ---------------------------------------------------------------- layouts


def _daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("pickup_date", calendar.iso_date(F.col("ts")))


def _written_layouts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    root = shared_folder(spark)
    events = _daily_events(spark, sf_dir)
    layout.write_csv(events, f"{root}/csv")
    layout.write_ndjson(events, f"{root}/json")
    layout.write_parquet(events, f"{root}/flat")
    layout.write_partitioned(events, f"{root}/partitioned", "pickup_date")
    layout.write_small_files(events, f"{root}/small", 50)
    return {
        "csv": tables.read_csv(spark, f"{root}/csv", events.schema),
        "json": tables.read_ndjson(spark, f"{root}/json", events.schema),
        "flat": tables.read_parquet(spark, f"{root}/flat"),
        "partitioned": tables.read_partitioned(spark, f"{root}/partitioned", events.schema),
        "small": tables.read_parquet(spark, f"{root}/small"),
    }


def layout_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of every layout, read back."""
    tagged = [
        df.withColumn("layout", F.lit(name))
        for name, df in _written_layouts(spark, sf_dir).items()
    ]
    return replicate.union_versions(*tagged)


def layout_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each layout still holds the source's rows, by fingerprint."""
    source = fingerprint.fingerprint(_daily_events(spark, sf_dir))
    wanted = source.select(F.struct("rows", "content")).scalar()
    prints = [
        fingerprint.fingerprint(df).withColumn("layout", F.lit(name))
        for name, df in _written_layouts(spark, sf_dir).items()
    ]
    same = F.struct("rows", "content") == F.col("wanted")
    return (
        replicate.union_versions(*prints)
        .withColumn("wanted", wanted)
        .select("layout", "rows", same.alias("same_content"))
    )


def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents and pages, line breaks, quotes, nulls and the text ``NA`` included, out and back."""
    root = shared_folder(spark)
    lang = F.when(F.col("lang") != "de", F.col("lang"))
    source = F.when(F.col("source") == "src1", "NA").otherwise(F.col("source"))
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.concat(F.lit(" "), "text").alias("body"), lang.alias("lang"), source.alias("place")
    )
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.col("html").alias("body"), F.lit("").alias("lang"), F.col("url").alias("place")
    )
    parts = []
    for name, df in (("documents", documents), ("pages", pages)):
        layout.write_csv(df, f"{root}/{name}-csv")
        layout.write_ndjson(df, f"{root}/{name}-json")
        parts.append(tables.read_csv(spark, f"{root}/{name}-csv", df.schema).withColumn("layout", F.lit(f"{name} csv")))
        parts.append(tables.read_ndjson(spark, f"{root}/{name}-json", df.schema).withColumn("layout", F.lit(f"{name} json")))
    return replicate.union_versions(*parts)


def layout_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each layout, each written in a given number of them."""
    root = shared_folder(spark)
    events = _daily_events(spark, sf_dir)
    layout.write_csv(events.repartition(3), f"{root}/csv")
    layout.write_ndjson(events.repartition(4), f"{root}/json")
    layout.write_parquet(events.repartition(5), f"{root}/flat")
    layout.write_small_files(events, f"{root}/small", 50)
    sizes = layout.layout_sizes(spark, root)
    return sizes.select("layout", "files", (F.col("bytes") > 0).alias("has_bytes"))


def append_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries appended day by day to one partitioned table."""
    path = f"{shared_folder(spark)}/deliveries"
    events = _daily_events(spark, sf_dir).select("event_id", "value", "pickup_date")
    for delivery in (1, 2):
        rows = events.withColumn("delivery", F.lit(delivery))
        layout.write_partitioned(rows, path, "pickup_date", mode="append")
    return tables.read_partitioned(spark, path, rows.schema)


def skip_if_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second build is skipped where the table is there, a forced one replaces it."""
    root = shared_folder(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for name, mode in (("skipped", "ignore"), ("forced", "overwrite")):
        layout.write_parquet(orders, f"{root}/{name}", mode="ignore")
        layout.write_parquet(changed, f"{root}/{name}", mode=mode)
    return replicate.union_versions(
        *[tables.read_parquet(spark, f"{root}/{n}").withColumn("build", F.lit(n)) for n in ("skipped", "forced")]
    )


def replicate_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows repeated until their CSV is two and a half times the table's, written and read back."""
    path = f"{shared_folder(spark)}/replicated"
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    size = replicate.csv_row_bytes(events) * events.count()
    big = replicate.replicate_to_csv_bytes(events, "event_id", int(size * 2.5))
    layout.write_csv(big, path)
    return tables.read_csv(spark, path, big.schema)


def partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day read from the partitioned table and from its flat twin."""
    root = shared_folder(spark)
    events = _daily_events(spark, sf_dir)
    layout.write_partitioned(events, f"{root}/partitioned", "pickup_date")
    layout.write_parquet(events, f"{root}/flat")
    both = {
        "partitioned": tables.read_partitioned(spark, f"{root}/partitioned", events.schema),
        "flat": tables.read_parquet(spark, f"{root}/flat"),
    }
    results = [
        df.where(F.col("pickup_date") == "2024-01-10")
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(rounding.cents(F.col("value"))).alias("value_cents"),
        )
        .withColumn("layout", F.lit(name))
        for name, df in both.items()
    ]
    return replicate.union_versions(*results)


def column_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column read out of the 38 of the curated table."""
    path = f"{shared_folder(spark)}/curated"
    layout.write_parquet(curate_wide(spark, sf_dir), path)
    one = tables.read_parquet(spark, path).select("pickup_borough")
    return shares.key_shares(one, "pickup_borough")


def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark)
    layout.write_small_files(table(spark, sf_dir, "events"), f"{root}/small", 100)
    layout.compact(spark, f"{root}/small", f"{root}/compacted")
    return tables.read_parquet(spark, f"{root}/compacted")


def idempotent_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day delivered again with corrected values, twice; other days stay."""
    path = f"{shared_folder(spark)}/days"
    events = _daily_events(spark, sf_dir).select("event_id", "value", "pickup_date")
    layout.write_partitioned(events, path, "pickup_date")
    again = events.where(F.col("pickup_date") == "2024-01-02").withColumn(
        "value", F.col("value") + 1
    )
    layout.replace_days(again, path, "pickup_date")
    layout.replace_days(again, path, "pickup_date")
    return tables.read_partitioned(spark, path, events.schema)


def artifact_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that should have a partition of high values but have none; some days are malformed."""
    path = f"{shared_folder(spark)}/high"
    day = F.when(F.col("event_id") % 10 == 3, "31/02/2024").otherwise(F.col("pickup_date"))
    events = _daily_events(spark, sf_dir).withColumn("pickup_date", day)
    layout.write_partitioned(events.where(F.col("value") > 300), path, "pickup_date")
    present = layout.partition_files(spark, path, "pickup_date")
    return layout.missing_artifacts(events, present, "pickup_date")


def dataset_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return layout.dataset_floor(line, "l_shipdate", layout.text_bytes(line))


def csv_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV whose missing values are written as three different texts."""
    path = f"{shared_folder(spark)}/customers"
    segment = F.col("c_mktsegment")
    written = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(segment == "FURNITURE", "N/A").when(segment == "MACHINERY", "nan").otherwise(segment).alias(
            "c_mktsegment"
        ),
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey")).alias("c_nationkey"),
    )
    layout.write_csv(written, path)
    return tables.read_foreign_csv(spark, path, written.schema)


def quoted_csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages, their line breaks in quotes, in few large files that many tasks read."""
    path = f"{shared_folder(spark)}/pages"
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    layout.write_quoted_csv(pages, path)
    size = pages.agg(F.sum(joins.held_bytes(pages))).first()[0] or 0
    split = max(size // 64, 4096)  # a record may span several
    return tables.read_foreign_csv(spark, path, pages.schema, multi_line=True, split_bytes=split)


def keyed_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days delivered again by key, after a writer that failed and before one that comes twice; other days stay."""
    root = f"{shared_folder(spark)}/table"
    events = _daily_events(spark, sf_dir).select("event_id", "value", "pickup_date")
    snapshots.create(events, root, by="pickup_date", delivery="first")
    id = F.col("event_id")
    again = events.where(F.col("pickup_date").isin("2024-01-02", "2024-01-10"))
    changed = again.where(id % 10 == 3).withColumns({"value": F.col("value") + 1, "gone": F.lit(False)})
    removed = again.where(id % 10 == 4).withColumns({"value": F.lit(None).cast("double"), "gone": F.lit(True)})
    added = again.where(id % 50 == 0).withColumns({"event_id": id + 1_000_000_000, "gone": F.lit(False)})
    delivery = replicate.union_versions(changed, removed, added)
    snapshots.add_files(delivery.drop("gone"), root, "pickup_date")  # it ends before it commits
    for _ in range(2):
        snapshots.merge(delivery, root, ["pickup_date", "event_id"], "corrections", deleted="gone", by="pickup_date")
    return snapshots.read(spark, root)


def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of one large and many small files; only the small ones are written anew."""
    root = f"{shared_folder(spark)}/table"
    events = table(spark, sf_dir, "events")
    late = F.col("event_id") % 10 >= 7
    snapshots.create(events.where(~late).coalesce(1).unionByName(events.where(late).repartition(30)), root)
    largest = snapshots.files(spark, root).agg(F.max("bytes")).first()[0]
    snapshots.compact(spark, root, file_bytes=largest)
    return snapshots.read(spark, root)


def _delivered_versions(spark: SparkSession, sf_dir: str) -> str:
    """Events in three deliveries: narrow types, wider ones, and wider ones with a further column."""
    path = f"{shared_folder(spark)}/versions"
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", calendar.iso_date(F.col("ts")).alias("day"))
    narrow = events.where(F.col("day") < "2024-01-10").withColumns(
        {"user_id": F.col("user_id").cast("int"), "value": F.col("value").cast("float")}
    )
    late = events.where(F.col("day") >= "2024-01-20").withColumn("channel", F.concat(F.lit("c"), F.col("user_id") % 5))
    for delivery in (narrow, events.where(F.col("day").between("2024-01-10", "2024-01-19")), late):
        layout.write_parquet(delivery, path, mode="append")
    return path


def schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three schema versions in one scan, in types that hold them all."""
    return footers.read_versions(spark, _delivered_versions(spark, sf_dir))


def schema_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which types each column has had, and in how many rows, from the footers alone."""
    history = footers.schema_history(footers.footers(spark, _delivered_versions(spark, sf_dir)))
    return history.select("name", "kind", "rows")


def clustered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of two boxes of ship date and quantity, from a clustered and a flat table.

    ``fewer_groups``: by their footers, less than half as many row groups had to be read as in the flat table.
    """
    root = shared_folder(spark)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice")
    by = ("l_shipdate", "l_quantity")
    size = layout.listing(spark, f"{sf_dir}/lineitem.parquet").agg(F.sum("length")).first()[0] or 0
    files = max(64, size >> 27)  # of 128 MB at most, by the whole table's size
    cluster.write_clustered(lines, f"{root}/clustered", *by, files=files)
    layout.write_small_files(lines, f"{root}/flat", files)
    day = 86_400_000_000.0
    boxes = spark.createDataFrame(
        [(9496 * day, 9586 * day, 5.0, 9.0), (10957 * day, 11047 * day, 30.0, 33.0)],
        "low0 double, high0 double, low1 double, high1 double",
    )
    groups = {n: cluster.hit_groups(cluster.group_bounds(spark, f"{root}/{n}", *by), boxes).count() for n in ("clustered", "flat")}
    return replicate.union_versions(
        *[
            cluster.read_boxes(spark, f"{root}/{name}", *by, boxes)
            .withColumn("layout", F.lit(name))
            .withColumn("fewer_groups", F.lit(2 * groups[name] < groups["flat"]))
            for name in groups
        ]
    )


def layout_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a copy in another layout has changed, lost or doubled, without a join of the two."""
    root = f"{shared_folder(spark)}"
    events = _daily_events(spark, sf_dir)
    id = F.col("event_id")
    copied = events.where(id % 101 != 0).withColumn("value", F.when(id % 97 == 0, F.col("value") + 1).otherwise(F.col("value")))
    layout.write_partitioned(replicate.union_versions(copied, events.where(id % 103 == 0)), f"{root}/copy", "pickup_date")
    layout.write_parquet(events, f"{root}/flat")
    copy = tables.read_partitioned(spark, f"{root}/copy", events.schema)
    return difference.difference(tables.read_parquet(spark, f"{root}/flat"), copy)


def hot_key_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot keys among nearly as many keys as rows."""
    order = F.col("l_orderkey")
    key = F.when(order % 5 == 0, -1).when(order % 7 == 0, -2).when(order % 40 == 3, -(order % 3) - 3)
    line = table(spark, sf_dir, "lineitem").select(F.coalesce(key, order * 10 + F.col("l_linenumber")).alias("key"))
    return shares.hot_keys(line, "key", 0.005)


def weighted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A twentieth of the orders, large ones likelier."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.weighted_sample(orders, "o_orderkey", "o_totalprice", "race", lambda n: F.floor(n / 20).cast("bigint"))


def drift_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days on which columns of the events appear, vanish or change their share of missing values."""
    id, day = F.col("event_id"), calendar.iso_date(F.col("ts"))
    value, user = F.col("value"), F.col("user_id")
    columns = {
        "appears": F.when(day >= "2024-01-12", value),
        "vanishes": F.when(day < "2024-01-20", user),
        "twice": F.when((day < "2024-01-08") | (id % 10 < F.when(day < "2024-01-23", 3).otherwise(8)), value),
        "steady": F.when(id % 20 != 0, value),
        "event_type": F.col("event_type"),
    }
    events = table(spark, sf_dir, "events").select(day.alias("day"), *[c.alias(name) for name, c in columns.items()])
    return drift.change_points(events, "day", list(columns)).drop("share_before", "share_after")


def strongest_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best cut of the days for each column, with its score."""
    id, day = F.col("event_id"), calendar.iso_date(F.col("ts"))
    late = F.when(F.col("event_type") == "click", day >= "2024-01-15").otherwise(day >= "2024-01-09")
    events = table(spark, sf_dir, "events").select(
        day.alias("day"),
        F.when(late | (id % 7 == 0), F.col("value")).alias("value"),
        F.when(~late | (id % 3 == 0), F.col("user_id")).alias("user_id"),
    )
    days = drift.missing_per_day(events, "day", ["value", "user_id"]).withColumn("stretch", F.lit(0))
    return drift.best_cuts(days).drop("stretch")


def quarantine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, some of them broken: good rows, and bad lines with their reasons."""
    path = f"{shared_folder(spark)}/lines"
    id = F.col("event_id")
    row = F.concat(
        F.lit('{"event_id":'), id.cast("string"), F.lit(',"event_type":"'), F.col("event_type"),
        F.lit('","user_id":'), F.when(id % 50 == 9, F.lit('"many"')).otherwise(F.col("user_id").cast("string")), F.lit("}"),
    )
    line = (
        F.when(id % 50 == 7, F.substr(row, F.lit(1), F.char_length(row) - 4)).when(id % 50 == 11, "").when(id % 50 == 13, "[1, 2]")
        .when(id % 50 == 15, F.replace(row, F.lit('"event_id"'), F.lit('"id"'))).otherwise(row)
    )
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("user_id", T.LongType())]
    )
    good = quarantine.good_rows(spark, path, schema, ["event_id"])
    bad = quarantine.bad_lines(spark, path, schema, ["event_id"]).select("line", "reason")
    return replicate.union_versions(good, bad)


QUERIES: dict[str, Query] = {
    "key_share": key_share,
    "curate_wide": curate_wide,
    "dominant_key": dominant_key,
    "distinct_values": distinct_values,
    "bucket_groups": bucket_groups,
    "bucket_counts": bucket_counts,
    "date_parts": date_parts,
    "guarded_ratios": guarded_ratios,
    "charge_total": charge_total,
    "label_codes": label_codes,
    "string_parts": string_parts,
    "schema_normalise": schema_normalise,
    "nested_fields": nested_fields,
    "sane_intervals": sane_intervals,
    "dimension_gate": dimension_gate,
    "join_broadcast": join_broadcast,
    "join_hash": join_hash,
    "join_merge": join_merge,
    "join_skew_aqe": join_skew_aqe,
    "join_skew_salted": join_skew_salted,
    "key_sample": key_sample,
    "weighted_key": weighted_key,
    "slice_rows": slice_rows,
    "head_rows": head_rows,
    "replicate_rows": replicate_rows,
    "union_drift": union_drift,
    "exact_duplicates": exact_duplicates,
    "dedup": dedup,
    "dirty_events": dirty_events,
    "gate_counts": gate_counts,
    "gate_split": gate_split,
    "defect_reconcile": defect_reconcile,
    "defect_manifest": defect_manifest,
    "drift_profile": drift_profile,
    "histogram": value_histogram,
    "stage_stats": stage_stats,
    "report_totals": report_totals,
    "fingerprint": table_fingerprints,
    "layout_roundtrip": layout_roundtrip,
    "layout_fingerprints": layout_fingerprints,
    "text_roundtrip": text_roundtrip,
    "layout_sizes": layout_sizes,
    "append_days": append_days,
    "skip_if_built": skip_if_built,
    "replicate_csv": replicate_csv,
    "partition_prune": partition_prune,
    "column_prune": column_prune,
    "compact_files": compact_files,
    "idempotent_day": idempotent_day,
    "artifact_check": artifact_check,
    "dataset_floor": dataset_floor,
    "csv_null_tokens": csv_null_tokens,
    "schema_versions": schema_versions,
    "schema_history": schema_history,
    "clustered_read": clustered_read,
    "layout_difference": layout_difference,
    "hot_key_sketch": hot_key_sketch,
    "weighted_sample": weighted_sample,
    "drift_points": drift_points,
    "strongest_drift": strongest_drift,
    "quarantine_lines": quarantine_lines,
    "quoted_csv_split": quoted_csv_split,
    "keyed_redelivery": keyed_redelivery,
    "compact_table": compact_table,
}
