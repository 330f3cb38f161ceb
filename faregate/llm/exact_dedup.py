"""Exact duplicates by a tree merge of sorted digest runs.

Every row belongs to one of R runs, R a power of the fan-in and at least the
number of shuffle partitions. A run holds one entry per digest: the best row
seen and how many there were. In each round sixteen neighbouring runs are
merged into one by an aggregation that sorts on (run, digest), so no task ever
sees more than sixteen entries of one text, however often it occurs. After the
last round one run is left, spread over all tasks by digest. The answer then
goes down the same tree, run by run, and reaches the rows by (run, digest):
copies of one text are spread over all R runs there too.

Digests are verified at every level: entries merge only when SHA-256, a second
hash of another kind and the length of the normalised text all agree.

Texts are equal when identical after the white space ``[\\x20\\x09-\\x0D]`` is
deleted; null counts as empty. Of equal texts the longest original stays, then
the smallest id; a null id comes after all others; then the smaller hash of the
whole row. Rows repeated in every column are marked alike by
``mark_duplicates``; ``drop_duplicates`` keeps one of them. Map columns take no
part in the row hash. Column names of the input can't clash with the
operator's own. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregate.operators.layout import written

FAN_IN = 16
SPACE = r"[\x20\x09-\x0D]+"


def _entries(docs: DataFrame, doc_id: str, text: str, runs: int, row: Column | None = None) -> DataFrame:
    """Per row: run, digest, the check on it, its rank among equal texts; ``row`` is carried along."""
    hashable = [f"`{f.name}`" for f in docs.schema if "map<" not in f.dataType.simpleString()]
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    first = docs.select(
        F.col(f"`{doc_id}`").alias("__id"),
        F.char_length(value).cast("bigint").alias("__chars"),
        F.regexp_replace(value, SPACE, "").alias("__normal"),
        F.xxhash64(*hashable).alias("__row_hash"),
        *([row.alias("row")] if row is not None else []),
    )
    rank = F.struct(
        (-F.col("__chars")).alias("chars"),
        F.col("__id").isNull().alias("no_id"),
        F.col("__id").alias("id"),
        F.col("__row_hash").alias("row_hash"),
    )
    return first.select(
        F.pmod("__row_hash", F.lit(runs)).cast("int").alias("run"),
        F.unhex(F.sha2("__normal", 256)).alias("digest"),
        F.struct(F.xxhash64("__normal").alias("hash"), F.octet_length("__normal").alias("bytes")).alias("check"),
        rank.alias("rank"),
        *(["row"] if row is not None else []),
    )


def _runs(docs: DataFrame) -> tuple[int, int]:
    width, runs, rounds = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1, 0
    while runs < width:
        runs, rounds = runs * FAN_IN, rounds + 1
    return runs, rounds


def _answers(entries: DataFrame, rounds: int) -> DataFrame:
    """``run, digest, check, best, size`` for every (run, digest) that rows have."""
    key = ["run", "digest", "check"]
    merged = [
        written(entries.groupBy(*key).agg(F.min("rank").alias("best"), F.count(F.lit(1)).alias("size")))
    ]
    for _ in range(rounds):
        up = merged[-1].withColumn("run", (F.col("run") / FAN_IN).cast("int"))
        merged.append(written(up.groupBy(*key).agg(F.min("best").alias("best"), F.sum("size").alias("size"))))
    answer = merged.pop()
    while merged:
        below = merged.pop().select((F.col("run") / FAN_IN).cast("int").alias("up"), *key)
        above = answer.withColumnRenamed("run", "up")
        answer = below.join(above, ["up", "digest", "check"]).select(*key, "best", "size")
    return answer


def mark_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    runs, rounds = _runs(docs)
    entries = written(_entries(docs, doc_id, text, runs))
    return entries.join(_answers(entries, rounds), ["run", "digest", "check"]).select(
        F.col("rank.id").alias(doc_id),
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("rank") == F.col("best")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with."""
    runs, rounds = _runs(docs)
    answers = _answers(written(_entries(docs, doc_id, text, runs)), rounds)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    best = answers.select("run", "digest", "check", "best")
    stay = _entries(docs, doc_id, text, runs, row).join(best, ["run", "digest", "check"])
    one = stay.filter(F.col("rank") == F.col("best")).groupBy("run", "digest", "check").agg(F.first("row").alias("row"))
    return one.select("row.*")
