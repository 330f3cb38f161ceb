"""The registered queries of the corpus operators; each covers its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregate.llm import (
    exact_dedup,
    filter_audit,
    fingerprints,
    language,
    line_dedup,
    minhash,
    mixing,
    packing,
    quality,
    secrets,
    suffix_dedup,
    warc,
    whitening,
)
from faregate.llm.common import table
from faregate.llm.oracle import ORACLE
from faregate.session import shared_folder


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/archives"
    warc.write_archives(table(spark, sf_dir, "pages"), path)

    def page(name: str):
        return F.regexp_extract(name, "^urn:x-page:(-?[0-9]+)$", 1).try_cast("bigint")

    return warc.read_archives(spark, path, with_payload=False).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
        "error",
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return marked.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_probe(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secrets.scan(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return scanned.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.concat("base", "added")).alias("spans"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduped(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_minhash": op5_minhash,
    "op6_fingerprints": op6_fingerprints,
    "op7_secrets": op7_secrets,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_line_dedup": op11_line_dedup,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_filter_audit": op13_filter_audit,
}
__all__ = ["ORACLE", "QUERIES"]
