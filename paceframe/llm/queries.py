"""Registered queries of the pipeline operators, each over its whole tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import decontaminate, licenses, lines, merkle, mixing, negatives, quality, secrets, shingles, suffixes, tokens, urls, vectors
from .oracles import ORACLES  # noqa: F401

VOCABULARY = "byte_bpe_50k.json"
HELD_OUT = "pmod(crc32(cast(doc_id as string)), 5) = 0"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = licenses.scan(read_table(spark, sf, "documents").select("doc_id", "text"))
    starts = F.transform("base_places", lambda p: p["start"])
    return rows.select(
        "doc_id", "n_words", F.size("base_places").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), "base_labels", "labels", "score",
    )


def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    rows = quality.score(docs, read_table(spark, sf, "labels"), held_out=HELD_OUT)
    return rows.select(
        "doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return shingles.link_classes(read_table(spark, sf, "documents").select("doc_id", "text"))


def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = secrets.scan(read_table(spark, sf, "documents").select("doc_id", "text"))

    def number(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("secrets", secrets.is_base)
    return rows.select(
        "doc_id", number("assign"), number("access"), number("hex"), sha256(secrets.listing(base)).alias("base_sha256"),
        secrets.listing(F.col("secrets")).alias("spans"),
    )


def op5_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = suffixes.repeated_bytes(read_table(spark, sf, "documents").select("doc_id", "text"))
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return rows.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), sha256(F.col("kept")).alias("kept_sha256")
    )


def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(read_table(spark, sf, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "junk_score"
    )


def op7_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf, "embeddings"))


def op8_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf, "documents"))


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    rows = decontaminate.contaminated(
        read_table(spark, sf, "documents").select("doc_id", "text"), read_table(spark, sf, "benchmark")
    )
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        sha256(F.array_join(F.array_sort("items"), ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = lines.dedup(read_table(spark, sf, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", "n_lines", "n_removed", sha256(F.col("kept_text")).alias("kept_sha256"))


def op11_token_output(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    rows = tokens.round_trip(read_table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path(VOCABULARY))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.audit(read_table(spark, sf, "documents"))


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read_table(spark, sf, "embeddings").withColumn("label", label))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_quality_classifier, op3_ngram_jaccard_join, op4_secret_scan, op5_suffix_dedup,
        op6_url_filter, op7_embedding_near_dedup, op8_source_mixing, op9_decontamination, op10_line_dedup, op11_token_output,
        op12_merkle_manifest, op13_hard_negatives, pipeline,
    )
}
