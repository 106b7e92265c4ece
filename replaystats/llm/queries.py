"""One query per operator over its whole table, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replaystats.llm import (
    bpe,
    decontaminate,
    divergence,
    jaccard_join,
    licenses,
    line_dedup,
    lm_score,
    pii,
    quality,
    suffix_dedup,
    toxicity,
    warc,
    whitening,
)
from replaystats.llm.sql import SQL

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    coded = bpe.encode(docs, "text", RANKS, public_tokenizers.PATTERN).select("doc_id", "token_ids")
    back = bpe.decode(coded, "token_ids", RANKS, public_tokenizers.PATTERN)
    return back.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    apart = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    labels = _read(spark, sf_dir, "labels", "doc_id", "toxic").filter(~apart)
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.find_leaks(docs, _read(spark, sf_dir, "benchmark", "item_id", "text"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.link(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return linked.select("doc_id", "n_shingles", "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    manifest = warc.write(_read(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    back = warc.read(manifest, folder, payloads=False)
    return back.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return licenses.scan(docs, licenses.train(docs))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.find_repeats(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_read(spark, sf_dir, "documents", "doc_id", "text"), RANKS, public_tokenizers.PATTERN)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rate(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return rated.drop("text")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(_read(spark, sf_dir, "documents", "doc_id", "text")))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents", "text", "lang", "source"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    # A deviation beyond a long is null here; the operator itself has it as a decimal.
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_decontaminate": op3_decontaminate,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_licenses": op7_licenses,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_lm_score": op9_lm_score,
    "op10_quality": op10_quality,
    "op11_pii": op11_pii,
    "op12_divergence": op12_divergence,
    "op13_whitening": op13_whitening,
}
ORACLE = {name: text for name, text in SQL.items() if name in QUERIES}
