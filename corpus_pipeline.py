"""Pipeline from raw documents to token ids: toxicity, line dedup, near duplicates, decontamination, BPE.

Each stage is written as Parquet to the shared folder and read again, so a lost executor costs one
stage's tasks and no plan grows over stages. All but the last return the columns of the documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replaystats.llm import bpe, decontaminate, jaccard_join, line_dedup, toxicity
from replaystats.llm.lm_score import held_out
from replaystats.llm.queries import RANKS
from replaystats.session import stage, staging_root

# Byte-level BPE and factorization machines are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below a half. It learns from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(~held_out(F.col("doc_id"), 0)))
    return toxicity.reject(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines repeated across documents; n_chars follows the text."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    kept = line_dedup.dedup_lines(docs, carry=others).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in others else kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the row of smallest id, a
    null id last; of an id's rows in a group that of smallest text key. Repeated rows of that id and text
    stay once. Texts without a word have no group and all stay."""
    linked = jaccard_join.link(docs, words=5, part=80, whole=100).filter("component is not null")
    linked = stage(linked.select("doc_id", F.col("text_key").alias(KEY), "component"), "linked")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", KEY)
    first = linked.groupBy("component").agg(F.min(row).alias("first"))
    others = linked.join(first, "component").filter(row != F.col("first"))
    kept = without_rows(docs, others)
    twice = linked.groupBy("doc_id", KEY).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc_id", KEY)
    if twice.isEmpty():
        return kept
    again = docs.withColumn(KEY, F.xxhash64("text")).join(named(twice), on_row(), "left_semi").drop(KEY)
    again = without_rows(again, others).dropDuplicates(["doc_id", "text"])
    return without_rows(kept, twice).unionByName(again)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias(KEY))
    return without_rows(docs, decontaminate.find_leaks(keyed, items, carry=(KEY,)))


# An id may be null or stand on several texts, so a decision about a text goes by its row: id and hash.
KEY = "_text_key"


def named(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").alias("_id"), F.col(KEY).alias("_key")).distinct()


def on_row():
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col(KEY) == F.col("_key"))


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents without those that ``rows`` names by id and text key."""
    return docs.withColumn(KEY, F.xxhash64("text")).join(named(rows), on_row(), "left_anti").drop(KEY)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, token_ids, n_tokens, and digests of the ids and of the decoded bytes) per document."""
    back = bpe.round_trip(docs.select("doc_id", "text"), "text", RANKS, public_tokenizers.PATTERN)
    return back.select(
        "doc_id",
        "token_ids",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{staging_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
