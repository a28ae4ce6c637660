"""The corpus pipeline: five stages over documents, each on all rows that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import bpe, decontaminate, near_duplicates, quality, secrets
from pairloom.llm.queries import VOCABULARY
from pairloom.llm.shared import shared_folder, small_batches, stored, table, text_key
from pairloom.operators.joins import lookup_join

MASK = "[secret]"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good; it is fitted on ``docs`` and the given labels."""
    small_batches(spark)
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs, model, out="__llm_score").where("__llm_score >= 0.5").drop("__llm_score")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    small_batches(spark)
    return near_duplicates.keep_representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    small_batches(spark)
    found = decontaminate.find_passages(docs, "text", spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out="__llm_found")
    return found.where(F.size("__llm_found.spans") == 0).drop("__llm_found")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every reported secret masked; n_chars follows the new text.

    What is found depends on the text alone, so spans are looked up by text.
    """
    small_batches(spark)
    key = text_key(F.col("text"))
    found = secrets.find_secrets(docs.withColumn("__llm_key", key), "__llm_key", "text", F.concat_ws("/", "source", "lang"),
                                 F.col("source"))
    found = stored(found.where(F.size("spans") > 0).dropDuplicates(["doc_id"]).select(
        F.col("doc_id").alias("__llm_of"), F.transform("spans", lambda s: F.struct(s["start"], s["end"])).alias("__llm_spans")))
    joined = lookup_join(docs.withColumn("__llm_key", key), found, "__llm_key", "__llm_of", "left")
    # Only texts with something to mask go to Python.
    there = F.col("__llm_spans").isNotNull()
    masked = F.when(there, secrets.mask_column(MASK)(F.when(there, F.col("text")), "__llm_spans")).otherwise(F.col("text"))
    return joined.withColumn("text", masked).withColumn(
        "n_chars", F.when(F.col("__llm_spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    ).select(*[F.col(f"`{c}`") for c in docs.columns])


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: its tokens and their digest, and whether decoding gives the text back."""
    small_batches(spark)
    path = public_tokenizers.path(VOCABULARY)
    coded = bpe.decode_ids(bpe.encode_texts(docs.select("doc_id", "text"), "text", path), "ids", path)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("encoding", encoding_stage),
]

# The classifier, the MinHash join and the encoder have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, each written as Parquet to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
