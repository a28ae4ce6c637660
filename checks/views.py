"""Sentence pairs and side tables derived from the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.sources.spread import spread_small_input

LINE_IDS = 1_000_000  # lines of a document at most; more are an error


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small_input(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "doc_id")


def pairs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacent lines of every document, with the document's language; the last line of a
    document has a null target."""
    return adjacent_lines(documents(spark, sf_dir))


def adjacent_lines(docs: DataFrame) -> DataFrame:
    extra = [c for c in docs.columns if c not in ("text", "source")]
    lines = docs.select(*extra, F.col("source").alias("dataset"), F.split("text", "\n").alias("lines"))
    nexts = F.slice("lines", F.lit(2), F.size("lines"))
    rows = lines.select(*extra, "dataset", F.posexplode(F.arrays_zip(F.col("lines").alias("s"), nexts.alias("t"))))
    # Line LINE_IDS + 1 would have the id of the next document's first line.
    failed = F.raise_error(F.concat(F.lit("too many lines for the ids of document "), F.col("doc_id").cast("string")))
    pos = F.when(F.col("pos") >= LINE_IDS, failed.cast("int")).otherwise(F.col("pos"))
    return rows.select(
        (F.col("doc_id") * LINE_IDS + pos + 1).alias("pair_id"),
        "dataset", *extra, F.col("col.s").alias("src"), F.col("col.t").alias("tgt"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_wide(spark, sf_dir).select("pair_id", "dataset", "src", "tgt")


def aligned_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two line-numbered sides (dataset, position, text): a document, and the document
    that follows it.  Their numbers of lines differ."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    position = F.col("pos").cast("bigint").alias("position")
    src = lines.select(F.col("doc_id").alias("dataset"), position, F.col("line").alias("src"))
    tgt = lines.select((F.col("doc_id") - 1).alias("dataset"), position, F.col("line").alias("tgt"))
    return src, tgt


def test_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the benchmark items, as both sides of a test set."""
    lines = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", "\n")).alias("src")).distinct()
    return lines.withColumn("tgt", F.col("src"))


def vector_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pairs of neighbouring vector ids, and the vectors."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("vector_id"), F.col("embedding").alias("vector")
    )
    ids = vectors.select(F.col("vector_id").alias("src_id"), (F.col("vector_id") + 1).alias("tgt_id"))
    return ids, vectors


def quality_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))


def labelled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with both sides present, of the documents with a label, and that label.  The
    join is made while there is one row per document."""
    labelled = documents(spark, sf_dir).join(quality_by_document(spark, sf_dir), "doc_id")
    return adjacent_lines(labelled).where("tgt is not null")
