"""Sentence pairs in two aligned text files, and the choice of those files in a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from pairloom.functions.fixed_values import UNWANTED_ENDINGS
from pairloom.sources.alignment import alignment_report, require_aligned, zip_sides
from pairloom.sources.positions import numbered_lines


def read_aligned_lines(
    spark: SparkSession, src_path: str, tgt_path: str, strict: bool = True, all_breaks: bool = False
) -> DataFrame:
    """(position, src, tgt).  Empty lines stay as empty text.  ``strict`` counts both sides
    first and fails when they differ; otherwise the longer side's rest comes with null beside it.
    ``all_breaks``: see ``numbered_lines``."""
    src = numbered_lines(spark, src_path, all_breaks).withColumnRenamed("line", "src")
    tgt = numbered_lines(spark, tgt_path, all_breaks).withColumnRenamed("line", "tgt")
    if strict:
        name = F.lit(src_path).alias("dataset")
        require_aligned(alignment_report(src.select(name), tgt.select(name)))
    return zip_sides(src, tgt)


def file_role(file_name: Column, dataset: Column, src_lang: Column, tgt_lang: Column) -> Column:
    """"src", "tgt" or null: the dataset's name must occur and the name end in the code;
    the source code is tried first."""
    unwanted = F.lit(False)
    for ending in UNWANTED_ENDINGS:
        unwanted = unwanted | file_name.endswith(ending)
    named = ~unwanted & F.contains(file_name, dataset)
    return F.when(named & F.endswith(file_name, src_lang), "src").when(
        named & F.endswith(file_name, tgt_lang), "tgt"
    )


def pick_files(listing: DataFrame, named: str = "dataset", by: str = "dataset") -> DataFrame:
    """One row per dataset with its two files, from a listing (dataset, file_name,
    src_lang, tgt_lang).  status is ok, missing or ambiguous.

    ``named`` is the column whose value must occur in the file names, ``by`` the one that
    tells datasets apart.
    """
    role = file_role(F.col("file_name"), F.col(named), F.col("src_lang"), F.col("tgt_lang"))
    of = lambda side: F.when(F.col("role") == side, F.col("file_name"))
    picked = listing.withColumn("role", role).groupBy(F.col(by).alias("dataset")).agg(
        F.max(of("src")).alias("src_file"),
        F.max(of("tgt")).alias("tgt_file"),
        F.count(of("src")).alias("src_matches"),
        F.count(of("tgt")).alias("tgt_matches"),
    )
    fewest = F.least("src_matches", "tgt_matches")
    most = F.greatest("src_matches", "tgt_matches")
    status = F.when(fewest == 0, "missing").when(most > 1, "ambiguous").otherwise("ok")
    return picked.withColumn("status", status)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, path, bytes) of a folder, without reading the files."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", F.col("length").alias("bytes")
    )


def read_aligned_folder(
    spark: SparkSession, folder: str, dataset: str, src_lang: str, tgt_lang: str
) -> DataFrame:
    """(position, src, tgt) of the one pair of files that belongs to the dataset."""
    listing = list_files(spark, folder).select(
        "file_name", F.lit(dataset).alias("dataset"),
        F.lit(src_lang).alias("src_lang"), F.lit(tgt_lang).alias("tgt_lang"),
    )
    row = pick_files(listing).first()
    require_found(row, dataset, src_lang, tgt_lang, folder)
    return read_aligned_lines(spark, f"{folder}/{row.src_file}", f"{folder}/{row.tgt_file}")


def require_found(row: Row | None, dataset: str, src_lang: str, tgt_lang: str, folder: str) -> None:
    if row is None or row.status != "ok":
        found = "no file" if row is None else f"{row.src_matches} source and {row.tgt_matches} target files"
        raise FileNotFoundError(f"{dataset} ({src_lang}-{tgt_lang}) in {folder}: {found}")
