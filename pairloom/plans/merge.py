"""Merging finished datasets into one corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators.dedup import deduplicate
from pairloom.operators.joins import lookup_join
from pairloom.operators.leakage import drop_leaked, drop_near_leaked


def finished_pairs(pairs: DataFrame, manifest: DataFrame, include_excluded: bool = False) -> DataFrame:
    """Pairs of the datasets the manifest lists; those set aside only on request."""
    listed = manifest if include_excluded else manifest.where(~F.col("excluded"))
    names = listed.select(F.col("dataset_name").alias("listed_name")).distinct()
    return lookup_join(pairs, names, "dataset", "listed_name", "left_semi")


def merge_corpus(
    pairs: DataFrame,
    test: DataFrame | None = None,
    dedup: bool = True,
    near: float | None = None,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """(deduplicated, and free of test sentences as well).  The test set is removed last, so a
    pair it removes has still displaced later pairs with the same source or target.  With
    ``near``, pairs more similar to a test sentence than that go too.

    ``store`` may write the deduplicated corpus once, for both results to read.
    """
    merged = store(deduplicate(pairs)) if dedup else pairs
    if test is None:
        return merged, merged
    final = drop_leaked(merged, test)
    return merged, final if near is None else drop_near_leaked(final, test, near)


def included_datasets(pairs: DataFrame, manifest: DataFrame) -> DataFrame:
    """(dataset_name, rows, quality_score) of what went into the merge."""
    rows = pairs.groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"))
    scores = manifest.select(F.col("dataset_name").alias("dataset"), "quality_score")
    joined = rows.join(scores, "dataset", "left")
    return joined.select(F.col("dataset").alias("dataset_name"), "rows", "quality_score")


def merge_metadata(
    included: DataFrame, lang_pair: str, deduplicated: DataFrame, final: DataFrame, processed_at: Column
) -> DataFrame:
    """One row: the list of datasets (as long as the catalog), and rows before and after
    deduplication and after the removal of test sentences."""
    entry = F.struct("dataset_name", "rows", "quality_score")
    listed = included.agg(
        F.array_sort(F.collect_list(entry)).alias("included_datasets"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows_before_dedup"),
    )
    return listed.select(
        F.lit("merged").alias("dataset_name"),
        F.lit(lang_pair).alias("lang_pair"),
        "included_datasets",
        "total_rows_before_dedup",
        deduplicated.agg(F.count(F.lit(1))).scalar().alias("total_rows_after_dedup"),
        final.agg(F.count(F.lit(1))).scalar().alias("rows_after_leakage"),
        processed_at.alias("processed_at"),
    )
