"""Metadata of finished datasets, and what it saves on the next run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.plans.stages import COUNTS


def dataset_metadata(
    summary: DataFrame, lang_pair: str, processed_at: Column, legacy_zero_fallback: bool = False
) -> DataFrame:
    """One metadata row per dataset of ``summary`` (source, dataset, counts, quality_score).

    With ``legacy_zero_fallback`` a count of zero shows the last count that was not zero.
    """
    counts = {}
    for i, name in enumerate(COUNTS):
        if legacy_zero_fallback and i:
            earlier = [F.nullif(F.col(c), F.lit(0)) for c in COUNTS[i:0:-1]]
            counts[name] = F.coalesce(*earlier, F.col(COUNTS[0]))
        else:
            counts[name] = F.col(name)
    return summary.select(
        "source",
        F.col("dataset").alias("dataset_name"),
        F.lit(lang_pair).alias("lang_pair"),
        *[value.alias(name) for name, value in counts.items()],
        "quality_score",
        processed_at.alias("processed_at"),
    )


def latest_metadata(manifest: DataFrame) -> DataFrame:
    """The newest row of every dataset."""
    rest = [c for c in manifest.columns if c != "dataset_name"]
    # Of rows with the same time, those of the later run id.
    order = [c for c in ("processed_at", "run") if c in rest]
    newest = manifest.groupBy("dataset_name").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return newest.select("dataset_name", "r.*")


def still_to_do(catalog: DataFrame, manifest: DataFrame) -> DataFrame:
    """Catalog rows (dataset, ...) without a metadata row; output without metadata counts
    as not done."""
    done = manifest.select(F.col("dataset_name").alias("dataset")).distinct()
    return catalog.join(done, "dataset", "left_anti")


def merged_summary(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored counts of datasets that were skipped, with the counts of this run; a dataset
    in both shows this run."""
    kept = stored.join(new.select("dataset_name"), "dataset_name", "left_anti")
    return kept.withColumn("cached", F.lit(True)).unionByName(new.withColumn("cached", F.lit(False)))
