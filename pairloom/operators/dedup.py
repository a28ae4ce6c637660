"""Deduplication of a merged corpus: copies, repeated sources, repeated targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.operators.first import first_per_key, keep_first


def drop_identical(df: DataFrame) -> DataFrame:
    """src equal to tgt is dropped; a null on either side never counts as equal."""
    return df.where(F.coalesce(F.col("src") != F.col("tgt"), F.lit(True)))


def first_per_pair(df: DataFrame) -> DataFrame:
    return first_per_key(df, ["src", "tgt"])


def first_per_source(df: DataFrame) -> DataFrame:
    return first_per_key(df, ["src"])


def first_per_target(df: DataFrame) -> DataFrame:
    return first_per_key(df, ["tgt"])


def deduplicate(df: DataFrame) -> DataFrame:
    """All steps, with two shuffles of hashes and one filter of the rows: the first row per source is
    also the first of its pair, so the pair step needs none of its own.  The target step sees only
    the rows the source step kept."""
    return keep_first(drop_identical(df), [["src"], ["tgt"]])


def dedup_counts(df: DataFrame) -> DataFrame:
    """Rows before and after each step, from one scan.

    Every aggregation sits on the one before and carries its counts: per pair, per source,
    per target, and in all.  Rows are combined on the map side, so no text is hot.
    """
    same = F.coalesce(F.col("src") == F.col("tgt"), F.lit(False)).alias("same")
    by_pair = df.groupBy("src", "tgt", same).agg(F.count(F.lit(1)).alias("n"), F.min("pair_id").alias("first"))
    distinct = ~F.col("same")
    by_source = by_pair.groupBy("src").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(distinct, F.col("n")).otherwise(0)).alias("distinct"),
        F.count_if(distinct).alias("pairs"),
        F.min_by(F.when(distinct, F.struct("tgt")), F.when(distinct, F.col("first"))).alias("kept"),
    )
    # A source of which only identical pairs exist keeps no row and meets no target.
    has_row = F.col("kept").isNotNull().alias("has_row")
    by_target = by_source.groupBy(has_row, F.col("kept.tgt").alias("tgt")).agg(
        *[F.sum(c).alias(c) for c in ("n", "distinct", "pairs")], F.count(F.lit(1)).alias("sources")
    )
    total = by_target.agg(
        *[F.sum(c).alias(c) for c in ("n", "distinct", "pairs")],
        F.sum(F.when(F.col("has_row"), F.col("sources"))).alias("sources"),
        F.count_if("has_row").alias("targets"),
    )
    steps = {
        "input": "n", "drop_identical": "distinct", "first_per_pair": "pairs",
        "first_per_source": "sources", "first_per_target": "targets",
    }
    rows = [
        F.struct(F.lit(i).alias("step_no"), F.lit(step).alias("step"),
                 F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias("rows"))
        for i, (step, c) in enumerate(steps.items())
    ]
    return total.select(F.inline(F.array(*rows)))
