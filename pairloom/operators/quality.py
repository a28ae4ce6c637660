"""Quality of pairs and of whole datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.functions.fixed_values import QUALITY_THRESHOLD
from pairloom.functions.text import strip, token_count
from pairloom.operators.joins import lookup_join

RATIO_BINS = 20
TOKEN_BINS = 12


def with_bins(df: DataFrame) -> DataFrame:
    """Two coarse features of the stripped texts: how alike their lengths are (ratio_bin, 0
    to 20) and how long the longer one is (size_bin, log2 of its tokens, 0 to 12).

    Each step is a projection of its own, so that no text is stripped or counted twice.
    """
    stripped = df.withColumns({"_a": strip("src"), "_b": strip("tgt")})
    measured = stripped.withColumns({
        "_short": F.least(F.length("_a"), F.length("_b")),
        "_long": F.greatest(F.length("_a"), F.length("_b")),
        "_tokens": F.greatest(token_count("_a"), token_count("_b")),
    })
    alike = F.floor(F.col("_short") * RATIO_BINS / F.greatest("_long", F.lit(1)))
    # The binary digits of n are floor(log2 n) + 1.
    size = F.least(F.length(F.bin("_tokens")) - 1, F.lit(TOKEN_BINS))
    return measured.select(
        *df.columns,
        F.coalesce(alike.cast("int"), F.lit(0)).alias("ratio_bin"),
        F.coalesce(size.cast("int"), F.lit(0)).alias("size_bin"),
    )


def train_quality(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Score table per feature bin: the smoothed share of good pairs among labelled ones.

    It stands where a pretrained estimator would be plugged in.  There are at most
    21 * 13 bins, so the table has a fixed bound.
    """
    good = F.sum(F.col(label).cast("bigint"))
    score = (good + 1) / (F.count(F.lit(1)) + 2)
    return with_bins(labelled.select("src", "tgt", label)).groupBy("ratio_bin", "size_bin").agg(score.alias("quality"))


def score_quality(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs with their ``quality``; a bin never seen in training scores one half."""
    # One row per bin that exists: at most 21 * 13, whatever table is given.
    bins = table.where(F.col("ratio_bin").between(0, RATIO_BINS) & F.col("size_bin").between(0, TOKEN_BINS))
    bins = bins.groupBy("ratio_bin", "size_bin").agg(F.max("quality").alias("quality"))
    joined = with_bins(pairs).join(F.broadcast(bins), ["ratio_bin", "size_bin"], "left")
    return joined.select(*pairs.columns, F.coalesce("quality", F.lit(0.5)).alias("quality"))


def quality_filter(df: DataFrame, score: str = "quality", threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Keep pairs scored at or above the threshold; texts stay as they are."""
    return df.where(F.col(score) >= F.lit(threshold))


def corpus_quality(df: DataFrame, score: str = "quality", by: str = "dataset") -> DataFrame:
    """Mean score per dataset to four digits; a dataset without rows has no score."""
    return df.groupBy(by).agg(F.round(F.avg(score), 4).alias("quality_score"))


def quality_gate(df: DataFrame, threshold: float, score: str = "quality", by: str = "dataset") -> DataFrame:
    """Document-level filter: keep the datasets whose mean score reaches the threshold."""
    good = df.groupBy(by).agg(F.avg(score).alias("mean")).where(F.col("mean") >= threshold)
    keys = good.select(F.col(by).alias("good_key"))
    return lookup_join(df, keys, by, "good_key", "left_semi", sized_by=df.select(by).distinct())
