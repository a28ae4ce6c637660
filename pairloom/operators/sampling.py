"""Exact sampling and row caps without a global sort or a single-task ranking."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.operators.joins import fits_broadcast, lookup_join
from pairloom.operators.rules import shuffle_key
from pairloom.session import cut_lineage

HASH_DIGITS = 5  # 16**5 = 1,048,576 bins: the bin that is cut holds a millionth of the rows


def sample_size(wanted: float | int | None, total: Column) -> Column:
    """A fraction in (0, 1] means that share, rounded down; a whole number at most all
    rows; anything else all rows."""
    if isinstance(wanted, float) and 0 < wanted <= 1:
        return F.floor(F.lit(wanted) * total).cast("bigint")
    if isinstance(wanted, int):  # True counts as 1, as Python has it
        return F.least(F.lit(int(wanted)).cast("bigint"), total)
    return total


def _wanted(sizes: Mapping[str, float | int | None] | float | int | None, total: Column) -> Column:
    if not isinstance(sizes, Mapping):
        return sample_size(sizes, total)
    choice = F.when(F.lit(False), total)
    for dataset, size in sizes.items():
        choice = choice.when(F.col("dataset") == dataset, sample_size(size, total))
    return choice.otherwise(total)


def sample(
    df: DataFrame, sizes: Mapping[str, float | int | None] | float | int | None, seed: str
) -> DataFrame:
    """Exactly n rows per dataset without replacement: those with the smallest seeded hash.

    A histogram of hash prefixes finds, per dataset, the bin in which the n-th row falls;
    only the ids of that bin, about a millionth of the dataset, are ranked to find the last
    hash to keep.  The rows themselves are then filtered in one scan, without a shuffle.  The
    bins to cut are stored, so the ids are read twice and the rows once.
    """
    ids = df.select("dataset", "pair_id", shuffle_key(seed, "pair_id").alias("_hash"))
    bin_of = F.substring("_hash", 1, HASH_DIGITS)
    histogram = ids.groupBy("dataset", bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # At most 16**5 bins per dataset are ordered here, not the rows.
    order = Window.partitionBy("dataset")
    before = F.sum("n").over(order.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    counted = histogram.select(
        "dataset", "bin", "n", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(order).alias("total")
    ).withColumn("wanted", _wanted(sizes, F.col("total")))
    cut_bins = counted.where(
        (F.col("before") < F.col("wanted")) & (F.col("before") + F.col("n") >= F.col("wanted"))
    ).select(F.col("dataset").alias("cut_key"), F.col("bin").alias("cut_bin"), (F.col("wanted") - F.col("before")).alias("need"))
    # One row per dataset at most; a dataset of which nothing is wanted has none.
    cut_bins = cut_lineage(cut_bins)
    small = fits_broadcast(cut_bins)
    edge = lookup_join(ids, cut_bins, "dataset", "cut_key", "inner", small=small).where(bin_of == F.col("cut_bin"))
    rank = F.row_number().over(Window.partitionBy("dataset").orderBy("_hash", "pair_id"))
    last = edge.withColumn("rank", rank).where(F.col("rank") == F.col("need")).select(
        F.col("dataset").alias("cut_key"), F.col("_hash").alias("cut_hash"), F.col("pair_id").alias("cut_id")
    )
    located = lookup_join(df, last, "dataset", "cut_key", "inner", small=small)
    own = shuffle_key(seed, "pair_id")
    kept = (own < F.col("cut_hash")) | ((own == F.col("cut_hash")) & (F.col("pair_id") <= F.col("cut_id")))
    return located.where(kept).select(df.columns)


def row_cap(df: DataFrame, cap: int) -> DataFrame:
    """The first ``cap`` rows by pair_id, as a filter ``pair_id <= x``.

    x comes from three histograms, each refining one bin of the one before by 2**20 ids, so
    no task ever ranks more than 2**20 rows, and only pair_id is read for it.
    """
    if cap <= 0:
        return df.where(F.lit(False))
    ids = df.select("pair_id")
    edge = _edge(ids.select(F.shiftright("pair_id", 40).alias("bin")), F.lit(cap).cast("bigint"))
    for shift in (20, 0):
        inside = ids.where(F.shiftright("pair_id", shift + 20) == edge.getField("bin"))
        edge = _edge(inside.select(F.shiftright("pair_id", shift).alias("bin")), edge.getField("need"))
    # Without an edge there are no more rows than the cap.
    return df.where(F.col("pair_id") <= F.coalesce(edge.getField("bin"), F.lit((1 << 63) - 1)))


def _edge(bins: DataFrame, wanted: Column) -> Column:
    """struct(bin, need): the bin in which the wanted-th row falls, and how many of its rows
    are wanted.  A scalar subquery, so both fields come from one run of it."""
    histogram = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    # A window over bin counts: at most 2**20 small rows.
    order = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(order), F.lit(0))
    counted = histogram.withColumn("before", before).withColumn("wanted", wanted)
    found = (F.col("before") < F.col("wanted")) & (F.col("before") + F.col("n") >= F.col("wanted"))
    need = (F.col("wanted") - F.col("before")).alias("need")
    return counted.where(found).select(F.struct("bin", need)).scalar()
