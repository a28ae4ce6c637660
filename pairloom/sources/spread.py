"""Use of all cores on inputs that come in few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.operators.joins import measured_bytes

PART_BYTES = 32 << 20


def spread_small_input(df: DataFrame, key: str) -> DataFrame:
    """Rows spread by a unique key when a scan has fewer splits than there are cores.

    A small Parquet file often has one row group, which one task reads alone.  An input with
    at least one split per core comes back unchanged: large data is not shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def sorted_parts(df: DataFrame, key: str, least: int) -> DataFrame:
    """Rows in the order of ``key``, in as many sorted partitions as their bytes ask for, ``least`` or more.

    Rows of equal keys stay in the order they are read in, and their place there tells them
    apart, so neither null nor repeated keys fill one partition.
    """
    parts = max(least, -(-measured_bytes(df) // PART_BYTES))
    order = [F.col(key), F.col("_place")]
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    return placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_place")
