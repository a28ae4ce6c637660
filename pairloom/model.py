"""The one row shape every operator works on: a sentence pair.

``pair_id`` is unique across all datasets and grows in load order, so "keep the
first" is always "keep the smallest pair_id", whatever the partitioning.  The
catalog reader builds it as ``dataset_rank * 2**40 + position``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

PAIR_SCHEMA = T.StructType(
    [
        T.StructField("pair_id", T.LongType(), False),
        T.StructField("dataset", T.StringType(), True),
        T.StructField("src", T.StringType(), True),
        T.StructField("tgt", T.StringType(), True),
    ]
)

POSITION_BITS = 40
SPLIT_BITS = 34


def below(number: Column, bits: int, what: str) -> Column:
    """``number``, or an error where it needs more than ``bits`` bits: an id never repeats in silence."""
    number = number.cast("bigint")
    failed = F.raise_error(F.concat(F.lit(f"too many {what} for ids of {bits} bits: "), number.cast("string"))).cast("bigint")
    return F.when(F.shiftrightunsigned(number, bits) != 0, failed).otherwise(number)


def ranked_id(rank: Column, most: int, position: Column) -> Column:
    """The id of a row of the dataset with ``rank``; no rank is above ``most``."""
    if most >= 1 << (63 - POSITION_BITS):
        raise ValueError(f"more than {1 << (63 - POSITION_BITS)} datasets")
    return F.shiftleft(rank.cast("bigint"), POSITION_BITS) + below(position, POSITION_BITS, "rows of a dataset")


def global_id(dataset_rank: int, position: Column) -> Column:
    return ranked_id(F.lit(dataset_rank), dataset_rank, position)


def columns_except(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c not in names]
