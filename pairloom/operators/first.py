"""Keep the first row per key.

Texts are neither grouped nor sorted: rows become ids and 128-bit hashes of their keys, which hash
aggregation combines on the map side, however often a key occurs.  The ids of the rows to keep are
stored, and the rows themselves are filtered by them once, whatever the number of steps.

A third hash of another form tells whether two keys ever shared one of 128 bits.  If so, the keys
themselves are compared, so the result is exact either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from pairloom.model import columns_except
from pairloom.operators.joins import BROADCAST_BYTES
from pairloom.session import cut_lineage

ID_BYTES = 32  # of one id in a broadcast table


def key_hashes(keys: Sequence[str]) -> list[Column]:
    """Two halves of 128 bits; nulls equal nulls."""
    return [F.xxhash64(F.lit(seed), *keys) for seed in ("first", "second")]


def key_check(keys: Sequence[str]) -> Column:
    """A hash of another form, from checksums and lengths, which also tells a null from every text."""
    texts = [F.col(k).cast("string") for k in keys]
    parts = [[F.coalesce(F.crc32(t.cast("binary")), F.lit(-1)), F.coalesce(F.octet_length(t), F.lit(-1))] for t in texts]
    return F.xxhash64(*[part for pair in parts for part in pair])


def first_ids(df: DataFrame, steps: Sequence[Sequence[str]], order: str) -> DataFrame:
    """(order, clash) of the rows that are left when the first per key is kept, step by step.

    ``clash`` says that rows with different keys may have met under one hash.
    """
    hashes = {f"_{i}{part}": column for i, keys in enumerate(steps)
              for part, column in zip("abc", [*key_hashes(keys), key_check(keys)], strict=True)}
    rows = df.select(order, *[column.alias(name) for name, column in hashes.items()], F.lit(False).alias("clash"))
    for i in range(len(steps)):
        later = [name for name in hashes if int(name[1:-1]) > i]
        check = F.col(f"_{i}c")
        rows = rows.groupBy(f"_{i}a", f"_{i}b").agg(
            F.min(order).alias(order), *[F.min_by(name, order).alias(name) for name in later],
            (F.max("clash") | (F.min(check) != F.max(check))).alias("clash"))
    return rows.select(order, "clash")


def keep_first(df: DataFrame, steps: Sequence[Sequence[str]], order: str = "pair_id", limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows left when, step by step, the one with the smallest ``order`` is kept for every distinct
    keys of the step; nulls equal nulls.  ``order`` is unique and comes out the same whenever ``df`` is read."""
    told = Observation()
    ids = first_ids(df, steps, order).observe(told, F.count(F.lit(1)).alias("n"), F.max("clash").alias("clash"))
    ids = cut_lineage(ids)
    n, clash = told.get["n"], told.get["clash"]
    if clash:
        for keys in steps:
            df = _first_by_text(df, keys, order)
        return df
    kept = ids.select(F.col(order).alias("kept_id"))
    if n * ID_BYTES <= limit:
        kept = F.broadcast(kept)
    return df.join(kept, F.col(order) == F.col("kept_id"), "left_semi")


def _first_by_text(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    best = F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), order)
    return df.groupBy(*keys).agg(best.alias("_row")).select("_row.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: str = "pair_id") -> DataFrame:
    """The row with the smallest ``order`` for every distinct ``keys``; nulls equal nulls.

    When nothing but keys and order is carried, one hash aggregation does.
    """
    if columns_except(df, order, *keys):
        return keep_first(df, [keys], order)
    return df.groupBy(*keys).agg(F.min(order).alias(order)).select(*df.columns)
