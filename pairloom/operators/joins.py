"""Lookup joins that stay safe when one key holds a large share of the rows.

The lookup side has unique keys.  It is broadcast only after its rows and bytes have
been measured; beyond the bound the join shuffles, with the hot keys of the big side
spread over several salted copies of the lookup rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_BYTES = 64 << 20
SALTS = 16


def _row_bytes(df: DataFrame) -> Column:
    total = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(field.name)
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
            size = F.greatest(F.size(field.name), F.lit(0)) * 8
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            size = F.octet_length(F.to_json(F.struct(field.name)))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0)) + 8
    return total


def measured_bytes(df: DataFrame) -> int:
    """Bytes ``df`` needs in memory: one aggregate over it, one row to the driver."""
    return df.agg(F.coalesce(F.sum(_row_bytes(df).cast("bigint")), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    left: str,
    right: str,
    how: str,
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
    sized_by: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """``big`` joined to ``lookup`` (unique on ``right``); null keys match null keys.

    ``how`` is inner, left, left_semi or left_anti.  The key column of the lookup side is
    not part of the result.  ``sized_by`` is measured in place of a lookup that is costly
    to compute: a cheap table with at least as many rows (e.g. the distinct keys).  ``small``
    is the answer of an earlier measurement, in place of one here.
    """
    key = F.col("lookup." + right)
    match = F.col("big." + left).eqNullSafe(key)
    if small is None:
        small = fits_broadcast(lookup if sized_by is None else sized_by, limit)
    if small:
        joined = big.alias("big").join(F.broadcast(lookup).alias("lookup"), match, how)
    else:
        # Rows of one hot key go to `salts` tasks; each finds its own copy of the lookup row.
        identity = ["pair_id"] if "pair_id" in big.columns else big.columns
        spread = big.withColumn("salt", F.pmod(F.xxhash64(*identity), F.lit(salts)))
        copies = lookup.withColumn(
            "copy", F.explode(F.array([F.lit(i).cast("bigint") for i in range(salts)]))
        )
        match = match & (F.col("big.salt") == F.col("lookup.copy"))
        joined = spread.alias("big").join(copies.alias("lookup"), match, how)
    kept = [F.col(f"big.`{c}`") for c in big.columns]
    if how in ("inner", "left"):
        kept += [F.col(f"lookup.`{c}`") for c in lookup.columns if c != right]
    return joined.select(kept)
