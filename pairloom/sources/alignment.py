"""Positional pairing of two sides, and the check that they are equally long."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def zip_sides(src: DataFrame, tgt: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., position, src) with (by..., position, tgt): an equi-join on the position,
    whose keys are unique and therefore spread evenly.  A position that only one side has
    comes with null for the other, so no row is lost."""
    return src.join(tgt, [*by, "position"], "full")


def alignment_report(src: DataFrame, tgt: DataFrame, by: str = "dataset") -> DataFrame:
    """Rows of each side per dataset and the number of positions only one side has.

    Positions run without gaps from 0, so two counts tell everything; no rows are joined.
    """
    sides = src.select(by, F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        tgt.select(by, F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    counts = sides.groupBy(by).agg(F.sum("s").alias("src_rows"), F.sum("t").alias("tgt_rows"))
    return counts.withColumn("unmatched", F.abs(F.col("src_rows") - F.col("tgt_rows")))


def require_aligned(report: DataFrame, by: str = "dataset") -> None:
    """Raise if any dataset has sides of different length; names the first few."""
    bad = report.where("unmatched > 0").orderBy(by).limit(10).collect()
    if bad:
        raise ValueError("; ".join(f"{r[by]}: {r.src_rows} source and {r.tgt_rows} target rows" for r in bad))
