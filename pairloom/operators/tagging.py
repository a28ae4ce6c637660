"""Language tags on rows, and the union of corpora with different columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def tag_languages(df: DataFrame, src_lang: str, tgt_lang: str, keep: Iterable[str] = ()) -> DataFrame:
    """src and tgt as ``sentence_<lang>`` columns plus the two language tags."""
    return df.select(
        *keep,
        F.col("src").alias(f"sentence_{src_lang}"),
        F.col("tgt").alias(f"sentence_{tgt_lang}"),
        F.lit(src_lang).alias("src_lang"),
        F.lit(tgt_lang).alias("tgt_lang"),
    )


def union_corpora(corpora: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; a language a corpus lacks is null there, nothing is lost."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), corpora)
