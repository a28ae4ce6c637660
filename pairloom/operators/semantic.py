"""Similarity of the two sides of a pair, and the choice of an encoder per language pair."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions import grams
from pairloom.functions.fixed_values import ENCODER_FAMILIES, SEMANTIC_THRESHOLD
from pairloom.functions.vectors import cosine
from pairloom.operators.joins import fits_broadcast, lookup_join

DIMENSIONS = 64


def gram_encoder(n: int = 3, dimensions: int = DIMENSIONS) -> Callable[[Column | str], Column]:
    """Built-in text encoder: counts of character n-grams folded into a fixed vector.

    It stands where a pretrained sentence encoder would be plugged in; any vectorised
    function from texts to vectors can take its place.
    """

    def encode(texts: pa.Array) -> pa.Array:
        parts = []
        for part in grams.text_chunks(texts):
            values = grams.folded_counts(part, n, dimensions).astype(np.float32).ravel()
            ends = np.arange(len(part) + 1, dtype=np.int32) * dimensions
            parts.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=part.is_null()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))

    return F.arrow_udf(encode, "array<float>")


def gram_similarity(n: int = 3, dimensions: int = DIMENSIONS) -> Callable[[Column | str, Column | str], Column]:
    """Cosine of the two built-in vectors, without the vectors leaving the task's arrays."""

    def similarity(src: pa.Array, tgt: pa.Array) -> pa.Array:
        return pa.array(grams.cosines(src, tgt, n, dimensions), pa.float64(), from_pandas=True)

    return F.arrow_udf(similarity, "double")


def semantic_filter(
    df: DataFrame,
    src_vector: Column | str,
    tgt_vector: Column | str,
    threshold: float = SEMANTIC_THRESHOLD,
) -> DataFrame:
    """Keep pairs whose vectors are strictly more similar than the threshold."""
    return df.where(cosine(src_vector, tgt_vector) > F.lit(threshold))


def with_vectors(pairs: DataFrame, vectors: DataFrame, src_key: str, tgt_key: str) -> DataFrame:
    """Every pair with ``src_vector`` and ``tgt_vector`` out of ``vectors`` (vector_id, vector),
    null where there is none.  The table is measured once; keys may repeat in the pairs."""
    small = fits_broadcast(vectors)
    for key, name in ((src_key, "src_vector"), (tgt_key, "tgt_vector")):
        side = vectors.select(F.col("vector_id").alias("_key"), F.col("vector").alias(name))
        pairs = lookup_join(pairs, side, key, "_key", "left", small=small)
    return pairs


def semantic_filter_by_table(
    pairs: DataFrame,
    vectors: DataFrame,
    src_key: str,
    tgt_key: str,
    threshold: float = SEMANTIC_THRESHOLD,
    missing: str = "drop",
) -> DataFrame:
    """The same over stored vectors.  A pair without one of its vectors is dropped, is kept
    with ``missing="keep"``, or is an error with ``missing="error"``."""
    if missing not in ("drop", "keep", "error"):
        raise ValueError(f"missing is {missing!r}, expected drop, keep or error")
    found = with_vectors(pairs, vectors, src_key, tgt_key)
    absent = F.col("src_vector").isNull() | F.col("tgt_vector").isNull()
    if missing == "error":
        keys = F.concat_ws(", ", F.col(src_key).cast("string"), F.col(tgt_key).cast("string"))
        verdict = F.raise_error(F.concat(F.lit("no vector for one of: "), keys)).cast("boolean")
    else:
        verdict = F.lit(missing == "keep")
    similar = cosine("src_vector", "tgt_vector") > F.lit(threshold)
    return found.where(F.when(absent, verdict).otherwise(similar)).select(pairs.columns)


def missing_vectors(pairs: DataFrame, vectors: DataFrame, src_key: str, tgt_key: str) -> DataFrame:
    """One row: pairs in all, and pairs without a source, a target or any of the two vectors."""
    found = with_vectors(pairs.select(src_key, tgt_key), vectors, src_key, tgt_key)
    no_src, no_tgt = F.col("src_vector").isNull(), F.col("tgt_vector").isNull()
    return found.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(no_src).alias("no_src"),
        F.count_if(no_tgt).alias("no_tgt"), F.count_if(no_src | no_tgt).alias("incomplete"),
    )


def routed_similarity(
    df: DataFrame, scorers: Mapping[str, Callable[[Column, Column], Column]], encoder: str = "encoder"
) -> Column:
    """Similarity of src and tgt by the scorer of the row's own encoder family; null where
    the row has no encoder or its family no scorer.  Each scorer is offered null texts for
    the rows of others, so no model runs on them."""
    unknown = set(scorers) - set(ENCODER_FAMILIES)
    if unknown:
        raise ValueError(f"unknown encoder families {sorted(unknown)}")
    scores = []
    for family, score in scorers.items():
        own = df[encoder] == family
        scores.append(F.when(own, score(F.when(own, df["src"]), F.when(own, df["tgt"]))))
    return F.coalesce(*scores) if scores else F.lit(None).cast("double")


def encoder_family(src_lang: Column | str, tgt_lang: Column | str) -> Column:
    """The first encoder family that knows both codes; null where there is none."""
    src = F.col(src_lang) if isinstance(src_lang, str) else src_lang
    tgt = F.col(tgt_lang) if isinstance(tgt_lang, str) else tgt_lang
    choice = F.when((F.length(src) > 2) | (F.length(tgt) > 2), F.lit(None).cast("string"))
    for family, codes in ENCODER_FAMILIES.items():
        choice = choice.when(src.isin(*codes) & tgt.isin(*codes), F.lit(family))
    return choice


def encoder_status(src_lang: str, tgt_lang: str) -> Column:
    """Why a row has no encoder: its codes are too long, or no family covers the pair."""
    return (
        F.when((F.length(src_lang) > 2) | (F.length(tgt_lang) > 2), "code_too_long")
        .when(encoder_family(src_lang, tgt_lang).isNull(), "pair_not_supported")
        .otherwise("ok")
    )


def route_encoders(df: DataFrame, src_lang: str = "src_lang", tgt_lang: str = "tgt_lang") -> DataFrame:
    """Every row with its encoder family; no table is joined, the code sets are constants."""
    return df.withColumns(
        {"encoder": encoder_family(src_lang, tgt_lang), "status": encoder_status(src_lang, tgt_lang)}
    )


def require_encoders(df: DataFrame, src_lang: str = "src_lang", tgt_lang: str = "tgt_lang") -> DataFrame:
    """Strict form: the job fails on the first pair without an encoder."""
    message = F.concat(
        F.lit("no encoder for "), F.col(src_lang), F.lit("-"), F.col(tgt_lang),
        F.lit(": "), encoder_status(src_lang, tgt_lang),
    )
    family = encoder_family(src_lang, tgt_lang)
    return df.withColumn("encoder", F.coalesce(family, F.raise_error(message).cast("string")))
