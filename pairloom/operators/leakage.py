"""Removal of pairs that occur in a test set, exactly or nearly."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.operators import bloom
from pairloom.operators.joins import BROADCAST_BYTES, fits_broadcast, lookup_join
from pairloom.operators.near_leakage import both_sides, drop_near
from pairloom.session import cut_lineage


def drop_leaked(
    pairs: DataFrame,
    test: DataFrame,
    test_src: str = "src",
    test_tgt: str = "tgt",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Drop a pair when its source or its target is in the test set; null matches null.

    Two chained anti joins on equality keep hash joins possible.  A pair found as a whole
    in the test set is found by its source alone, so it needs no third join.  The keys of
    both sides are measured together, once; of a test set beyond the bound, the keys that
    occur in the corpus are found for both sides in one pass and stored.  A Bloom filter of the
    keys leaves out nearly all other texts where they are read, so few are shuffled for that.
    """
    sides = {"src": test_src, "tgt": test_tgt}
    keys = both_sides(test, sides).distinct()
    small = fits_broadcast(keys, limit)
    if not small:
        keys = cut_lineage(keys)
        texts = possible_keys(pairs, keys).distinct().alias("texts")
        met = (F.col("keys.side") == F.col("texts.side")) & F.col("keys.text").eqNullSafe(F.col("texts.text"))
        keys = cut_lineage(keys.alias("keys").join(texts, met, "left_semi"))
        small = fits_broadcast(keys, limit)
    for side in sides:
        of_side = keys.where(F.col("side") == side).select(F.col("text").alias("test_key"))
        pairs = lookup_join(pairs, of_side, side, "test_key", "left_anti", small=small)
    return pairs


def possible_keys(pairs: DataFrame, keys: DataFrame, most_bits: int = bloom.MOST_BITS) -> DataFrame:
    """(side, text) of the texts of ``pairs`` that may be among ``keys`` (side, text): all that are, and
    some false positives."""
    key_hash = F.xxhash64("side", "text")  # a null text has a hash as well
    words = bloom.bloom_words(keys.select(key_hash.alias("h")), bloom.bits_for(keys.count(), most_bits))
    texts = both_sides(pairs, {side: side for side in ("src", "tgt")})
    return texts.where(bloom.bloom_column(pairs.sparkSession, words, key_hash))


def drop_near_leaked(
    pairs: DataFrame,
    test: DataFrame,
    threshold: float,
    test_src: str = "src",
    test_tgt: str = "tgt",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Drop a pair when its source or target is a near match of the test side.

    With a test set of broadcast size that is a filter of the pairs where they lie.
    """
    return drop_near(pairs, both_sides(test, {"src": test_src, "tgt": test_tgt}), threshold, limit)
