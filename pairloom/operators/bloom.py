"""A Bloom filter of a table's keys, to leave out rows before they are shuffled.

The bits of all keys are set by an aggregation over 64-bit words with map-side combine, so every
partition builds its part and Spark merges them.  The filter has 16 bits a key, up to ``MOST_BITS``;
beyond that more rows that match nothing pass, and none that match is ever left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 16
MOST_BITS = 1 << 28  # 32 MB
HASHES = 4


def bits_for(n_keys: int, most: int = MOST_BITS) -> int:
    """A power of two, 64 at least."""
    return min(most, max(64, 1 << (max(1, n_keys) * BITS_PER_KEY - 1).bit_length()))


def bloom_words(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter over a table of one column of 64-bit hashes, null for none, as ``bits`` / 64 words."""
    (name,) = hashes.columns
    h = F.col(name)
    low, high = h.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(h, 32)
    places = F.array(*[(low + high * i).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)])
    placed = hashes.where(h.isNotNull()).select(F.explode(places).alias("p"))
    words = placed.groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("set"))
    found = words.toArrow()
    filled = np.zeros(bits // 64, np.uint64)
    filled[found["word"].to_numpy()] = found["set"].to_numpy().view(np.uint64)
    return filled


def may_contain(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be one that the filter was built from."""
    h = hashes.view(np.uint64)
    low, high = h & np.uint64((1 << 32) - 1), h >> np.uint64(32)
    bits, found = np.uint64(len(words) * 64 - 1), np.ones(len(h), bool)
    for i in range(HASHES):
        p = (low + high * np.uint64(i)) & bits
        found &= (words[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def bloom_column(spark, words: np.ndarray, hashes: Column) -> Column:
    """True where a hash may be in the filter; only hashes go to Python, a batch at a time."""
    shared = spark.sparkContext.broadcast(words)

    @F.arrow_udf("boolean")
    def passes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(may_contain(shared.value, batch.fill_null(0).to_numpy(zero_copy_only=False)))

    return passes(hashes)
