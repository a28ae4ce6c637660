"""Near matches of test texts: token-set Jaccard similarity above a threshold, exactly.

All tokens have one order, rare ones first (by how many test texts hold them; unknown ones are the
rarest).  A set of n tokens that is more than t-similar to another shares one with it among its first
n - ceil(t*n) + 1 in that order, its *prefix*, and the other's prefix holds that token, too.  So texts
meet only on tokens of both prefixes, and only if their sizes, and what can still follow the
places of that token, allow enough common tokens.

A test set whose index fits a broadcast is searched where the corpus lies: texts become arrays of
token numbers, a batch at a time, and no row leaves its task.  A text without enough tokens known to
the test set, which is nearly every one, ends there.  With a larger test set the corpus sends the
tokens of its prefixes, and whole sets are compared for candidates alone.

Arrays are numpy's; there is no loop over rows or tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.text import word_set
from pairloom.operators.joins import BROADCAST_BYTES, fits_broadcast
from pairloom.session import cut_lineage

FREQUENT = 1 << 17  # tokens whose frequency the order knows when the test set is large; the others count as rare
CHUNK = 1 << 20  # candidates that are looked at together
_SLACK = 1e-9


def needed(n: np.ndarray, threshold: float) -> np.ndarray:
    """The common tokens that a set of ``n`` must have with a similar one, at least."""
    return np.ceil(n * threshold - _SLACK).astype(np.int64)


# Token sets of a batch.

def token_sets(texts: pa.Array, order: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct tokens, text, number of the token, its place in ``order`` or -1) of each token of each text."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    tokens = lists.flatten().dictionary_encode()
    parents = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    filled = pc.not_equal(tokens.dictionary, "").to_numpy(zero_copy_only=False)
    codes = tokens.indices.to_numpy().astype(np.int64)
    kept = filled[codes]
    pairs = np.unique(parents[kept] << 32 | codes[kept])
    parent, code = pairs >> 32, pairs & 0xFFFFFFFF
    place = pc.fill_null(pc.index_in(tokens.dictionary, value_set=order), -1).to_numpy().astype(np.int64)
    return tokens.dictionary, parent, code, place[code]


def _ranks(parent: np.ndarray) -> np.ndarray:
    """The place of each row within its run of equal parents."""
    first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]]) if len(parent) else np.empty(0, np.int64)
    return np.arange(len(parent)) - np.repeat(first, np.diff(np.r_[first, len(parent)]))


@dataclass
class LeakIndex:
    """The token sets of one side of a test set, and which of them have a token in their prefix."""

    order: pa.Array  # tokens, rare ones first
    tokens: np.ndarray  # places in the order, ascending, text after text
    starts: np.ndarray
    filed: np.ndarray  # texts by token of their prefix
    filed_starts: np.ndarray
    threshold: float

    @classmethod
    def build(cls, texts: pa.Array, threshold: float) -> LeakIndex:
        _, _, code, _ = found = token_sets(texts, pa.array([], pa.string()))
        counts = np.bincount(code, minlength=len(found[0]))
        order = found[0].take(pa.array(np.lexsort((np.arange(len(counts)), counts)))) if len(counts) else found[0]
        _, parent, _, place = token_sets(texts, order)
        by = np.lexsort((place, parent))
        parent, place = parent[by], place[by]
        sizes = np.bincount(parent, minlength=len(texts))
        starts = np.r_[0, np.cumsum(sizes)]
        prefix = _ranks(parent) < (sizes - needed(sizes, threshold) + 1)[parent]
        by_token = np.lexsort((parent[prefix], place[prefix]))
        filed_starts = np.searchsorted(place[prefix][by_token], np.arange(len(order) + 1))
        return cls(order, place, starts, parent[prefix][by_token], filed_starts, threshold)

    def near(self, texts: pa.Array) -> pa.Array:
        """Whether each text is more similar to a test text than the threshold; equal texts are decided once."""
        encoded = texts.dictionary_encode()
        if not len(encoded.dictionary):
            return pa.array(np.zeros(len(texts), bool))
        hits = self._search(encoded.dictionary)
        return pc.fill_null(pa.array(hits).take(encoded.indices), False)

    def _search(self, texts: pa.Array) -> np.ndarray:
        hits = np.zeros(len(texts), bool)
        _, parent, _, place = token_sets(texts, self.order)
        sizes = np.bincount(parent, minlength=len(texts))
        known = place >= 0
        n_known = np.bincount(parent[known], minlength=len(texts))
        least = needed(sizes, self.threshold)
        alive = known & ((n_known >= least) & (sizes > 0))[parent]
        parent, place = parent[alive], place[alive]
        by = np.lexsort((place, parent))
        parent, place = parent[by], place[by]
        # Unknown tokens come first and take up the prefix.
        prefix = _ranks(parent) < (n_known - least + 1)[parent]
        own, token = parent[prefix], place[prefix]
        listed = self.filed_starts[token + 1] - self.filed_starts[token]
        sets = parent << 32 | place
        ends = np.cumsum(listed)
        done = 0
        while done < len(own):
            until = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + CHUNK, "right")))
            self._compare(hits, own[done:until], token[done:until], listed[done:until], sizes, sets)
            done = until
        return hits

    def _compare(self, hits: np.ndarray, own: np.ndarray, token: np.ndarray, listed: np.ndarray, sizes: np.ndarray, sets: np.ndarray) -> None:
        text = np.repeat(own, listed)
        other = self.filed[np.repeat(self.filed_starts[token], listed) + _ranks(np.repeat(np.arange(len(own)), listed))]
        n, m = sizes[text], self.starts[other + 1] - self.starts[other]
        fits = (n >= m * self.threshold) & (m >= n * self.threshold) & ~hits[text]
        met = np.unique(text[fits] << 32 | other[fits])
        for at in range(0, len(met), CHUNK >> 4):
            text, other = met[at:at + (CHUNK >> 4)] >> 32, met[at:at + (CHUNK >> 4)] & 0xFFFFFFFF
            n, m = sizes[text], self.starts[other + 1] - self.starts[other]
            pair = np.repeat(np.arange(len(text)), m)
            wanted = text[pair] << 32 | self.tokens[np.repeat(self.starts[other], m) + _ranks(pair)]
            at_place = np.minimum(np.searchsorted(sets, wanted), len(sets) - 1)
            shared = np.bincount(pair, sets[at_place] == wanted, minlength=len(text))
            hits[text[shared / (n + m - shared) > self.threshold]] = True


# Columns and joins.

def _index_of(test: DataFrame, side: str, threshold: float) -> LeakIndex:
    texts = test.where((F.col("side") == side) & F.col("text").isNotNull()).select("text").toArrow()["text"].combine_chunks()
    texts = texts if isinstance(texts, pa.Array) else pa.array([], pa.string())
    return LeakIndex.build(texts.cast(pa.string()), threshold)


def near_column(spark, index: LeakIndex):
    """A function of a text column: whether a text is near a text of ``index``."""
    shared = spark.sparkContext.broadcast(index)

    @F.arrow_udf("boolean")
    def near(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield shared.value.near(texts.cast(pa.string()))

    return near


def prefix_column(spark, order: pa.Array, threshold: float):
    """A function of a text column: (token, its place, size of the set) of the prefix of each text."""
    shared = spark.sparkContext.broadcast(order)
    kind = pa.list_(pa.struct([("token", pa.string()), ("pos", pa.int32()), ("n", pa.int32())]))

    def prefixes(texts: pa.Array) -> pa.Array:
        names, parent, code, place = token_sets(texts, shared.value)
        by_name = np.empty(len(names), np.int64)  # tokens of one frequency, most often unknown ones, go by name
        by_name[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        by = np.lexsort((by_name[code], place, parent))
        parent, code = parent[by], code[by]
        sizes = np.bincount(parent, minlength=len(texts))
        pos = _ranks(parent)
        kept = pos < (sizes - needed(sizes, threshold) + 1)[parent]
        offsets = np.searchsorted(parent[kept], np.arange(len(texts) + 1)).astype(np.int32)
        fields = [names.take(pa.array(code[kept])), pa.array(pos[kept].astype(np.int32)), pa.array(sizes[parent[kept]].astype(np.int32))]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, fields=list(kind.value_type)))

    @F.arrow_udf("array<struct<token: string, pos: int, n: int>>")
    def prefix(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield prefixes(texts.cast(pa.string()))

    return prefix


def both_sides(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(side, text) of two text columns, in one scan."""
    sides = [F.struct(F.lit(side).alias("side"), F.col(c).alias("text")) for side, c in columns.items()]
    return df.select(F.inline(F.array(*sides)))


def drop_near(pairs: DataFrame, test: DataFrame, threshold: float, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``pairs`` without those that have a side above ``threshold`` to a test text (side, text)."""
    if threshold <= 0 or not math.isfinite(threshold):
        raise ValueError(f"threshold {threshold}: expected more than 0")
    test = cut_lineage(test.distinct())
    if fits_broadcast(test, limit):
        near = [near_column(pairs.sparkSession, _index_of(test, side, threshold))(F.col(side)) for side in ("src", "tgt")]
        flagged = pairs.withColumns({"_near_src": near[0], "_near_tgt": near[1]})
        return flagged.where("NOT _near_src AND NOT _near_tgt").select(pairs.columns)
    hits = cut_lineage(shuffled_hits(pairs, test, threshold, limit))
    hit = F.broadcast(hits) if fits_broadcast(hits, limit) else hits
    return pairs.join(hit.withColumnRenamed("hit_id", "pair_id"), "pair_id", "left_anti").select(pairs.columns)


def frequent_tokens(test: DataFrame, most: int = FREQUENT) -> pa.Array:
    """The ``most`` frequent tokens of the test texts, the rarer first: bounded, whatever the test set."""
    words = test.select(F.explode(word_set("text")).alias("token"))
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n"), "token").limit(most)
    return pa.array([r.token for r in counts.select("token").collect()][::-1], pa.string())


def meetings(pairs: DataFrame, test: DataFrame, threshold: float, most: int = FREQUENT) -> DataFrame:
    """(pair_id, side, test_id) of texts that share a token of their prefixes and are of fitting size."""
    prefix = prefix_column(pairs.sparkSession, frequent_tokens(test, most), threshold)
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("text")) for s in ("src", "tgt")])
    texts = pairs.select("pair_id", F.inline(sides)).where("text IS NOT NULL")
    own = texts.select("pair_id", "side", F.inline(prefix("text"))).alias("own")
    filed = test.select(F.col("side").alias("test_side"), F.xxhash64("text").alias("test_id"), F.inline(prefix("text"))).alias("filed")
    n, m = F.col("own.n"), F.col("filed.n")
    t = F.lit(float(threshold))
    enough = F.ceil(t / (t + 1) * (n + m) - _SLACK)
    still = 1 + F.least(n - F.col("own.pos"), m - F.col("filed.pos")) - 1
    same = (F.col("side") == F.col("test_side")) & (F.col("own.token") == F.col("filed.token"))
    met = own.join(filed, same & (n >= m * t) & (m >= n * t) & (still >= enough))
    return met.select("pair_id", "side", "test_id").distinct()


def shuffled_hits(pairs: DataFrame, test: DataFrame, threshold: float, limit: int) -> DataFrame:
    """(hit_id) of the pairs with a near side, for a test set of any size.

    test_id is a hash: texts that should share one are all compared.
    """
    candidates = cut_lineage(meetings(pairs, test, threshold))
    sets = test.select(F.col("side").alias("test_side"), F.xxhash64("text").alias("of_test"), word_set("text").alias("test_tokens"))
    fitting = candidates.join(sets, (F.col("side") == F.col("test_side")) & (F.col("test_id") == F.col("of_test"))).select(
        F.col("pair_id").alias("hit_id"), "side", "test_tokens")
    if fits_broadcast(fitting, limit):
        fitting = F.broadcast(fitting)
    judged = pairs.select("pair_id", "src", "tgt").join(fitting, F.col("pair_id") == F.col("hit_id"))
    tokens = word_set(F.when(F.col("side") == "src", F.col("src")).otherwise(F.col("tgt")))
    return judged.where(_similar(tokens, F.col("test_tokens"), threshold)).select("hit_id").distinct()


def _similar(a: Column, b: Column, threshold: float) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared) > F.lit(float(threshold))
