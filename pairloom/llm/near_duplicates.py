"""N-gram Jaccard self-join with Bayesian candidate pruning.

Documents whose sets of five-word shingles have a Jaccard similarity of at least ``THRESHOLD`` are
linked.  The steps:

1. Documents with the same words are one class; its members are never compared.
2. A class gets 128 MinHash values.  Four in a row form a band; classes that agree in a band meet
   in a bucket.  At the threshold a pair meets in none of the 32 bands once in 20 million.
3. In a bucket MinHash values are compared a few at a time.  With a uniform prior on the similarity
   the posterior probability that it reaches the threshold follows from the matches so far, and a
   pair is dropped as soon as it falls below ``TOLERANCE``.  The survivors connect classes to clusters.
4. In a cluster all pairs go through the same pruning and the rest are verified on whole shingle
   sets.  Links are counted and connected there, so that pairs never become rows.

Large buckets and clusters are split into blocks, and pairs of blocks are dealt to tasks.

A text of one to four words has one shingle, all its words.  Texts without words (null, empty)
are one class without further links.  Null ids and repeated rows are documents like any other.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.components import components
from pairloom.llm.shared import stored, text_key
from pairloom.llm.words import gram_hashes, word_hashes
from pairloom.operators.joins import fits_broadcast, lookup_join

SHINGLE = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
VALUES, ROWS = 128, 4
BANDS = VALUES // ROWS
STEPS = (8, 16, 32, 64, 128)
# Rows compared at once.  Up to MANY blocks are that small; larger groups have larger blocks, since
# every row is sent once per block of its group.
BUCKET_BLOCK, CLUSTER_BLOCK = 1024, 256
MANY, BLOCK_ROWS, BLOCK_BYTES = 16, 8192, 32 << 20

_MULTIPLIERS = np.random.default_rng(5).integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The set of shingle hashes, sorted."""
    words = word_hashes(text)
    return np.unique(gram_hashes(words, min(size, len(words)) or 1))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The lowest of each of 128 permuted hash orders, folded to 16 bits."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        np.minimum(low, (hashes[None, at:at + 1024] * _MULTIPLIERS[:, None]).min(axis=1), out=low)
    return (low * _FOLD >> np.uint64(48)).astype("<u2")


@functools.lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """After n values compared: the fewest matches with which a pair goes on.

    With a uniform prior the posterior after m of n is Beta(m + 1, n - m + 1), and its mass
    above t is the chance of at most m successes in n + 1 trials of probability t.
    """
    table = {}
    for n in STEPS:
        mass = 0.0
        for m in range(n + 1):
            mass += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if mass >= tolerance:
                table[n] = m
                break
    return table


def surviving(left: np.ndarray, right: np.ndarray, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into ``left`` and ``right`` signatures) that incremental comparison keeps."""
    least = least_matches(threshold, tolerance)
    matches = np.zeros((len(left), len(right)), np.uint8)
    for v in range(STEPS[0]):
        matches += left[:, v, None] == right[None, :, v]
    i, j = np.nonzero(matches >= least[STEPS[0]])
    count, done = matches[i, j].astype(np.int64), STEPS[0]
    for n in STEPS[1:]:
        for at in range(0, len(i), 1 << 16):
            cut = slice(at, at + (1 << 16))
            count[cut] += (left[i[cut], done:n] == right[j[cut], done:n]).sum(axis=1)
        good = count >= least[n]
        i, j, count, done = i[good], j[good], count[good], n
    return i, j


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Connect all pairs: every row first to its first partner, then what still differs."""
        while len(i):
            first = np.unique(i, return_index=True)[1]
            for x, y in zip(i[first].tolist(), j[first].tolist(), strict=True):
                self.join(x, y)
            nodes = np.unique(np.concatenate([i, j]))
            roots = np.array([self.root(x) for x in nodes.tolist()])
            apart = roots[np.searchsorted(nodes, i)] != roots[np.searchsorted(nodes, j)]
            i, j = i[apart], j[apart]


def groups_of(parts: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal leading columns, from a sorted stream."""
    key, rows = None, []
    for batch in parts:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


def _side_blocks(rows: list[tuple], low: int, high: int) -> tuple[list[int], list[int]]:
    """Positions of the rows of block ``low`` and of block ``high``; the block is column 0."""
    a = [k for k, r in enumerate(rows) if r[0] == low]
    return (a, a) if low == high else (a, [k for k, r in enumerate(rows) if r[0] == high])


def tiles(a: list[int], b: list[int], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of two sides such that every pair meets in one; a side with itself in one order only."""
    for x in range(0, len(a), size):
        for y in range(x if a is b else 0, len(b), size):
            yield np.array(a[x:x + size], np.int64), np.array(b[y:y + size], np.int64)


def block_count(size: Column, size_bytes: Column, block_size: int) -> Column:
    """In how many blocks a group of ``size`` members goes."""
    small = F.least(F.ceil(size / block_size), F.lit(MANY))
    return F.least(size, F.greatest(small, F.ceil(size / BLOCK_ROWS), F.ceil(size_bytes / BLOCK_BYTES), F.lit(1))).cast("int")


def in_block_pairs(members: DataFrame, key: str, blocks: Column, node: str, carry: list[str]) -> DataFrame:
    """Rows (key, low, high, block, node, *carry), sorted, such that every two members of a key
    meet in exactly one (key, low, high).  ``blocks`` is the number of blocks of the key."""
    block = F.pmod(F.xxhash64(node), blocks).cast("int")
    at = members.withColumn("_blocks", blocks).withColumn("block", block)
    meets = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    at = at.select("*", meets.alias("_other")).withColumns({
        "low": F.least("block", "_other"), "high": F.greatest("block", "_other")})
    return at.select(key, "low", "high", "block", node, *carry).repartition(key, "low", "high").sortWithinPartitions(
        key, "low", "high", node)


def _signed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per document: id, text key, key of its words, number of shingles, signature."""
    own = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("text_key"),
                      F.col(f"`{text}`").cast("binary").alias("_text"))

    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            known: dict[str, tuple] = {}
            keys, signs = [], []
            for key, value in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if key not in known:
                    words = word_hashes(value.as_py())
                    hashes = np.unique(gram_hashes(words, min(SHINGLE, len(words)) or 1))
                    known[key] = (hashlib.md5(words.tobytes(), usedforsecurity=False).digest(),
                                  signature(hashes).tobytes() if len(hashes) else None)
                word_key, sign_ = known[key]
                keys.append(word_key)
                signs.append(sign_)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
                ["doc_id", "text_key", "word_key", "sign"])

    return own.mapInArrow(sign, "doc_id bigint, text_key string, word_key binary, sign binary")


def candidate_edges(classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Edges (a, b) that connect all classes which meet in a bucket and survive the pruning."""
    slices = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring(F.col("sign"), b * 2 * ROWS + 1, F.lit(2 * ROWS))))
    banded = classes.where("sign IS NOT NULL").select("class_no", F.explode(slices).alias("bucket"))
    sizes = banded.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("class_no").cast("decimal(20,0)")).alias("who")).where("n > 1")
    # Buckets with the same members are one bucket.
    sizes = stored(sizes.groupBy("n", "who").agg(F.min("bucket").alias("bucket")).select("bucket", "n"))
    members = stored(banded.join(sizes, "bucket"))
    members = members.join(classes.select("class_no", "sign"), "class_no")
    blocks = in_block_pairs(members, "bucket", block_count(F.col("n"), F.col("n") * 2 * VALUES, BUCKET_BLOCK), "class_no", ["sign"])

    def connect(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []
        for (_, low, high), rows in groups_of(parts, 3):
            a, b = _side_blocks(rows, low, high)
            signs = np.frombuffer(b"".join(r[2] for r in rows), "<u2").reshape(-1, VALUES)
            forest = Forest(len(rows))
            for x, y in tiles(a, b, BUCKET_BLOCK):
                i, j = surviving(signs[x], signs[y], threshold, tolerance)
                i, j = x[i], y[j]
                forest.add(i[i != j], j[i != j])
            for x in range(len(rows)):
                root = forest.root(x)
                if root != x:
                    out_a.append(rows[x][1])
                    out_b.append(rows[root][1])
            if len(out_a) > 50_000:
                yield edge_batch(out_a, out_b)
                out_a, out_b = [], []
        if out_a:
            yield edge_batch(out_a, out_b)

    def edge_batch(a: list[int], b: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return blocks.mapInArrow(connect, "a bigint, b bigint")


def _intersections(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets left[i] and right[j]."""
    if len(i) <= 64:
        return np.array([len(np.intersect1d(left[x], right[y], assume_unique=True))
                         for x, y in zip(i, j, strict=True)], np.int64)
    rows, cols = np.unique(i), np.unique(j)
    a, b = [left[k] for k in rows], [right[k] for k in cols]
    common = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)), assume_unique=True)
    total = np.zeros((len(rows), len(cols)), np.float32)
    for at in range(0, len(common), 4096):
        part = common[at:at + 4096]
        dense = []
        for side in (a, b):
            m = np.zeros((len(side), len(part)), np.float32)
            for k, s in enumerate(side):
                s = s[np.searchsorted(s, part[0]):np.searchsorted(s, part[-1], "right")]
                where = np.searchsorted(part, s)
                m[k, where[part[where] == s]] = 1
            dense.append(m)
        total += dense[0] @ dense[1].T
    return total[np.searchsorted(rows, i), np.searchsorted(cols, j)].astype(np.int64)


def verified_links(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Per class and pair of blocks: the documents linked to it, and a class it is connected with.

    ``members`` has cluster, n, n_bytes (of the cluster's sets, about), class_no, copies, sign and
    shingles (sorted 64-bit hashes).
    """
    blocks = in_block_pairs(members, "cluster", block_count(F.col("n"), F.col("n_bytes"), CLUSTER_BLOCK), "class_no",
                            ["copies", "sign", "shingles"])

    def verify(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), rows in groups_of(parts, 3):
            rows = [r for k, r in enumerate(rows) if not k or r[1] != rows[k - 1][1]]  # a repeated row counts once
            a, b = _side_blocks(rows, low, high)
            signs = np.frombuffer(b"".join(r[3] for r in rows), "<u2").reshape(-1, VALUES)
            sets = [np.frombuffer(r[4], "<u8") for r in rows]
            sizes = np.array([len(s) for s in sets])
            copies = np.array([r[2] for r in rows], np.int64)
            links = np.zeros(len(rows), np.int64)
            forest = Forest(len(rows))
            for x, y in tiles(a, b, CLUSTER_BLOCK):
                i, j = surviving(signs[x], signs[y], threshold, tolerance)
                if low == high:
                    once = x[i] < y[j]
                    i, j = i[once], j[once]
                inter = _intersections([sets[k] for k in x], [sets[k] for k in y], i, j)
                i, j = x[i], y[j]
                good = inter / (sizes[i] + sizes[j] - inter) >= threshold
                i, j = i[good], j[good]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                forest.add(i, j)
            hit = np.flatnonzero(links).tolist()
            if hit:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[x][1] for x in hit], pa.int64()), pa.array(links[hit], pa.int64()),
                     pa.array([rows[forest.root(x)][1] for x in hit], pa.int64())], ["class_no", "links", "other"])

    return blocks.mapInArrow(verify, "class_no bigint, links bigint, other bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, text_key, class_id, n_links, n_copies, representative.

    Documents linked directly or through others share ``class_id``, the smallest doc_id among
    them.  ``n_links`` counts the other documents with the same words or a similarity that reaches
    the threshold; ``n_copies`` those with the same words, itself included.  Exactly one row of
    every class_id is the ``representative``, one with that smallest id; null ids come last.
    """
    signed = stored(_signed(docs, doc_id, text).withColumn("row_no", F.monotonically_increasing_id()))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_no")
    classes = signed.groupBy("word_key").agg(
        F.count("*").alias("copies"), F.first("sign").alias("sign"), F.min(order).alias("rep"),
        F.min_by("text_key", order).alias("text_key"))
    classes = stored(classes.withColumn("class_no", F.monotonically_increasing_id()))
    clusters = components(candidate_edges(classes, threshold, tolerance))
    nodes = clusters.select(F.col("node").alias("class_no"), F.col("label").alias("cluster"))
    # A set takes about 1.4 bytes a byte of text, at most four.
    n_bytes = 2 * F.substring_index("text_key", ":", -1).cast("bigint")
    sizes = nodes.join(classes.select("class_no", n_bytes.alias("n_bytes")), "class_no").groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum("n_bytes").alias("n_bytes"))
    wanted = stored(nodes.join(sizes, "cluster").join(
        classes.select("class_no", "copies", "sign", "text_key", F.col("rep.doc_id").alias("rep_id")), "class_no"))

    @F.arrow_udf("binary")
    def shingle_column(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([shingles(t.as_py()).astype("<u8").tobytes() for t in batch], pa.binary())

    # The row number deals copies of one text to all salts; of them only the representative's row goes on.
    own = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("text_key"),
                      F.col(f"`{text}`").cast("binary").alias("_text"), F.monotonically_increasing_id().alias("_row"))
    members = lookup_join(own, wanted, "text_key", "text_key", "inner").where(F.col("doc_id").eqNullSafe(F.col("rep_id")))
    members = members.drop("_row", "doc_id", "rep_id").dropDuplicates(["class_no"]).withColumn(
        "shingles", shingle_column("_text")).drop("_text")
    found = stored(verified_links(members, threshold, tolerance))
    linked = found.groupBy("class_no").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("class_no").alias("a"), F.col("other").alias("b")))
    # The class of the smallest document stands for the whole component.
    rank = classes.select("class_no", "rep", "copies", "word_key").join(linked, "class_no", "left").join(
        joined.select(F.col("node").alias("class_no"), F.col("label")), "class_no", "left")
    rank = rank.withColumn("label", F.coalesce("label", "class_no"))
    heads = rank.groupBy("label").agg(F.min("rep").alias("head"))
    rank = stored(rank.join(heads, "label").select("word_key", "head", "copies", F.coalesce("links", F.lit(0)).alias("links")))
    return lookup_join(signed.drop("sign"), rank, "word_key", "word_key", "inner").select(
        "doc_id", "text_key", F.col("head.doc_id").alias("class_id"),
        (F.col("copies") - 1 + F.col("links")).alias("n_links"), F.col("copies").alias("n_copies"),
        (F.col("row_no") == F.col("head.row_no")).alias("representative"))


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every class left; all columns stay."""
    judged = stored(near_duplicates(docs, doc_id, text))
    kept = judged.where("representative").select(F.struct("doc_id", "text_key").alias("__llm_key"))
    repeated = judged.groupBy(F.struct("doc_id", "text_key").alias("__llm_key")).count().where("count > 1").select("__llm_key")
    repeated = stored(repeated.join(kept, "__llm_key", "left_semi"))
    keyed = docs.withColumn("__llm_key", F.struct(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                                             text_key(F.col(f"`{text}`")).alias("text_key")))
    # Up to the size of a broadcast the texts stay where they are; beyond it they are shuffled once, by unique keys.
    ids = F.broadcast(kept) if fits_broadcast(kept) else kept
    left = keyed.join(ids, keyed["__llm_key"].eqNullSafe(kept["__llm_key"]), "left_semi")
    if repeated.isEmpty():
        return left.drop("__llm_key")
    # Rows that are equal in id and text: one of them stays.
    once = left.join(repeated, left["__llm_key"].eqNullSafe(repeated["__llm_key"]), "left_anti")
    some = left.join(repeated, left["__llm_key"].eqNullSafe(repeated["__llm_key"]), "left_semi").dropDuplicates(["__llm_key"])
    return once.unionByName(some).drop("__llm_key")
