"""Stupid-backoff scores of documents under the n-gram counts of the whole corpus.

The score of a word given the words before it is

    S(w | c) = count(c w) / count(c)          if count(c w) >= MIN_COUNT
             = BACKOFF * S(w | shorter c)     otherwise,     S(w) = count(w) / corpus words

where count(c) is the count of the n-gram c, and a document gets the sum of log10 S over its words.
``MIN_COUNT`` is 2: an n-gram seen once is seen in that very text and says nothing about it.

Each document's words go into a block of bounded size, with its distinct n-grams.  Blocks are
stored.  Each block asks for the counts of its distinct n-grams: a row per block and hash bucket
carries their hashes and how often they occur in the block.  A bucket adds up one part of the count
table and answers every block.  A frequent n-gram is asked for once per block, however many
documents it occurs in, so no key is hot.  The answers join the blocks again, where every position
looks up its n-grams and the logs are summed per document.

Null and empty texts have no words and the score 0.  A document of any length is one block at
least; repeated rows count each.  All n-grams stay inside a document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.shared import stored_by_key
from pairloom.llm.words import gram_hashes, word_hashes

ORDER, MIN_COUNT, BACKOFF = 3, 2, 0.4
BLOCK_WORDS = 1_500_000
BUCKET_GRAMS = 2_000_000  # n-grams asked for in one bucket


def pack(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, so that sorted or small ones compress well."""
    return zlib.compress(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes(), 1)


def unpack(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def _blocks(docs: DataFrame, doc_id: str, text: str, block_words: int) -> DataFrame:
    """Blocks of documents: ids, numbers of words, the vocabulary and the words as places in it."""
    own = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, size = [], [], 0
        for batch in parts:
            for ident, value in zip(*batch.columns, strict=True):
                hashes = word_hashes(value.as_py())
                ids.append(ident.as_py())
                words.append(hashes)
                size += len(hashes)
                if size >= block_words:
                    yield block(ids, words, size)
                    ids, words, size = [], [], 0
        if ids:
            yield block(ids, words, size)

    def block(ids: list, words: list[np.ndarray], size: int) -> pa.RecordBatch:
        vocabulary, place = np.unique(np.concatenate(words), return_inverse=True)
        return pa.RecordBatch.from_arrays([
            pa.array([ids], pa.list_(pa.int64())), pa.array([[len(w) for w in words]], pa.list_(pa.int64())),
            pa.array([pack_sorted(vocabulary)], pa.binary()), pa.array([pack(place.astype("<u4"))], pa.binary()),
            pa.array([size], pa.int64())], ["ids", "lengths", "vocabulary", "places", "words"])

    return own.mapInArrow(cut, "ids array<bigint>, lengths array<bigint>, vocabulary binary, places binary, words bigint")


class Block:
    """The n-grams of a block: for each order their hashes by position, and whether one ends there."""

    def __init__(self, lengths: list[int], vocabulary: bytes, places: bytes) -> None:
        self.lengths = np.asarray(lengths, np.int64)
        words = unpack_sorted(vocabulary)[unpack(places, "<u4")]
        self.words = words
        ends = np.cumsum(self.lengths)
        starts = np.repeat(ends - self.lengths, self.lengths)
        self.depth = np.arange(len(words)) - starts  # words before a position in its document

    def ending(self, n: int) -> np.ndarray:
        """Hash of the n-gram that ends at each position; 0 where the document has none."""
        out = np.zeros(len(self.words), np.uint64)
        if len(self.words) >= n:
            out[n - 1:] = gram_hashes(self.words, n)
        out[self.depth < n - 1] = 0
        return out

    def distinct(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct n-grams, their counts, and per position the place among them (-1: none)."""
        grams = self.ending(n)
        there = self.depth >= n - 1
        values, place, counts = np.unique(grams[there], return_inverse=True, return_counts=True)
        places = np.full(len(grams), -1, np.int64)
        places[there] = place
        return values, counts, places


def bucket_cuts(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where sorted hashes pass from one of ``buckets`` equal ranges to the next."""
    step = (1 << 64) // buckets
    return np.searchsorted(values, np.array([i * step for i in range(buckets)], np.uint64)).tolist() + [len(values)]


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER,
                    min_count: int = MIN_COUNT, backoff: float = BACKOFF, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, log10_score (sum over its words), n_backed_off.

    ``n_backed_off`` counts the words whose longest available n-gram was too rare.
    """
    # Laid out by block_no, so that the answers come to the blocks and no block is shuffled.
    blocks = stored_by_key(_blocks(docs, doc_id, text, block_words).withColumn(
        "block_no", F.monotonically_increasing_id()), "block_no")
    total = blocks.agg(F.sum("words")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_GRAMS))

    def ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                block = Block(row["lengths"], row["vocabulary"], row["places"])
                for n in range(1, order + 1):
                    values, counts, _ = block.distinct(n)
                    cuts = bucket_cuts(values, buckets)
                    for k in range(buckets):
                        low, high = cuts[k], cuts[k + 1]
                        if low < high:
                            yield pa.RecordBatch.from_arrays([
                                pa.array([n * buckets + k], pa.int64()), pa.array([row["block_no"]], pa.int64()),
                                pa.array([pack_sorted(values[low:high])], pa.binary()),
                                pa.array([pack(counts[low:high].astype("<u4"))], pa.binary()),
                            ], ["bucket", "block_no", "grams", "counts"])

    def answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        asked = [unpack_sorted(g) for g in rows["grams"]]
        counts = np.concatenate([unpack(c, "<u4") for c in rows["counts"]]).astype(np.int64)
        values, place = np.unique(np.concatenate(asked), return_inverse=True)
        sums = np.zeros(len(values), np.int64)
        np.add.at(sums, place, counts)
        ends = np.cumsum([len(a) for a in asked])
        answers = [pack(sums[place[e - len(a):e]].astype("<u8")) for a, e in zip(asked, ends, strict=True)]
        return pd.DataFrame({"block_no": rows["block_no"], "bucket": int(key[0]), "sums": answers})

    asked = blocks.mapInArrow(ask, "bucket bigint, block_no bigint, grams binary, counts binary")
    answers = asked.groupBy("bucket").applyInPandas(answer, "block_no bigint, bucket bigint, sums binary")
    by_block = answers.groupBy("block_no").agg(F.array_sort(F.collect_list(F.struct("bucket", "sums"))).alias("answers"))
    answered = blocks.join(by_block, "block_no", "left").select("ids", "lengths", "vocabulary", "places", "answers")

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                block = Block(row["lengths"], row["vocabulary"], row["places"])
                sums = {n: np.zeros(0, np.int64) for n in range(1, order + 1)}
                for a in row["answers"] or ():
                    n = a["bucket"] // buckets
                    sums[n] = np.concatenate([sums[n], unpack(a["sums"], "<u8").astype(np.int64)])
                logs, backed = block_logs(block, sums, total, order, min_count, backoff)
                edges = np.concatenate([[0], np.cumsum(block.lengths)])
                run, runs = np.concatenate([[0.0], np.cumsum(logs)]), np.concatenate([[0], np.cumsum(backed)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["ids"], pa.int64()), pa.array(block.lengths, pa.int64()),
                    pa.array(run[edges[1:]] - run[edges[:-1]], pa.float64()),
                    pa.array(runs[edges[1:]] - runs[edges[:-1]], pa.int64())],
                    ["doc_id", "n_words", "log10_score", "n_backed_off"])

    return answered.mapInArrow(score, "doc_id bigint, n_words bigint, log10_score double, n_backed_off bigint")


def block_logs(block: Block, sums: dict[int, np.ndarray], total: int, order: int, min_count: int,
               backoff: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the score at every position, and 1 where its longest n-gram was too rare."""
    size = len(block.words)
    counts = {}
    for n in range(1, order + 1):
        _, _, place = block.distinct(n)
        counts[n] = np.where(place >= 0, sums[n][place] if len(sums[n]) else 0, 0)
    logs, open_, penalty, backed = np.zeros(size), np.ones(size, np.bool_), np.zeros(size), np.zeros(size, np.int64)
    for n in range(order, 1, -1):
        there = open_ & (block.depth >= n - 1)
        good = there & (counts[n] >= min_count)
        context = np.zeros(size, np.int64)
        context[1:] = counts[n - 1][:-1]
        logs[good] = penalty[good] + np.log10(counts[n][good] / context[good])
        rare = there & ~good
        penalty[rare] += np.log10(backoff)
        backed |= rare
        open_ &= ~good
    logs[open_] = penalty[open_] + np.log10(counts[1][open_] / max(total, 1))
    return logs, backed
