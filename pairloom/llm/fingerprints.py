"""Quartile bucket digests of documents, and how alike two digests are.

The bytes of a text are read through a window of five; six byte triplets of each window are
hashed into 128 buckets.  The digest holds, for every bucket, the quartile its count lies in
(two bits), and in front the log length and the two quartile ratios: 70 hex digits.  The
difference of two digests adds the distances of the three header fields and of all buckets, and
is bounded by ``MAX_DIFFERENCE``; likeness is 1 minus its share of that bound.

Null texts count as empty.  Texts under five bytes have no triplets: their bytes are hashed into
the buckets one by one, so that equal texts still have equal digests and different short texts
mostly differ.  A text of any length is read in pieces of bounded size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pairloom.llm.shared import parts_for, stored

BUCKETS = 128
MAX_DIFFERENCE = 300
PIECE = 1 << 20
WINDOW = 5
# Offsets inside the window of the second and third byte of each triplet; the first is 0.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4), (1, 4), (3, 4))
MIX = np.uint32(0x9E3779B1)

# Difference of two quartile codes: one apart 1, two apart 2, opposite ends 6.
CODE_DISTANCE = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]])


def bucket_counts(data: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    if len(data) < WINDOW:
        for place, byte in enumerate(data):
            counts[(byte * 31 + place * 7 + len(data)) % BUCKETS] += 1
        return counts
    for at in range(0, len(data) - WINDOW + 1, PIECE):
        b = np.frombuffer(data, np.uint8, min(PIECE + WINDOW - 1, len(data) - at), at).astype(np.uint32)
        n = len(b) - WINDOW + 1
        first = b[:n] << np.uint32(16)
        shifted = b << np.uint32(8)
        for salt, (i, j) in enumerate(TRIPLETS):
            h = (first | shifted[i:i + n] | b[j:j + n]) + np.uint32(salt << 24)
            h *= MIX
            h ^= h >> np.uint32(15)
            h *= MIX
            h >>= np.uint32(25)
            counts += np.bincount(h, minlength=BUCKETS)
    return counts


def digest(data: bytes) -> str:
    counts = bucket_counts(data)
    ordered = np.sort(counts)
    q1, q2, q3 = (int(ordered[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    length = min(255, round(8 * math.log2(1 + len(data))))
    ratios = [min(15, 16 * q // (q3 + 1)) for q in (q1, q2)]
    packed = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    return f"{length:02x}{ratios[0]:x}{ratios[1]:x}00" + packed.astype(np.uint8).tobytes().hex()


def _codes(fingerprint: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(fingerprint[6:]), np.uint8)
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()


def difference(a: str, b: str) -> int:
    head = abs(int(a[:2], 16) - int(b[:2], 16)) + sum(abs(int(a[i], 16) - int(b[i], 16)) for i in (2, 3))
    return min(MAX_DIFFERENCE, head + int(CODE_DISTANCE[_codes(a), _codes(b)].sum()))


def likeness(a: str, b: str) -> float:
    return 1.0 if a == b else 1 - difference(a, b) / MAX_DIFFERENCE


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first code points of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_texts(docs: DataFrame, text: str, out: str = "fingerprint") -> DataFrame:
    """``docs`` with the digest of each text."""
    @F.pandas_udf("string")
    def digests(texts):
        return texts.map(lambda t: digest((t or "").encode()))

    return docs.withColumn(out, digests(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


RESULT = (("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
          ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()))
RESULT_DDL = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
# Rows at the ends of a range, which wait for their neighbour: its first and its last text.
FIRST, LAST = 1, 2


def compared(ident: int | None, own: str, own_print: str, following: str, following_print: str) -> tuple:
    """The result row of a text and the text after it."""
    changed = edited(own, following).encode()
    changed_print = digest(changed)
    return (ident, len(own), hashlib.sha256(changed).hexdigest(), own_print, changed_print,
            likeness(own_print, changed_print), likeness(own_print, following_print))


def _batch(rows: list[tuple], types: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], [n for n, _ in types])


def in_ranges(docs: DataFrame, doc_id: str, text: str, ranges: int | None = None) -> DataFrame:
    """Rows (doc_id, tie, row, text) in the order of the next document, in as many sorted partitions as their
    bytes ask for: doc_id descending, null ids last, equal ids by a hash of the text.

    Rows equal in both are told apart by a row number, so neither null nor repeated ids fill one partition.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ranges = ranges or parts_for(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0, 4 << 20)
    order = [F.desc_nulls_last("doc_id"), F.desc("tie"), F.asc("row")]
    return rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)


def compare_with_following(docs: DataFrame, doc_id: str, text: str, ranges: int | None = None) -> DataFrame:
    """Per document: its digest, that of its text edited with the next document, and likenesses.

    The next document is the one of the next smaller doc_id; after the last comes the first.
    A lone document follows itself.  Null ids come last, equal ids are ordered by a hash of the text.

    Texts cross the network once, into ranges.  A range compares its neighbouring rows and passes on
    its first and last text; the last of each is then compared with the first of the next range.
    """
    types = (*RESULT, ("end", pa.int32()), ("part", pa.int32()), ("own", pa.string()))

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None  # the row waiting for its successor
        for batch in parts:
            out = []
            for ident, value in zip(batch.column(0), batch.column(3), strict=True):
                ident, value = ident.as_py(), value.as_py()
                print_ = digest(value.encode())
                if before is None:
                    out.append((ident, None, None, print_, None, None, None, FIRST, part, value))
                else:
                    out.append((*compared(*before, value, print_), 0, part, None))
                before = ident, value, print_
            if out:
                yield _batch(out, types)
        if before is not None:
            ident, value, print_ = before
            yield _batch([(ident, None, None, print_, None, None, None, LAST, part, value)], types)

    def close(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for at in range(0, batch.num_rows, 8):
                rows = zip(*(c.to_pylist() for c in batch.slice(at, 8).columns), strict=True)
                yield _batch([compared(*row) for row in rows], RESULT)

    done = stored(in_ranges(docs, doc_id, text, ranges).select("doc_id", "tie", "row", "text").mapInArrow(
        compare, RESULT_DDL + ", end int, part int, own string"))
    firsts = done.where(F.col("end") == FIRST).select("part", F.col("own").alias("next"), F.col("fingerprint").alias("next_print"))
    # One number per range that has rows, so the window is as long as the list of ranges.
    after = firsts.select("part").withColumns({
        "after": F.lead("part").over(Window.orderBy("part")), "start": F.min("part").over(Window.partitionBy(F.lit(0)))})
    after = after.select("part", F.coalesce("after", "start").alias("after"))
    lasts = done.where(F.col("end") == LAST).select("part", "doc_id", "own", "fingerprint").join(after, "part")
    ends = lasts.join(firsts.withColumnRenamed("part", "after"), "after").select("doc_id", "own", "fingerprint", "next", "next_print")
    return done.where(F.col("end") == 0).select(*[n for n, _ in RESULT]).unionByName(ends.mapInArrow(close, RESULT_DDL))
