"""Character n-grams as small integers, computed for a whole Arrow column at a time.

A text is padded with one space on each side.  An n-gram of code points is
``(c1*31**(n-1) + ... + cn) mod 2**16``: one number below 65536, so any table or
matrix keyed by it has a size fixed before any data is read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# The helpers travel inside the task closure, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 65536
MULTIPLIER = 31
CHUNK_BYTES = 256 << 10  # a byte takes some 80 bytes of arrays on its way to counts and cosines


def text_chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of whole texts of about CHUNK_BYTES, to bound working memory."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    offsets = _offsets(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, side="right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield texts.slice(start, stop - start)
        start = stop


def _offsets(texts: pa.Array) -> np.ndarray:
    whole = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    return whole[texts.offset : texts.offset + len(texts) + 1]


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points modulo 2**16 of all texts laid end to end, and each text's length."""
    offsets = _offsets(texts)
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint16), np.zeros(len(texts), dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    starts = (raw & 0xC0) != 0x80
    chars_before = np.concatenate(([0], np.cumsum(starts)))
    lengths = np.diff(chars_before[offsets - offsets[0]])
    wide = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
    return wide.astype(np.uint16), lengths


def gram_ids(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-gram numbers, text after text, and how many each text has."""
    points, lengths = _code_points(texts)
    padded_lengths = lengths + 2
    padded = np.full(len(points) + 2 * len(lengths), ord(" "), dtype=np.uint16)
    shift = 2 * np.repeat(np.arange(len(lengths)), lengths) + 1
    padded[np.arange(len(points)) + shift] = points
    size = max(len(padded) - n + 1, 0)
    ids = np.zeros(size, dtype=np.uint16)
    for k in range(n):
        # Sixteen-bit arithmetic wraps around: that is the modulus.
        ids = ids * np.uint16(MULTIPLIER) + padded[k : k + size]
    inside = np.ones(size, dtype=bool)
    ends = np.cumsum(padded_lengths)
    for j in range(1, n):
        across = ends - j
        inside[across[(across >= 0) & (across < size)]] = False
    return ids[inside], np.maximum(padded_lengths - n + 1, 0)


def text_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Exact integer sum of the values of each text."""
    running = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    last = np.cumsum(counts)
    return running[last] - running[last - counts]


def folded_counts(texts: pa.Array, n: int, dimensions: int) -> np.ndarray:
    """Matrix of n-gram counts, one row per text, folded into ``dimensions`` columns."""
    ids, counts = gram_ids(texts, n)
    owner = np.repeat(np.arange(len(texts)), counts)
    cells = owner * dimensions + ids.astype(np.int64) % dimensions
    return np.bincount(cells, minlength=len(texts) * dimensions).reshape(len(texts), dimensions)


def cosines(src: pa.Array, tgt: pa.Array, n: int, dimensions: int) -> np.ndarray:
    """Cosine of the folded counts of each pair of texts; 0 where a text has no n-gram, NaN
    where one is missing."""
    pieces = [np.zeros(0)]
    start = 0
    for part in text_chunks(src):
        # The other side is cut again, so neither side of a piece is large.
        for right in text_chunks(tgt.slice(start, len(part))):
            left = src.slice(start, len(right)).cast(right.type)
            start += len(right)
            a = folded_counts(left, n, dimensions).astype(np.float64)
            b = folded_counts(right, n, dimensions).astype(np.float64)
            norm = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
            similarity = np.divide((a * b).sum(axis=1), norm, out=np.zeros(len(right)), where=norm > 0)
            similarity[np.asarray(left.is_null()) | np.asarray(right.is_null())] = np.nan
            pieces.append(similarity)
    return np.concatenate(pieces)
