"""Cosine similarity of two array columns, on the buffers of Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

GATHER = 1 << 22  # numbers that are copied at a time where rows do not lie side by side


def _matrix(values: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The vectors that begin at ``starts``, without a copy where they follow one another."""
    if len(starts) and (np.diff(starts) == width).all():
        return values[starts[0]:starts[0] + width * len(starts)].reshape(len(starts), width)
    return values[starts[:, None] + np.arange(width)]


def _numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(values as doubles, a null as nan; first place, length, and whether there are no nulls of each vector)."""
    values = vectors.values.cast(pa.float64())
    starts = np.asarray(vectors.offsets).astype(np.int64)
    nulls = np.concatenate([[0], np.cumsum(np.asarray(values.is_null()))])
    whole = (nulls[starts[1:]] == nulls[starts[:-1]]) & np.asarray(vectors.is_valid())
    return values.to_numpy(zero_copy_only=False), starts[:-1], np.diff(starts), whole


def cosines(a: pa.Array, b: pa.Array) -> pa.Array:
    """Row by row, in double precision; null for vectors that are null, hold a null, or differ in length."""
    (va, sa, na, wa), (vb, sb, nb, wb) = _numbers(a), _numbers(b)
    good = wa & wb & (na == nb)
    out = np.zeros(len(a))
    for width in np.unique(na[good]).tolist():
        rows = np.flatnonzero(good & (na == width))
        for part in np.array_split(rows, max(1, len(rows) * width // GATHER)):
            x, y = _matrix(va, sa[part], width), _matrix(vb, sb[part], width)
            norm = np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
            dot = np.einsum("ij,ij->i", x, y)
            out[part] = np.divide(dot, norm, out=np.zeros(len(part)), where=norm != 0)
    return pc.if_else(pa.array(good), pa.array(out), pa.scalar(None, pa.float64()))


def cosine(a: Column | str, b: Column | str) -> Column:
    """In double precision; a zero vector has similarity 0.  Null where a vector is null or holds a null,
    or where their lengths differ."""
    return F.arrow_udf(cosines, "double")(a, b)
