"""64-bit hashes of the words of a text, for whole texts at a time."""

from __future__ import annotations

import numpy as np

from pairloom.llm.shared import WORD_BYTES

PIECE = 1 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MUL
    h = (h ^ (h >> np.uint64(29))) * _MUL
    return h ^ (h >> np.uint64(32))


def _piece_hashes(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(b) + 2, np.bool_)
    np.not_equal(b, 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _power_tables(len(b) + 1)
    prefix = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * power[:len(b)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * inverse[starts])


def word_hashes(text: bytes | None) -> np.ndarray:
    """One hash per word (digits, letters, anything beyond ASCII; A-Z lower-cased), in order."""
    data = (text or b"").lower().translate(WORD_BYTES)
    if len(data) <= PIECE:
        return _piece_hashes(data) if data else np.empty(0, np.uint64)
    parts, at = [], 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        parts.append(_piece_hashes(data[at:end]))
        at = end
    return np.concatenate(parts)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One hash per run of ``n`` words; the first word counts most, so order matters."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    size = len(words) - n + 1
    h = words[:size].copy()
    for i in range(1, n):
        h *= _MUL
        h += words[i:i + size]
    return mix(h + np.uint64(n))
