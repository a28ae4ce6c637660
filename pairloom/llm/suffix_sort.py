"""Induced sorting of a shard's suffixes, to a bounded depth, with common-prefix values.

The symbols of a shard are bytes plus one, and 0 ends a region.  A suffix is of type L or S
(larger or smaller than its successor); an S after an L starts a *sample*.

1. Samples are named by their symbols and types up to the next sample, and names of neighbouring
   samples are named again and again in pairs, each level covering twice as much, until names
   stand for ``depth`` symbols or no name splits any more.
2. From the sorted samples, larger suffixes are induced in ascending and smaller ones in
   descending order.  A suffix taken from the queue puts its predecessor into the queue under that
   one's first symbol.  A tuple carries the position and the common prefix with the tuple before it
   in its queue: one more than the least common prefix between the two that put them there.

Queues keep tuples in order of arrival, which is their order, and spill to disk beyond
``QUEUE_BYTES``; names of more than ``SORT_ROWS`` samples are sorted from files by key range.
So a shard may be larger than what its queues and sorts hold in memory.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict
from pathlib import Path

import numpy as np

QUEUE_BYTES = 64 << 20
SORT_ROWS = 4_000_000
CHUNK = 1 << 16
SYMBOLS = 257


class DiskQueues:
    """One queue of (position, common prefix) per first symbol."""

    def __init__(self, folder: str, limit: int) -> None:
        self.folder, self.limit, self.size = Path(folder), limit, 0
        self.parts: dict[int, list[np.ndarray]] = defaultdict(list)
        self.spilled: set[int] = set()

    def put(self, key: int, tuples: np.ndarray) -> None:
        self.parts[key].append(tuples)
        self.size += tuples.nbytes
        if self.size > self.limit:
            for k, parts in self.parts.items():
                with (self.folder / f"queue-{k}").open("ab") as f:
                    for p in parts:
                        f.write(p.tobytes())
                self.spilled.add(k)
            self.parts.clear()
            self.size = 0

    def take(self, key: int) -> np.ndarray | None:
        """All tuples that are waiting under ``key``, shape (n, 2)."""
        parts = []
        if key in self.spilled:
            path = self.folder / f"queue-{key}"
            parts.append(np.fromfile(path, np.int64).reshape(-1, 2))
            path.unlink()
            self.spilled.discard(key)
        waiting = self.parts.pop(key, [])
        self.size -= sum(p.nbytes for p in waiting)
        parts += waiting
        return np.concatenate(parts) if parts else None


def ranks(keys: np.ndarray, folder: str, rows: int | None = None) -> tuple[np.ndarray, int]:
    """Dense ranks of ``keys`` and how many there are, sorted by key range from files where many."""
    rows = rows or SORT_ROWS
    if len(keys) <= rows:
        values, place = np.unique(keys, return_inverse=True)
        return place.astype(np.int64), len(values)
    sample = np.sort(keys[::max(1, len(keys) // 4096)])
    cuts = np.unique(sample[:: max(1, len(sample) * rows // (2 * len(keys)))])
    files = [Path(folder) / f"range-{i}" for i in range(len(cuts) + 1)]
    for at in range(0, len(keys), rows):
        part = keys[at:at + rows]
        home = np.searchsorted(cuts, part, "right")
        for i in np.unique(home):
            here = np.flatnonzero(home == i)
            with files[i].open("ab") as f:
                f.write(np.stack([part[here].astype(np.uint64), (here + at).astype(np.uint64)], axis=1).tobytes())
    out, count = np.empty(len(keys), np.int64), 0
    for path in files:
        if path.exists():
            pairs = np.fromfile(path, np.uint64).reshape(-1, 2)
            path.unlink()
            values, place = np.unique(pairs[:, 0], return_inverse=True)
            out[pairs[:, 1].astype(np.int64)] = place + count
            count += len(values)
    return out, count


class Shard:
    def __init__(self, regions: list[bytes], depth: int, folder: str) -> None:
        self.depth, self.folder = depth, folder
        size = sum(len(r) + 1 for r in regions)
        # Four symbols more, so that words of four can be read anywhere.
        self.text = np.zeros(size + 4, np.uint16)
        self.starts = np.zeros(len(regions), np.int64)
        at = 0
        for k, r in enumerate(regions):
            self.starts[k] = at
            self.text[at:at + len(r)] = np.frombuffer(r, np.uint8)
            self.text[at:at + len(r)] += 1
            at += len(r) + 1
        self.n = size
        self.words = np.ndarray((size,), "<u8", self.text, strides=(2,))
        self.smaller = self._types()
        self.repeated = np.zeros(size, np.bool_)

    def _types(self) -> np.ndarray:
        """True where a suffix is smaller than its successor; a run of equal symbols at the end counts as smaller."""
        now, after = self.text[:self.n - 1], self.text[1:self.n]
        differ = np.where(now != after, np.arange(self.n - 1, dtype=np.int64), self.n - 1)
        differ = np.minimum.accumulate(differ[::-1])[::-1]
        return np.append(np.append(now < after, True)[differ], True)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at ``a`` and ``b``, up to ``depth``."""
        out = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        at = 0
        while at < self.depth and len(open_):
            x, y = a[open_] + at, b[open_] + at
            inside = (x < self.n) & (y < self.n)
            open_, x, y = open_[inside], x[inside], y[inside]
            apart = self.words[x] ^ self.words[y]
            same = sum(((apart & np.uint64((1 << 16 * k) - 1)) == 0).astype(np.int64) for k in (1, 2, 3)) + (apart == 0)
            out[open_] += same
            open_ = open_[same == 4]
            at += 4
        return np.minimum(out, self.depth)

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the samples in the order of their suffixes, and common prefixes with the one before."""
        at = 1 + np.flatnonzero(self.smaller[1:] & ~self.smaller[:-1])
        m = len(at)
        if not m:
            return at, at
        symbol = self.text[:self.n].astype(np.uint64) * np.uint64(2) + self.smaller + np.uint64(1)
        length = np.append(np.diff(at) + 1, self.n - at[-1])
        name, count = np.zeros(m, np.int64), 1
        for first in range(0, int(length.max()), 6):
            word = np.zeros(m, np.uint64)
            live = np.flatnonzero(length > first)
            for k in range(first, first + 6):
                inside = live[length[live] > k]
                word[inside] |= symbol[at[inside] + k] << np.uint64(10 * (5 - (k - first)))
            word, words = ranks(word, self.folder)
            if not first:
                name, count = word, words
                continue
            name, count = ranks(name.astype(np.uint64) * np.uint64(words) + word.astype(np.uint64), self.folder)
        step = 1
        reach = np.append(at, [self.n])
        while count < m and (reach[np.minimum(np.arange(m) + step, m)] - at)[:max(1, m - step)].min() < self.depth:
            following = np.zeros(m, np.uint64)
            following[:max(0, m - step)] = name[step:].astype(np.uint64) + np.uint64(1)
            name, now = ranks(name.astype(np.uint64) * np.uint64(count + 1) + following, self.folder)
            step *= 2
            if now == count:
                break
            count = now
        order = np.argsort(name, kind="stable")
        at, name = at[order], name[order]
        lcp = np.zeros(m, np.int64)
        lcp[1:] = self.depth
        new = 1 + np.flatnonzero(name[1:] != name[:-1])
        lcp[new] = self.common(at[new - 1], at[new])
        return at, lcp

    def find_repeats(self) -> np.ndarray:
        """Per position: does its first ``depth`` symbols start anywhere else in the shard?"""
        at, lcp = self.samples()
        first = self.text[at].astype(np.int64)
        edges = np.searchsorted(first, np.arange(SYMBOLS + 1))
        larger: dict[int, list[np.ndarray]] = {}
        up = Induction(self, self.smaller, False)
        for c in range(SYMBOLS):
            larger[c] = up.bucket(c)
            seeds, prefix = at[edges[c]:edges[c + 1]], lcp[edges[c]:edges[c + 1]].copy()
            if len(seeds):
                prefix[0] = self._between(larger[c][-1][-1, 0], seeds[0]) if larger[c] else 0
                up.feed(seeds, prefix)
        down = Induction(self, self.smaller, True)
        for c in range(SYMBOLS - 1, -1, -1):
            below = down.bucket(c)
            above = larger.pop(c)
            if above:
                tuples = np.concatenate(above)
                self._mark(tuples)
                # The other way round, a tuple's prefix with the one before is that of the next one.
                seen = np.append(tuples[1:, 1], 0)[::-1].copy()
                if below:
                    seen[0] = self._between(tuples[-1, 0], below[-1][-1, 0])
                    if seen[0] >= self.depth:
                        self.repeated[[tuples[-1, 0], below[-1][-1, 0]]] = True
                down.feed(tuples[::-1, 0], seen)
            if below:
                self._mark(np.concatenate(below))
        return self.repeated

    def _between(self, a: int, b: int) -> int:
        return int(self.common(np.array([a]), np.array([b]))[0])

    def _mark(self, tuples: np.ndarray) -> None:
        hit = 1 + np.flatnonzero(tuples[1:, 1] >= self.depth)
        self.repeated[tuples[hit, 0]] = True
        self.repeated[tuples[hit - 1, 0]] = True


class Induction:
    """One direction: suffixes fed in order put their predecessors of one type into the queues."""

    def __init__(self, shard: Shard, smaller: np.ndarray, want_smaller: bool) -> None:
        self.shard, self.smaller, self.want = shard, smaller, want_smaller
        self.queues = DiskQueues(shard.folder, QUEUE_BYTES)
        self.least = np.full(SYMBOLS, -1, np.int64)  # least prefix fed since a symbol's last tuple; -1: none yet

    def bucket(self, symbol: int) -> list[np.ndarray]:
        """Every tuple of a symbol, in order; each round may bring more of the same symbol."""
        rounds: list[np.ndarray] = []
        while (tuples := self.queues.take(symbol)) is not None:
            prefix = tuples[:, 1].copy()
            if not rounds:
                prefix[0] = 0
                tuples[0, 1] = 0
            rounds.append(tuples)
            self.feed(tuples[:, 0], prefix)
        return rounds

    def feed(self, positions: np.ndarray, prefix: np.ndarray) -> None:
        for at in range(0, len(positions), CHUNK):
            self._feed(positions[at:at + CHUNK], prefix[at:at + CHUNK])

    def _feed(self, positions: np.ndarray, prefix: np.ndarray) -> None:
        depth, text = self.shard.depth, self.shard.text
        fits = (positions > 0) & (self.smaller[positions - 1] == self.want)
        k = np.flatnonzero(fits)
        earlier = self.least.copy()
        self.least[earlier >= 0] = np.minimum(earlier[earlier >= 0], prefix.min())
        if not len(k):
            return
        before = positions[k] - 1
        symbol = text[before]
        order = np.argsort(symbol, kind="stable")  # a radix sort for 16-bit symbols
        k, before, symbol = k[order], before[order], symbol[order].astype(np.int64)
        heads = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
        low = np.empty(len(k), np.int64)
        low[1:] = _range_min(prefix, k[:-1] + 1, k[1:] + 1)
        # A symbol's first tuple here meets its last one of an earlier chunk; its very first meets none.
        met = earlier[symbol[heads]]
        low[heads] = np.where(met < 0, -1, np.minimum(met, np.minimum.accumulate(prefix)[k[heads]]))
        tuples = np.stack([before, np.minimum(low + 1, depth)], axis=1)
        tails = np.append(heads[1:], len(k))
        after = np.append(np.minimum.accumulate(prefix[::-1])[::-1], depth)
        for h, t in zip(heads.tolist(), tails.tolist(), strict=True):
            s = int(symbol[h])
            self.queues.put(s, tuples[h:t])
            self.least[s] = after[k[t - 1] + 1]


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low:high] for each pair; where low >= high the result is not defined."""
    table, span = [values], 1
    while 2 * span <= len(values):
        table.append(np.minimum(table[-1][:-span], table[-1][span:]))
        span *= 2
    out = np.zeros(len(low), np.int64)
    width = np.maximum(high - low, 1)
    level = np.frexp(width.astype(np.float64))[1] - 1
    for j in np.unique(level):
        here = np.flatnonzero((level == j) & (high > low))
        out[here] = np.minimum(table[j][low[here]], table[j][high[here] - (1 << j)])
    return out


def repeated_starts(regions: list[bytes], depth: int) -> list[np.ndarray]:
    """Per region: the starts whose ``depth`` bytes lie inside it and start anywhere else as well."""
    with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
        shard = Shard(regions, depth, folder)
        flags = shard.find_repeats()
    return [np.flatnonzero(flags[s:s + max(0, len(r) - depth + 1)]) for s, r in zip(shard.starts, regions, strict=True)]
