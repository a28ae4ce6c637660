"""Benchmark passages in documents, found with Wu-Manber multi-pattern search over words.

Words are maximal runs of digits, letters and anything outside ASCII, A-Z lower-cased.  A
pattern is a window of ``WINDOW`` consecutive words of a benchmark item; an item with fewer words
is one pattern, an item with none has no pattern.  Patterns of one length share a search table:

- shift table: for the last two words of a window position, how far the search may jump;
- suffix table: where the shift is 0, the patterns that end in these two words;
- a pattern found there is compared word by word.

Null texts have no words.  Repeated documents are searched each on its own; repeated items
with different ids all count, repeated ids count once.  A null item id is not reported, but its
passage is hit.  Pattern sets beyond ``MAX_PATTERN_BYTES`` are searched in several bounded passes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.shared import stored, words_of

WINDOW = 10
MAX_PATTERN_BYTES = 4 << 20  # text of the items in one search table; a table takes some thirty times that

Words = tuple[bytes, ...]


class WuManber:
    """Search for patterns of one length (at least one word)."""

    def __init__(self, length: int, patterns: Iterable[Words]) -> None:
        self.length = length
        self.block = min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[Words, int] = {}
        self.ending: dict[Words, list[Words]] = defaultdict(list)
        for pattern in patterns:
            for end in range(self.block, length + 1):
                key = pattern[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.jump), length - end)
            self.ending[pattern[-self.block:]].append(pattern)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, Words]]:
        """(start, pattern) of every occurrence, overlapping ones too."""
        m, block, jump, shift, ending = self.length, self.block, self.jump, self.shift.get, self.ending
        at, n = m, len(words)
        while at <= n:
            key = tuple(words[at - block:at])
            step = shift(key, jump)
            if step == 0:
                window = tuple(words[at - m:at])
                for pattern in ending[key]:
                    if pattern == window:
                        yield at - m, pattern
                step = 1
            at += step


def patterns_of(text: bytes | None, window: int = WINDOW) -> set[Words]:
    words = tuple(words_of(text))
    if len(words) <= window:
        return {words} if words else set()
    return {words[i:i + window] for i in range(len(words) - window + 1)}


class Passages:
    """Search tables for a set of items, and which items each pattern belongs to."""

    def __init__(self, items: Iterable[tuple[object, bytes | None]], window: int = WINDOW) -> None:
        self.items: dict[Words, set] = defaultdict(set)
        for item_id, text in items:
            for pattern in patterns_of(text, window):
                self.items[pattern].add(item_id)
        by_length = defaultdict(list)
        for pattern in self.items:
            by_length[len(pattern)].append(pattern)
        self.searches = [WuManber(n, by_length[n]) for n in sorted(by_length)]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans (start, end) of hit words, merged and in order, and the ids of the items."""
        spans, found = [], set()
        for search in self.searches:
            for start, pattern in search.find(words):
                spans.append((start, start + search.length))
                found |= self.items[pattern]
        merged: list[tuple[int, int]] = []
        for start, end in sorted(spans):
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((start, end))
        return merged, found - {None}


FOUND = "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<bigint>"


def _search_column(spark, items: list[tuple], window: int):
    passages = spark.sparkContext.broadcast(Passages(items, window))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    @F.arrow_udf(FOUND.replace("n_words", "struct<n_words").replace("items array<bigint>", "items array<bigint>>"))
    def search(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            counts, spans, found = [], [], []
            for value in batch.cast(pa.binary()):
                words = words_of(value.as_py())
                where, ids = passages.value.search(words)
                counts.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in where])
                found.append(sorted(ids))
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(found, pa.list_(pa.int64()))],
                ["n_words", "spans", "items"])

    return search


def item_blocks(items: DataFrame, item_id: str, text: str, limit: int) -> list[list[tuple]]:
    """The items in blocks of bounded size, in order of their ids."""
    rows = items.select(F.col(f"`{item_id}`").cast("bigint"), F.col(f"`{text}`").cast("binary")).sort(item_id)
    blocks, size = [[]], 0
    for item, value in rows.toLocalIterator():
        value = bytes(value or b"")
        if blocks[-1] and size + len(value) > limit:
            blocks.append([])
            size = 0
        blocks[-1].append((item, value))
        size += len(value)
    return blocks


def find_passages(docs: DataFrame, text: str, items: DataFrame, item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, limit: int = MAX_PATTERN_BYTES, out: str = "found") -> DataFrame:
    """``docs`` with a struct ``out`` of n_words, merged spans of hit words, and item ids."""
    blocks = item_blocks(items, item_id, item_text, limit)
    done = docs.withColumn(out, _search_column(docs.sparkSession, blocks[0], window)(F.col(f"`{text}`")))
    for block in blocks[1:]:
        # Stored in between, so that no task holds more than one table.
        done = stored(done).withColumn("__llm_more", _search_column(docs.sparkSession, block, window)(F.col(f"`{text}`")))
        done = done.withColumn(out, F.struct(
            F.col(f"{out}.n_words").alias("n_words"), _merged(F.concat(f"{out}.spans", "__llm_more.spans")).alias("spans"),
            F.array_sort(F.array_union(f"{out}.items", "__llm_more.items")).alias("items"))).drop("__llm_more")
    return done


def _merged(spans):
    """Overlapping or touching spans made one."""
    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")

    def add(done, s):
        last = F.element_at(done, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"])
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(
            F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), empty, add)


def ids_digest(items):
    """SHA-256 of the item ids, sorted as strings and comma-joined."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda i: i.cast("string"))), ","), 256)
