"""Removal of every byte that a long repeated string covers, over the whole corpus.

A string of ``DEPTH`` bytes is repeated if it starts at two places at least, in one document or in
two; all bytes that repeated strings cover are removed, judged on the input.  Strings never cross
documents.  The repeated strings are found by sorting suffixes in shards (``suffix_sort``):

1. Equal texts are one text; one that occurs twice and has ``DEPTH`` bytes is repeated as a whole.
2. Every string of ``DEPTH`` bytes gets an anchor, the least hash of the 40-byte grams in it.  Equal
   strings have equal anchors.  Neighbouring starts with one anchor form a region.
3. An anchor with one region, in which its gram stands once, holds no repeated string.  A region
   that occurs twice is repeated as a whole.  What remains are anchors with several variants of a
   region, or with a gram that stands twice in one.
4. Those regions, each variant once, are dealt to shards by anchor, and a shard's suffixes are sorted:
   starts that share ``DEPTH`` bytes with a neighbour are repeated.
5. An anchor whose variants make more than ``SHARD_BYTES`` is not sorted in one task: each of its starts
   becomes a row with a 128-bit hash of its ``DEPTH`` bytes, and hashes that stand at two places are repeated.
6. Repeated starts are gathered per document, merged and cut out.

Null texts count as empty.  Texts under ``DEPTH`` bytes are never touched.  Repeated rows are copies
of each other like any equal texts, whatever their ids.  Positions are bytes of UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm import words
from pairloom.llm.shared import parts_for, stored, text_key
from pairloom.llm.suffix_sort import repeated_starts
from pairloom.operators.joins import lookup_join

DEPTH = 200
GRAM = 40
PIECE = 1 << 20
SHARD_BYTES = 3 << 20
START_ROWS = 100_000

_LANES = np.random.default_rng(20240301).integers(1, 1 << 63, (2, 256), dtype=np.uint64)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _twice(grams: np.ndarray, anchors: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """Per region: does its anchor stand at two places of it or more?"""
    # A gram is the least of a window if and only if it equals the greatest anchor of the windows around it.
    zeros = np.zeros(width - 1, np.uint64)
    around = ~_sliding_min(~np.concatenate([zeros, anchors, zeros]), width)
    at = np.flatnonzero(grams == around)
    order = np.lexsort((at, grams[at]))
    value, place = grams[at[order]], at[order]
    low, high = np.searchsorted(value, anchors[first]), np.searchsorted(value, anchors[first], "right")
    out = np.zeros(len(first), np.bool_)
    for k in np.flatnonzero(high - low > 1).tolist():
        inside = np.searchsorted(place[low[k]:high[k]], [first[k], last[k] + width])
        out[k] = inside[1] - inside[0] > 1
    return out


def regions(data: bytes, depth: int = DEPTH, gram: int = GRAM, check_twice: bool = True) -> tuple[np.ndarray, ...]:
    """First start, last start, anchor, content hash and "the anchor stands twice" of every region of a text."""
    parts = []
    for at in range(0, max(0, len(data) - depth + 1), PIECE):
        b = np.frombuffer(data, np.uint8, min(PIECE + depth - 1, len(data) - at), at)
        power, inverse = words._power_tables(len(b) + 1)
        prefix = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(words._BYTE[b] * power[:len(b)], out=prefix[1:])
        n = len(b) - gram + 1
        grams = words.mix((prefix[gram:] - prefix[:n]) * inverse[:n])
        anchors = _sliding_min(grams, depth - gram + 1)
        edges = 1 + np.flatnonzero(anchors[1:] != anchors[:-1])
        first, last = np.append(0, edges), np.append(edges - 1, len(anchors) - 1)
        content = words.mix((prefix[last + depth] - prefix[first]) * inverse[first] + (last - first).astype(np.uint64))
        twice = (_twice(grams, anchors, first, last, depth - gram + 1) if check_twice else np.zeros(len(first), np.bool_))
        parts.append((first + at, last + at, anchors[first], content, twice))
    if not parts:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.bool_))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def window_keys(data: bytes, depth: int) -> np.ndarray:
    """A 128-bit hash of every run of ``depth`` bytes, shape (n, 2): hashes of 1, 2, 4... bytes, mixed and joined."""
    b = np.frombuffer(data, np.uint8)
    n = max(0, len(b) - depth + 1)
    keys = np.zeros((n, 2), np.uint64)
    for lane in range(2):
        level, width, at = _LANES[lane][b], 1, 0
        key = np.full(n, depth, np.uint64)
        while n and width <= depth:
            if depth & width:
                key = words.mix(key * words._MUL + level[at:at + n])
                at += width
            level = words.mix(level[:-width] * words._MUL + level[width:])
            width *= 2
        keys[:, lane] = key
    return keys


def runs(rows: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[list[int], list[int], list[int]]]:
    """Documents, first and last starts of the runs in a stream of (document, start) in order; repeats count once."""
    last_doc, first, last = None, 0, 0
    for docs, starts in rows:
        out: tuple[list[int], ...] = ([], [], [])
        edges = np.append(True, (docs[1:] != docs[:-1]) | (np.diff(starts) > 1))
        heads = np.flatnonzero(edges)
        for h, t in zip(heads.tolist(), np.append(heads[1:], len(docs)).tolist(), strict=True):
            doc, low, high = int(docs[h]), int(starts[h]), int(starts[t - 1])
            if doc == last_doc and low <= last + 1:
                last = high
                continue
            if last_doc is not None:
                for column, v in zip(out, (last_doc, first, last), strict=True):
                    column.append(v)
            last_doc, first, last = doc, low, high
        if out[0]:
            yield out
    if last_doc is not None:
        yield [last_doc], [first], [last]


def merged_spans(ranges: list[tuple[int, int]], depth: int) -> list[tuple[int, int]]:
    """Bytes covered by the strings that start in the given ranges (both ends included)."""
    spans: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], last + depth))
        else:
            spans.append((first, last + depth))
    return spans


def cut_out(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, end in spans:
        out.append(data[at:start])
        at = end
    return b"".join([*out, data[at:]])


def repeated_spans(docs: DataFrame, doc_id: str, text: str, depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """Per distinct text with something to remove: text_key and spans, an array of (start, end)."""
    own = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("text_key"),
                      F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("bytes"))
    own = own.where(F.octet_length("bytes") >= depth)
    texts = stored(own.groupBy("text_key").agg(
        F.count("*").alias("copies"), F.min(F.coalesce("doc_id", F.lit(-(1 << 62)))).alias("rep"),
        F.first(F.octet_length("bytes")).cast("bigint").alias("size")).withColumn("doc_no", F.monotonically_increasing_id()))
    # One row per text, but for rows that repeat both id and text.
    once = lookup_join(own, texts.select("text_key", "doc_no", "rep"), "text_key", "text_key", "inner").where(
        F.coalesce("doc_id", F.lit(-(1 << 62))) == F.col("rep"))

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows, size = [], 0
            for number, value in zip(*batch.columns, strict=True):
                first, last, anchor, content, twice = regions(value.as_py(), depth, gram)
                rows.append((np.full(len(first), number.as_py(), np.int64), np.arange(len(first), dtype=np.int32), first, last,
                             anchor.view(np.int64), content.view(np.int64), twice))
                size += len(first)
                if size > 100_000:
                    yield as_batch(rows, ["doc_no", "place", "first", "last", "anchor", "content", "twice"])
                    rows, size = [], 0
            if rows:
                yield as_batch(rows, ["doc_no", "place", "first", "last", "anchor", "content", "twice"])

    def as_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names)

    # A place is a document and a region of it; repeated rows give the same place again.
    at = F.xxhash64("doc_no", "place").alias("at")
    found = stored(once.select("doc_no", "bytes").mapInArrow(
        find, "doc_no bigint, place int, first bigint, last bigint, anchor bigint, content bigint, twice boolean"))
    contents = found.select("anchor", "content", "twice", at).groupBy("anchor", "content").agg(
        F.min("at").alias("one"), (F.min("at") != F.max("at")).alias("again"), F.max("twice").alias("twice"))
    anchors = contents.groupBy("anchor").agg(
        ((F.min("content") != F.max("content")) | F.max("twice")).alias("open"), F.max("again").alias("any_again")).where(
        "open OR any_again").select("anchor", "open")
    contents = contents.drop("twice").join(anchors, "anchor").where("open OR again")
    chosen = stored(found.join(contents, ["anchor", "content"]).select(
        "doc_no", "place", "first", "last", "anchor", "again", "open", (at == F.col("one")).alias("is_one")).where(
        "again OR (open AND is_one)"))

    # The regions to sort, cut from their texts by number.
    to_sort = chosen.where("open AND is_one").distinct()
    size = F.sum(F.col("last") - F.col("first") + depth)
    total = to_sort.agg(size).first()[0] or 0
    # At most total / SHARD_BYTES anchors.
    crowded = stored(chosen.where("open AND is_one").groupBy("anchor").agg(size.alias("size")).where(
        F.col("size") > SHARD_BYTES).select("anchor", F.lit(True).alias("crowded")))
    any_crowded = not crowded.isEmpty()
    if any_crowded:
        to_sort = lookup_join(to_sort, crowded, "anchor", "anchor", "left")
    else:
        to_sort = to_sort.withColumn("crowded", F.lit(None).cast("boolean"))
    place = F.when(F.col("again"), -1 - F.col("place")).otherwise(F.col("place"))
    by_text = stored(to_sort.groupBy("doc_no").agg(
        F.collect_list(F.when(F.col("crowded").isNull(), place)).alias("places"),
        F.collect_list(F.when(F.col("crowded"), place)).alias("crowded")).join(
        texts.select("doc_no", "text_key"), "doc_no"))
    carried = lookup_join(once.select("text_key", "bytes"), by_text.where(F.size("places") > 0).drop("crowded"),
                          "text_key", "text_key", "inner")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "doc_no", "first", "again"]
        for batch in parts:
            rows, texts, size = [], [], 0
            for number, data, listed in zip(*batch.columns, strict=True):
                data, places = data.as_py(), np.array(listed.as_py(), np.int64)
                first, last, anchor, _, _ = regions(data, depth, gram, check_twice=False)
                again, places = places < 0, np.where(places < 0, -1 - places, places)
                rows.append((anchor[places].view(np.int64), np.full(len(places), number.as_py(), np.int64), first[places], again))
                own = [data[a:b + depth] for a, b in zip(first[places].tolist(), last[places].tolist(), strict=True)]
                texts += own
                size += sum(map(len, own))
                if size > 4 << 20:
                    yield as_batch(rows, names).append_column("region", pa.array(texts, pa.binary()))
                    rows, texts, size = [], [], 0
            if rows:
                yield as_batch(rows, names).append_column("region", pa.array(texts, pa.binary()))

    cut_regions = carried.select("doc_no", "bytes", "places").mapInArrow(
        cut, "anchor bigint, doc_no bigint, first bigint, again boolean, region binary")

    def sort(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(parts)
        if not batches:
            return
        columns = pa.Table.from_batches(batches)
        del batches
        numbers, firsts = (columns.column(c).to_numpy() for c in ("doc_no", "first"))
        # A row that repeats id and text has been cut twice; each place counts once.
        once_each = np.unique(np.stack([numbers, firsts]), axis=1, return_index=True)[1]
        columns = columns.take(once_each)
        starts = repeated_starts([r.as_py() for r in columns.column("region")], depth)
        rows = ([], [], [])
        for number, first, again, hits in zip(
                columns.column("doc_no").to_pylist(), columns.column("first").to_pylist(), columns.column("again").to_pylist(),
                starts, strict=True):
            if len(hits) and not again:
                gaps = np.flatnonzero(np.diff(hits) > 1)
                for a, b in zip(hits[np.append(0, gaps + 1)].tolist(), hits[np.append(gaps, len(hits) - 1)].tolist(), strict=True):
                    for column, v in zip(rows, (number, first + a, first + b), strict=True):
                        column.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], ["doc_no", "first", "last"])

    def cut_starts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows, size = [], 0
            for number, data, listed in zip(*batch.columns, strict=True):
                data, places = data.as_py(), np.array(listed.as_py(), np.int64)
                first, last, *_ = regions(data, depth, gram, check_twice=False)
                for place in places.tolist():
                    again, place = place < 0, (-1 - place if place < 0 else place)
                    a, b = int(first[place]), int(last[place])
                    for low in range(a, b + 1, START_ROWS):
                        high = min(b + 1, low + START_ROWS)
                        n = high - low
                        rows.append((np.full(n, number.as_py(), np.int64), np.arange(low, high), np.full(n, again),
                                     window_keys(data[low:high - 1 + depth], depth)))
                        size += n
                        if size >= START_ROWS:
                            yield start_batch(rows)
                            rows, size = [], 0
            if rows:
                yield start_batch(rows)

    def start_batch(rows: list[tuple]) -> pa.RecordBatch:
        docs_, starts, again, keys = (np.concatenate(c) for c in zip(*rows, strict=True))
        keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(np.ascontiguousarray(keys))])
        return pa.RecordBatch.from_arrays([pa.array(docs_), pa.array(starts), pa.array(again), keys.cast(pa.binary())],
                                          ["doc_no", "start", "again", "key"])

    def join_runs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in runs((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in parts if b.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["doc_no", "first", "last"])

    shards = cut_regions.repartition(parts_for(total, SHARD_BYTES), "anchor")
    ranges = shards.mapInArrow(sort, "doc_no bigint, first bigint, last bigint")
    if any_crowded:
        carried = lookup_join(once.select("text_key", "bytes"), by_text.where(F.size("crowded") > 0).drop("places"),
                              "text_key", "text_key", "inner")
        starts = stored(carried.select("doc_no", "bytes", "crowded").mapInArrow(
            cut_starts, "doc_no bigint, start bigint, again boolean, key binary"))
        # Two places differ in document or start; a row that repeats id and text gives the same place again.
        keys = stored(starts.groupBy("key").agg(*(f(c).alias(f"{f.__name__}_{c}") for c in ("doc_no", "start") for f in (F.min, F.max))).where(
            "min_doc_no != max_doc_no OR min_start != max_start").select("key"))
        # A key may stand in any number of rows.
        hits = lookup_join(starts.where("NOT again").drop("again"), keys, "key", "key", "left_semi")
        ranges = ranges.union(hits.select("doc_no", "start").repartition("doc_no").sortWithinPartitions(
            "doc_no", "start").mapInArrow(join_runs, "doc_no bigint, first bigint, last bigint"))
    ranges = ranges.union(
        chosen.where("again").select("doc_no", "first", "last")).union(
        texts.where("copies > 1").select("doc_no", F.lit(0).cast("bigint"), F.col("size") - depth))

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf("array<struct<start: bigint, end: bigint>>")
    def merge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([[{"start": s, "end": e} for s, e in merged_spans([(r["first"], r["last"]) for r in row], depth)]
                            for row in batch.to_pylist()], span)

    # As many ranges as the document itself has.
    gathered = ranges.groupBy("doc_no").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    return gathered.join(texts.select("doc_no", "text_key"), "doc_no").select("text_key", merge("ranges").alias("spans"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH,
                   gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_bytes, spans (removed byte runs, start and end), kept (the other bytes)."""
    spans = stored(repeated_spans(docs, doc_id, text, depth, gram))
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("text_key"),
                      F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("bytes"))
    joined = lookup_join(own, spans, "text_key", "text_key", "left")

    @F.arrow_udf("binary")
    def keep(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, removed in batches:
            yield pa.array([cut_out(t.as_py(), [(s["start"], s["end"]) for s in r.as_py() or ()])
                            for t, r in zip(texts, removed, strict=True)], pa.binary())

    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return joined.select("doc_id", F.octet_length("bytes").cast("bigint").alias("n_bytes"),
                         F.coalesce("spans", empty).alias("spans"), keep("bytes", "spans").alias("kept"))
