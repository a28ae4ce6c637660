"""Alignment of two tokenizers over the same texts, on Arrow tables inside tasks.

Both token lists of a document cover the same bytes: the text behind a space.  In a task the lists
of some documents are flattened with their parent indices, and a cumulative sum of token sizes, less
the sum before each document, gives every token's end.  A hash join of both sides on (document, end)
has one row per end of either side.  Sorted, each row is a *link*: the piece of text up to that end
lies in exactly one token of each side, the next one to end.  Rows on both sides end a *group*.

How often two ids are linked is counted in three steps: per document and per block of documents in the
task, then by Spark over all blocks.  Documents keep their links as codes of their block's list of id pairs;
the totals come back to a block as one row per pair in it, so a pair that occurs everywhere is a row
per block, and no table of all pairs is needed in one place.

A null or empty text has no tokens, and neither has one whose token bytes differ from space and text on
either side (a tokenizer may normalise).  Strings of special tokens are plain text.  Each row is a
document of its own, whatever its id: repeated rows count as often as they stand there.  Of further columns
none is kept.  A document is aligned by one task, which takes some hundred bytes for each of its bytes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.bpe import LEAF, MAX_VOCABULARY_BYTES, OTHER, RUN, ByteBpe, load_vocabulary
from pairloom.llm.shared import stored

SLICE_BYTES = 1 << 20  # of text that is aligned at a time
BLOCK_BYTES = 16 << 20  # of text in one block
LOW = (1 << 32) - 1  # an id pair is the A id in the upper and the B id in the lower half of 64 bits

DOC_COLUMNS = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
               ("codes", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))]
BLOCK_COLUMNS = [("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
KINDS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"


class Tokenizers:
    """Ids of both sides, and the bytes that each id stands for."""

    def __init__(self, vocabulary: str, model: bytes) -> None:
        self.a = ByteBpe(vocabulary)
        self.a.exact.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self._bytes(i) for i in range(self.b.get_piece_size())]
        self.bytes = [pa.array(table, pa.binary()) for table in (self.a.bytes_of, pieces)]
        self.sizes = [pc.binary_length(table).cast(pa.int64()) for table in self.bytes]

    def _bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(self, text: str) -> list[int]:
        if OTHER.search(text):
            return self.a.exact.encode(text, add_special_tokens=False).ids
        if len(text) > LEAF and RUN.search(text):
            return [i for _, tokens in self.a.unsplit(text) for i in tokens]
        return self.a.fast.encode_ordinary(text)

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        kind = pa.list_(pa.int32())
        ids = [self.encode_a(" " + t) if t else [] for t in texts], self.b.encode(texts, num_threads=1)
        return tuple(pa.array(side, kind) for side in ids)


@functools.lru_cache(maxsize=1)
def _loaded(vocabulary: str, model: bytes) -> Tokenizers:
    return Tokenizers(vocabulary, model)


def load_model(spark, path: str):
    """The bytes of a piece model, checked for size, as a broadcast."""
    with open(path, "rb") as f:
        content = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError("the model file is too large to broadcast")
    return spark.sparkContext.broadcast(content)


# Tables of a slice of documents.

def ends_of(lists: pa.ListArray, sizes: pa.Array) -> pa.Array:
    """The end of every token inside its document: cumulative sums that begin again with each list."""
    running = pc.cumulative_sum(sizes.take(pc.list_flatten(lists)))
    before = pa.concat_arrays([pa.array([0], pa.int64()), running]).take(lists.offsets.slice(0, len(lists)))
    return pc.subtract(running, before.take(pc.list_parent_indices(lists)))


def joined_bytes(lists: pa.ListArray, table: pa.Array) -> pa.Array:
    tokens = pa.ListArray.from_arrays(lists.offsets, table.take(pc.list_flatten(lists)))
    return pc.binary_join(tokens, b"")


def side_table(lists: pa.ListArray, sizes: pa.Array, name: str) -> pa.Table:
    """(key, id) of all tokens; the key is the document's number and the end in it."""
    parents = pc.list_parent_indices(lists).cast(pa.int64())
    key = pc.add(pc.shift_left(parents, 40), ends_of(lists, sizes))
    return pa.table({"key": key, name: pc.list_flatten(lists)})


def aligned(tokenizers: Tokenizers, texts: list[str]) -> tuple[pa.Table, pa.Table]:
    """(documents, pairs) of some texts: counts and groups per document, and the number of links per
    document and id pair."""
    whole = pa.array([b" " + t.encode() if t else b"" for t in texts], pa.binary())
    lists = tokenizers.encode(texts)
    equal = [pc.equal(joined_bytes(side, table), whole) for side, table in zip(lists, tokenizers.bytes, strict=True)]
    good = pc.and_(*equal)
    if not pc.all(good).as_py():
        lists = [pc.if_else(good, side, pa.scalar([], side.type)) for side in lists]
    a, b = (side_table(side, sizes, name) for side, sizes, name in zip(lists, tokenizers.sizes, "ab", strict=True))
    links = a.join(b, "key", join_type="full outer", use_threads=False)
    links = links.take(pc.sort_indices(links["key"])).combine_chunks()
    doc = pc.shift_right(links["key"], 40)
    ends_a, ends_b = pc.is_valid(links["a"]), pc.is_valid(links["b"])
    both = pc.and_(ends_a, ends_b)
    id_a, id_b = (pc.fill_null_backward(links[c]).cast(pa.int64()) for c in "ab")
    table = pa.table({"doc": doc, "pair": pc.bit_wise_or(pc.shift_left(id_a, 32), id_b), "a": ends_a.cast(pa.int64()),
                      "b": ends_b.cast(pa.int64()), "both": both.cast(pa.int64())})
    counted = table.group_by("doc", use_threads=False).aggregate([("a", "sum"), ("b", "sum"), ("both", "sum"), ([], "count_all")])
    pairs = table.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    pairs = pairs.take(pc.sort_indices(pairs["doc"]))  # groups come in no sure order
    groups = group_texts(links, ends_a, ends_b, both)
    numbers = np.zeros((4, len(texts)), np.int64)
    at = counted["doc"].to_numpy()
    for row, c in zip(numbers, ("a_sum", "b_sum", "both_sum", "count_all"), strict=True):
        row[at] = counted[c].to_numpy()
    per_doc = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(numbers[2])]).astype(np.int32)), groups)
    names = [name for name, _ in DOC_COLUMNS[:4]]
    return pa.table([pa.array(r) for r in numbers] + [pc.binary_join(per_doc, ";")], [*names, "groups"]), pairs


def group_texts(links: pa.Table, ends_a: pa.ChunkedArray, ends_b: pa.ChunkedArray, both: pa.ChunkedArray) -> pa.Array:
    """"a1,a2|b1" of every group, in order."""
    last = both.combine_chunks().to_numpy(zero_copy_only=False)
    group = np.cumsum(last) - last
    n = int(last.sum())
    sides = []
    for name, there in (("a", ends_a), ("b", ends_b)):
        mask = there.combine_chunks().to_numpy(zero_copy_only=False)
        offsets = np.searchsorted(group[mask], np.arange(n + 1)).astype(np.int32)
        ids = links[name].combine_chunks().drop_null().cast(pa.string())
        sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), ids), ","))
    return pc.binary_join_element_wise(*sides, "|")


def slices_of(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(start, end) of neighbouring texts of together about ``size`` bytes."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(lengths) - lengths) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield start, end


class OpenBlock:
    """Aligned documents of one block, until it is full."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.docs: list[pa.Table] = []
        self.pairs: list[pa.Table] = []
        self.n = self.bytes = 0

    def add(self, ids: pa.Array, docs: pa.Table, pairs: pa.Table, size: int) -> None:
        moved = pc.add(pairs["doc"], self.n)
        self.ids.append(ids)
        self.docs.append(docs)
        self.pairs.append(pa.table({"doc": moved, "pair": pairs["pair"], "n": pairs["count_all"]}))
        self.n += len(ids)
        self.bytes += size

    def rows(self, block: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """One row per document, and one with the block's id pairs and their counts."""
        pairs = pa.concat_tables(self.pairs).combine_chunks()
        coded = pairs["pair"].combine_chunks().dictionary_encode()
        codes = coded.indices
        counts = pa.table({"code": codes, "n": pairs["n"]}).group_by("code", use_threads=False).aggregate([("n", "sum")])
        counts = counts.take(pc.sort_indices(counts["code"]))
        offsets = pa.array(np.searchsorted(pairs["doc"].to_numpy(), np.arange(self.n + 1)).astype(np.int32))
        docs = pa.concat_tables(self.docs).combine_chunks()
        columns = {"block": pa.array(np.full(self.n, block)), "doc": pa.concat_arrays(self.ids),
                   **{c: docs[c].combine_chunks() for c in docs.column_names},
                   "codes": pa.ListArray.from_arrays(offsets, codes),
                   "times": pa.ListArray.from_arrays(offsets, pairs["n"].combine_chunks().cast(pa.int32()))}
        filled = [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(self.n, f.type) for f in schema]
        yield pa.RecordBatch.from_arrays(filled, schema=schema)
        own = {"block": [block], "pairs": [coded.dictionary.to_numpy()], "counts": [counts["n_sum"].to_numpy()]}
        yield pa.RecordBatch.from_arrays([pa.array(own.get(f.name, [None]), f.type) for f in schema], schema=schema)


def align_blocks(docs: DataFrame, vocabulary, model, digest: bool, block_bytes: int) -> DataFrame:
    """(doc, text) -> rows of documents and of blocks (those with ``pairs``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _loaded(vocabulary.value, model.value)
        number, block = TaskContext.get().partitionId() << 32, OpenBlock()
        for batch in batches:
            schema = pa.schema([("block", pa.int64()), ("doc", batch.schema.field(0).type), *DOC_COLUMNS, *BLOCK_COLUMNS])
            for start, end in slices_of(batch.column(1), SLICE_BYTES):
                texts = [t or "" for t in batch.column(1).slice(start, end - start).to_pylist()]
                found, pairs = aligned(tokenizers, texts)
                if digest:
                    names = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"].to_pylist()]
                    found = found.set_column(4, "groups", pa.array(names, pa.string()))
                block.add(batch.column(0).slice(start, end - start), found, pairs, sum(map(len, texts)))
                if block.bytes >= block_bytes:
                    yield from block.rows(number, schema)
                    number, block = number + 1, OpenBlock()
        if block.n:
            yield from block.rows(number, schema)

    arrays = "codes array<int>, times array<int>, pairs array<bigint>, counts array<bigint>"
    return docs.mapInArrow(run, f"block bigint, doc {docs.schema['doc'].dataType.simpleString()}, {KINDS}, {arrays}")


def align_tokens(docs: DataFrame, doc_id: str, text: str, vocabulary_path: str, model_path: str, digest: bool = False,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: its id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``.

    ``groups`` lists the ids of both sides, group by group (``a1,a2|b1;a3|b2,b3``), or with ``digest``
    is the SHA-256 of that; it is empty without tokens.  ``count_sum`` adds up, over a document's
    links, how many links of all documents are between the same two ids; ``n_best`` counts the links
    whose id of the second tokenizer is linked to no other id more often.
    """
    spark = docs.sparkSession
    vocabulary, model = load_vocabulary(spark, vocabulary_path), load_model(spark, model_path)
    given = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    rows = stored(align_blocks(given, vocabulary, model, digest, block_bytes))
    listed = rows.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "c"))
    partial = listed.select("block", "code", F.col("c.pairs").alias("pair"), F.col("c.counts").alias("n"))
    totals = partial.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair").bitwiseAND(F.lit(LOW)))
    # One row per id of the second tokenizer: bounded by its vocabulary, whose size was checked.
    highest = F.broadcast(totals.groupBy("b").agg(F.max("total").alias("highest")))
    known = stored(totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best")))
    answers = partial.join(known, "pair").select(F.col("block").alias("of"), "code", "total", "best")
    per_doc = rows.where("pairs IS NULL").drop("pairs", "counts")
    schema = f"doc {docs.schema[doc_id].dataType.simpleString()}, {KINDS}, n_best bigint, count_sum bigint"
    summed = per_doc.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_summed, schema)
    return summed.select(F.col("doc").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def _summed(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Documents of one block with the sums over their links."""
    total = np.zeros(answers.num_rows, np.int64)
    best = np.zeros(answers.num_rows, np.int64)
    code = answers["code"].to_numpy()
    total[code], best[code] = answers["total"].to_numpy(), answers["best"].to_numpy()
    codes, times = docs["codes"].combine_chunks(), docs["times"].combine_chunks()
    at, n = pc.list_flatten(codes).to_numpy(), pc.list_flatten(times).to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(codes).to_numpy())])
    kept = docs.drop_columns(["block", "codes", "times"])
    for name, values in (("n_best", best), ("count_sum", total)):
        running = np.concatenate([[0], np.cumsum(n * values[at])])
        kept = kept.append_column(name, pa.array(running[ends[1:]] - running[ends[:-1]]))
    return kept
