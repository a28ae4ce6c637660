"""Hard negatives of anchors by a vertical scan: vectors stored by dimension, candidates pruned by bounds.

Vectors become whole numbers, floor(scale * x), and lie in blocks of columns, with the least and the
largest value of each dimension.  For an anchor the dimensions of a block are read in descending
order of the anchor's magnitude.  After every few of them each candidate has a partial score, and
the dimensions still to come can add no less and no more than their least and largest values allow.
Candidates whose bounds lie outside every window of interest leave the bitmap; what is left at the
end has exact scores.

1. The positives of an anchor, its first ``n_positives`` other rows of the same label: the window
   begins at the n-th best lower bound known so far.
2. The negatives of an anchor and a positive, rows of other labels with
   ``low * positive_score <= 100 * negative_score <= high * positive_score``: each positive has such
   a window, which rises to the n-th best lower bound of the candidates surely inside it.

Anchors and blocks are dealt to cells, each with at most ``GROUP_BYTES`` of either; every cell
returns its best rows per anchor or per positive, and a ranking with a limit per task picks among
the cells.

Rows with a null id or label, a null vector, or a null or non-finite component take no part.  Vectors
are compared with those of the same length only; without components every score is 0.  Repeated
ids: each row is a candidate of its own, never for an anchor of its own id; of the anchors with one id that with the
smallest label, then vector, counts.  Ties go to the smaller id.  Scores beyond 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.llm.shared import parts_for, stored

BLOCK_ROWS = 4096
BLOCK_BYTES = 8 << 20
GROUP_BYTES = 32 << 20
STEP = 8  # dimensions read between two looks at the bounds

BLOCK_SCHEMA = "n_dims int, ids binary, labels binary, width int, columns binary, lows binary, highs binary"
ANCHOR_SCHEMA = "anchor_id bigint, label bigint, codes array<bigint>"
FOUND = "anchor_id bigint, positive_no int, id bigint, score bigint"


# Whole numbers.

def quantised(vectors: pa.Array, scale: float) -> list[np.ndarray | None]:
    """floor(scale * x) of each vector as int64; None for a vector that takes no part."""
    out: list[np.ndarray | None] = []
    offsets, values = np.asarray(vectors.offsets), vectors.values
    numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False) if len(values) else np.empty(0)
    for i, there in enumerate(np.asarray(vectors.is_valid())):
        x = numbers[offsets[i]:offsets[i + 1]]
        if not there or not np.isfinite(x).all():  # a null component reads as nan
            out.append(None)
            continue
        x = np.floor(x * scale)
        if len(x) and not np.abs(x).max() < 2.0 ** 62:
            raise OverflowError("a component is too large for scores of 64 bits")
        out.append(x.astype(np.int64))
    return out


def column_block(ids: list[int], labels: list[int], rows: list[np.ndarray]) -> dict:
    """Rows of one length, stored by dimension in the narrowest whole numbers that hold them."""
    matrix = np.ascontiguousarray(np.stack(rows).T) if len(rows[0]) else np.empty((0, len(rows)), np.int64)
    lows, highs = (matrix.min(1), matrix.max(1)) if len(matrix) else (np.empty(0, np.int64),) * 2
    most = int(max(np.abs(lows).max(), np.abs(highs).max())) if len(matrix) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return {"n_dims": len(matrix), "ids": np.asarray(ids, "<i8").tobytes(), "labels": np.asarray(labels, "<i8").tobytes(),
            "width": width, "columns": matrix.astype(f"<i{width}").tobytes(), "lows": lows.astype("<i8").tobytes(),
            "highs": highs.astype("<i8").tobytes()}


BLOCK_ARROW = pa.schema([("n_dims", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("width", pa.int32()),
                         ("columns", pa.binary()), ("lows", pa.binary()), ("highs", pa.binary())])
ANCHOR_ARROW = pa.schema([("anchor_id", pa.int64()), ("label", pa.int64()), ("codes", pa.list_(pa.int64()))])
FOUND_ARROW = pa.schema([("anchor_id", pa.int64()), ("positive_no", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def column_blocks(vectors: DataFrame, scale: float) -> DataFrame:
    """(id, label, vector) -> blocks; a task fills one block per length of vector at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, tuple[list, list, list]] = {}

        def closed(n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([column_block(*open_blocks.pop(n))], BLOCK_ARROW)

        for batch in batches:
            ids, labels, lists = (batch.column(k) for k in range(3))
            for i, label, row in zip(ids.to_pylist(), labels.to_pylist(), quantised(lists, scale), strict=True):
                if row is None or i is None or label is None:
                    continue
                block = open_blocks.setdefault(len(row), ([], [], []))
                for part, value in zip(block, (i, label, row), strict=True):
                    part.append(value)
                if len(block[0]) >= max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(8 * len(row), 1))):
                    yield closed(len(row))
        for n in list(open_blocks):
            yield closed(n)

    return vectors.mapInArrow(run, BLOCK_SCHEMA)


def anchor_rows(vectors: DataFrame, scale: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, lists = (batch.column(k) for k in range(3))
            rows = [{"anchor_id": i, "label": label, "codes": row}
                    for i, label, row in zip(ids.to_pylist(), labels.to_pylist(), quantised(lists, scale), strict=True)
                    if row is not None and i is not None and label is not None]
            yield pa.RecordBatch.from_pylist(rows, ANCHOR_ARROW)

    rows = vectors.mapInArrow(run, ANCHOR_SCHEMA)
    first = rows.groupBy("anchor_id").agg(F.min(F.struct("label", "codes")).alias("first"))
    return first.select("anchor_id", "first.*")


# The scan of one block.

class Block:
    def __init__(self, row: dict) -> None:
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        n = len(self.ids)
        stored_columns = np.frombuffer(row["columns"], f"<i{row['width']}").reshape(row["n_dims"], n)
        self.lows, self.highs = np.frombuffer(row["lows"], "<i8"), np.frombuffer(row["highs"], "<i8")
        self.most = np.maximum(np.abs(self.lows), np.abs(self.highs)).astype(np.float64)
        self.whole = stored_columns
        self.columns: dict[type, np.ndarray] = {}

    def kind_for(self, anchor: np.ndarray) -> type:
        """Doubles, in which sums below 2**53 are exact, or else 64-bit numbers."""
        largest = float(np.abs(anchor).astype(np.float64) @ self.most)
        if largest >= 2.0 ** 62:
            raise OverflowError("a score may be too large for 64 bits")
        return np.float64 if largest < 2.0 ** 52 else np.int64

    def scan(self, anchor: np.ndarray, alive: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """(places, exact scores) of the candidates that ``windows`` let through to the end.

        ``alive`` is the bitmap to begin with.
        """
        kind = self.kind_for(anchor)
        if kind not in self.columns:
            self.columns[kind] = self.whole.astype(kind)
        columns = self.columns[kind]
        order = np.argsort(-np.abs(anchor), kind="stable")
        weights = anchor[order].astype(kind)
        ends = weights * self.lows[order].astype(kind), weights * self.highs[order].astype(kind)
        # What the dimensions from the k-th on can add at least and at most.
        least = np.concatenate([np.cumsum(np.minimum(*ends)[::-1])[::-1], [0]])
        most = np.concatenate([np.cumsum(np.maximum(*ends)[::-1])[::-1], [0]])
        places = np.flatnonzero(alive)
        partial = np.zeros(len(places), kind)
        held, at_places = columns, places
        for k in range(0, len(order), STEP):
            if not len(places):
                break
            now = order[k:k + STEP]
            if len(places) * 2 < held.shape[1]:  # few are left: their numbers alone are copied
                held, at_places = held[:, at_places], np.arange(len(places))
            taken = held[now] if len(at_places) == held.shape[1] else held[now][:, at_places]
            partial = partial + weights[k:k + STEP] @ taken
            done = min(k + STEP, len(order))
            stays = windows.admit(partial + least[done], partial + most[done])
            if not stays.all():
                places, partial, at_places = places[stays], partial[stays], at_places[stays]
        return places, partial.astype(np.int64)


class Windows:
    """Score windows (low, high) that want their first ``n`` rows each; the lower ends rise as rows are found."""

    def __init__(self, lows: list[int], highs: list[int], n: int) -> None:
        self.lows, self.highs, self.n = lows, highs, n
        self.floor = list(lows)
        self.found: list[list[tuple[int, int]]] = [[] for _ in lows]  # (-score, id), the first n of each window

    def admit(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether each candidate, whose score lies between ``least`` and ``most``, may still be wanted."""
        stays = np.zeros(len(least), bool)
        for low, high, floor in zip(self.lows, self.highs, self.floor, strict=True):
            sure = least[(least >= low) & (most <= high)]
            if len(sure) >= self.n:
                floor = max(floor, np.partition(sure, len(sure) - self.n)[-self.n])
            stays |= (most >= floor) & (least <= high)
        return stays

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for j, (high, floor) in enumerate(zip(self.highs, self.floor, strict=True)):
            inside = (scores >= floor) & (scores <= high)
            if inside.any():
                i, s = ids[inside], scores[inside]
                first = np.lexsort((i, -s))[:self.n]
                merged = sorted([*self.found[j], *zip((-s[first]).tolist(), i[first].tolist(), strict=True)])[:self.n]
                self.found[j] = merged
                if len(merged) == self.n:
                    self.floor[j] = max(self.floor[j], -merged[-1][0])


# Cells.

def _cells(big: DataFrame, n: int, copies: int, no: str, of: str, by: Column) -> DataFrame:
    """Rows dealt to ``n`` groups (column ``no``), one copy for each of the other side's ``copies`` groups (``of``)."""
    dealt = big.withColumn(no, F.pmod(F.xxhash64(by), F.lit(n)))
    return dealt.withColumn(of, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))))


def scan_cells(anchors: DataFrame, blocks: DataFrame, groups: tuple[int, int], n_best: int, same_label: bool) -> DataFrame:
    """The first ``n_best`` rows of each window of each anchor in each cell: (anchor_id, positive_no, id, score).

    ``anchors`` has (anchor_id, label, codes, lows, highs), the windows as arrays.
    """
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        codes = left.column("codes").combine_chunks()
        at, numbers = np.asarray(codes.offsets), np.asarray(codes.values)
        queries = [(r, numbers[at[k]:at[k + 1]], Windows(r["lows"], r["highs"], n_best))
                   for k, r in enumerate(left.drop_columns(["codes"]).to_pylist())]
        for k in range(right.num_rows):
            block = Block(right.slice(k, 1).to_pylist()[0])
            for r, codes, windows in queries:
                if len(codes) != len(block.whole):
                    continue
                same = block.labels == r["label"]
                alive = (same if same_label else ~same) & (block.ids != r["anchor_id"])
                if alive.any():
                    places, scores = block.scan(codes, alive, windows)
                    windows.add(block.ids[places], scores)
        rows = [(r["anchor_id"], j, i, -s) for r, _, w in queries for j, best in enumerate(w.found) for s, i in best]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, FOUND_ARROW.types, strict=True)],
                                    schema=FOUND_ARROW)

    n_anchors, n_blocks = groups
    left = _cells(anchors, n_anchors, n_blocks, "__llm_a", "__llm_b", F.col("anchor_id"))
    right = _cells(blocks.withColumn("__llm_no", F.monotonically_increasing_id()), n_blocks, n_anchors, "__llm_b", "__llm_a",
                   F.col("__llm_no")).drop("__llm_no")
    return left.groupBy("__llm_a", "__llm_b").cogroup(right.groupBy("__llm_a", "__llm_b")).applyInArrow(run, FOUND)


def ranked(found: DataFrame, n: int, *by: str) -> DataFrame:
    """The first ``n`` rows by score, then id; tasks pass on no more than their first ``n``."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine_hard_negatives(vectors: DataFrame, vec_id: str, label: str, vector: str, is_anchor: Column, scale: float = 256,
                        n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
                        group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); see the module.

    ``is_anchor`` is a condition on the columns of ``vectors``; a null counts as no.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"),
                          F.col(f"`{vector}`").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    given = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    blocks = stored(column_blocks(given.select("id", "label", "vector"), scale))
    anchors = stored(anchor_rows(given.where("is_anchor").select("id", "label", "vector"), scale))
    sizes = [df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] for df, size in (
        (anchors, 8 * F.size("codes")), (blocks, F.octet_length("columns") + 2 * F.octet_length("ids")))]
    # At least as many cells as there are cores, where there are as many blocks.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    groups = parts_for(sizes[0], group_bytes), max(parts_for(sizes[1], group_bytes), min(2 * cores, blocks.count()), 1)

    open_end = anchors.withColumns({"lows": F.array(F.lit(-1 << 63)), "highs": F.array(F.lit((1 << 63) - 1))})
    best = scan_cells(open_end, blocks, groups, n_positives, same_label=True)
    positives = stored(ranked(best, n_positives, "anchor_id").select(
        "anchor_id", F.col("rank").alias("no"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))

    # 100 * score within [low * p, high * p], in whole numbers; windows without a number in them are left out.
    p = F.col("positive_score").cast("decimal(38,0)")
    window = positives.withColumns({"low": F.ceil(p * low / 100).cast("bigint"), "high": F.floor(p * high / 100).cast("bigint")})
    per_anchor = window.where("low <= high").groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("no", "low", "high"))).alias("w"))  # at most n_positives
    windows = anchors.join(per_anchor, "anchor_id").select(
        "anchor_id", "label", "codes", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"), F.col("w.no").alias("nos"))
    numbers = windows.select("anchor_id", F.posexplode("nos").alias("positive_no", "no"))
    hits = scan_cells(windows.drop("nos"), blocks, groups, n_negatives, same_label=False)
    first = ranked(hits, n_negatives, "anchor_id", "positive_no").withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    return first.join(numbers, ["anchor_id", "positive_no"]).join(positives, ["anchor_id", "no"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
