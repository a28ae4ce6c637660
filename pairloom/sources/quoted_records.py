"""Records of quoted files whose fields may hold line breaks, read in as many pieces as a file has blocks.

A line break ends a record only outside quotes, so whether a line starts a record depends on the
number of quotes in the file before it: even is outside.  Each block counts its quotes, and its
record starts for both cases, as it does not know yet which holds (first scan).  A running sum over
blocks tells each block its case, and the numbers of its records.  Then every block joins the lines
of its records (second scan).  A record that goes on over the end of a block comes as fragments, at
most two per block, which are found by a third scan of the blocks concerned and put together.

That counts every quote, as is right where quotes stand around fields and twice inside them.  A
quote within an unquoted field would turn inside and outside round: the record of several lines that
it gives is not well-formed, and is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pairloom.operators.joins import BROADCAST_BYTES
from pairloom.session import cut_lineage
from pairloom.sources.positions import START_BYTES, most_blocks

QUOTE = '"'
SUMMARY = "file string, block bigint, quotes bigint, starts_outside bigint, starts_inside bigint"
PIECES = "owner bigint, record bigint, part bigint, piece string"

_SUMMARY_ARROW = pa.schema([("file", pa.string()), ("block", pa.int64()), ("quotes", pa.int64()),
                            ("starts_outside", pa.int64()), ("starts_inside", pa.int64())])
_PIECES_ARROW = pa.schema([("owner", pa.int64()), ("record", pa.int64()), ("part", pa.int64()), ("piece", pa.string())])


def well_formed(separator: str) -> str:
    """The pattern of a record: fields in quotes, or without any."""
    other = r"\x{%x}" % ord(separator)
    field = rf'(?:"(?:[^"]|"")*"|[^"{other}]*)'
    return rf"^(?s:{field}(?:{other}{field})*)\r?$"


def _segments(batch: pa.RecordBatch, *keys: int) -> Iterator[tuple[int, int]]:
    """(start, end) of neighbouring rows with equal keys."""
    if not batch.num_rows:
        return
    changes = np.zeros(batch.num_rows - 1, bool)
    for k in keys:
        column = batch.column(k)
        changes |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
    yield from zip(edges, edges[1:])


def _quotes_before(lines: pa.Array) -> tuple[np.ndarray, int]:
    """The number of quotes before each line, and in all."""
    counts = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False).astype(np.int64)
    running = np.cumsum(counts)
    return running - counts, int(running[-1])


def _filled(lines: pa.Array) -> np.ndarray:
    return pc.invert(pc.is_in(lines, pa.array(["", "\r"]))).to_numpy(zero_copy_only=False)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: rows (file, block, value) of a block come one after the other."""
    now, counts = None, [0, 0, 0]
    for batch in batches:
        out = []
        for start, end in _segments(batch, 0, 1):
            key = batch.column(0)[start].as_py(), batch.column(1)[start].as_py()
            if key != now:
                if now is not None:
                    out.append((*now, *counts))
                now, counts = key, [0, 0, 0]
            lines = batch.column(2).slice(start, end - start)
            before, quotes = _quotes_before(lines)
            inside = (before + counts[0]) % 2 == 1
            filled = _filled(lines)
            counts = [counts[0] + quotes, counts[1] + int((filled & ~inside).sum()), counts[2] + int((filled & inside).sum())]
        if out:
            yield _batch(out, _SUMMARY_ARROW)
    if now is not None:
        yield _batch([(*now, *counts)], _SUMMARY_ARROW)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)


def _pieces(pattern: str, fragments: bool):
    """Rows (file_no, block, inside, first, base, value, owner) -> the records that lie in one block, or the
    ``fragments`` of the others, which have the block as ``part``.

    ``first`` is the number in its file of the first record that starts in the block, ``base`` what is
    added to it; the header, which has 0, gets a number below 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None  # (file, block) that is read
        quotes = number = base = owner = 0
        open_lines: list[str] = []  # of the record that is not ended yet
        since_head = True  # no record has started in the block: the lines belong to one before it

        def part(ended: bool) -> list[tuple]:
            whole = ended and not since_head
            if whole == fragments or not open_lines or number == 0:
                return []
            return [(owner, base + number, now[1], "\n".join(open_lines))]

        for batch in batches:
            out: list[tuple] = []
            for start, end in _segments(batch, 0, 1):
                key = batch.column(0)[start].as_py(), batch.column(1)[start].as_py()
                if key != now:
                    if now is not None:
                        out += part(quotes % 2 == 0)
                    inside, first, base, owner = (batch.column(k)[start].as_py() for k in (2, 3, 4, 6))
                    now, open_lines, since_head, quotes, number = key, [], True, int(inside), first - 1
                lines = batch.column(5).slice(start, end - start)
                before, total = _quotes_before(lines)
                inside, filled = (before + quotes) % 2 == 1, _filled(lines)
                quotes += total
                starts, kept = np.flatnonzero(filled & ~inside), np.flatnonzero(filled | inside)
                if not len(starts):
                    open_lines += lines.take(pa.array(kept)).to_pylist()
                    continue
                head = kept[: np.searchsorted(kept, starts[0])]
                open_lines += lines.take(pa.array(head)).to_pylist()
                out += part(True)
                body = kept[len(head):]
                offsets = np.searchsorted(body, starts).astype(np.int32)
                # The last record may go on in the next rows.
                if not fragments:
                    closed = pa.ListArray.from_arrays(pa.array(offsets), lines.take(pa.array(body[:offsets[-1]])))
                    records = pc.binary_join(closed, "\n")
                    _require(records.filter(pc.greater(pc.list_value_length(closed), 1)), pattern)
                    numbers = np.arange(number + 1, number + len(starts))
                    numbers = pa.array(np.where(numbers == 0, -1, numbers + base), pa.int64())
                    owners = pa.array(np.full(len(records), owner))
                    yield pa.RecordBatch.from_arrays([owners, numbers, pa.nulls(len(records), pa.int64()), records], schema=_PIECES_ARROW)
                number += len(starts)
                open_lines, since_head = lines.take(pa.array(body[offsets[-1]:])).to_pylist(), False
            if out:
                yield checked(out)
        if now is not None and (out := part(quotes % 2 == 0)):
            yield checked(out)

    def checked(rows: list[tuple]) -> pa.RecordBatch:
        batch = _batch(rows, _PIECES_ARROW)
        if not fragments:
            _require(batch.column(3).filter(pc.match_substring(batch.column(3), "\n")), pattern)
        return batch

    return run


def _require(records: pa.Array, pattern: str) -> None:
    bad = records.filter(pc.invert(pc.match_substring_regex(records, pattern)))
    if len(bad):
        raise ValueError(f"quote inside an unquoted field, or left open: {bad[0].as_py()[:300]!r}; read such files as a whole")


def read_records(spark: SparkSession, path: str | list[str], separator: str = ",", owners: DataFrame | None = None) -> DataFrame:
    """(position, record): the records of all files, in order of their paths, without the first of each file.

    Records end at \\n or \\r\\n outside quotes; empty ones are left out.  Positions run from 0.
    With ``owners``, a table (file, owner), each owner's files have positions of their own, beside a column ``owner``.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    blocks = cut_lineage(_placed(lines.mapInArrow(_summaries, SUMMARY), owners))
    if most_blocks(lines) * START_BYTES <= BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    known = lines.join(blocks, ["file", "block"])
    rows = ["file_no", "block", "inside", "first", "base", "value", "owner"]
    pattern = well_formed(separator)
    whole = known.select(*rows).mapInArrow(_pieces(pattern, False), PIECES)
    broken = known.where("inside OR leaves_open").select(*rows).mapInArrow(_pieces(pattern, True), PIECES)

    @F.arrow_udf("string")
    def checked(records: pa.Array) -> pa.Array:
        _require(records, pattern)
        return records

    # As many fragments as the record has blocks.
    parts = F.array_sort(F.collect_list(F.struct("part", "piece")))
    whole_piece = F.array_join(F.transform(parts, lambda p: p["piece"]), "\n").alias("piece")
    joined = broken.where("record >= 0").groupBy("owner", "record").agg(whole_piece)
    records = whole.select("owner", "record", "piece").unionByName(joined.select("owner", "record", checked("piece").alias("piece")))
    named = [] if owners is None else ["owner"]
    return records.where("record >= 0").select(
        *named, F.col("record").alias("position"), _without_return(F.col("piece")).alias("record"))


def _without_return(record: Column) -> Column:
    return F.when(F.endswith(record, F.lit("\r")), F.left(record, F.length(record) - 1)).otherwise(record)


def _placed(summaries: DataFrame, owners: DataFrame | None) -> DataFrame:
    """Blocks with whether they begin ``inside`` quotes, whether they leave a record open, the number in
    the file of the ``first`` record that starts in them, and the ``base`` of the file's numbers.

    Windows over blocks and over files, never over rows.  The first record of a file is its header.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("quotes").over(earlier), F.lit(0))
    cased = summaries.withColumn("inside", before % 2 == 1)
    cased = cased.withColumn("starts", F.when(F.col("inside"), F.col("starts_inside")).otherwise(F.col("starts_outside")))
    numbered = cased.withColumn("first", F.coalesce(F.sum("starts").over(earlier), F.lit(0)))
    files = numbered.groupBy("file").agg(F.greatest(F.sum("starts") - 1, F.lit(0)).alias("n"))
    files = files.withColumn("owner", F.lit(0).cast("bigint")) if owners is None else files.join(owners, "file")
    by_path = Window.partitionBy("owner").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(by_path), F.lit(0)) - 1
    files = files.select("file", "owner", base.alias("base"), F.row_number().over(Window.orderBy("file")).alias("file_no"))
    leaves_open = (F.col("inside").cast("int") + F.col("quotes")) % 2 == 1
    return numbered.join(files, "file").select(
        "file", "file_no", "owner", "block", "inside", leaves_open.alias("leaves_open"), "first", "base")
