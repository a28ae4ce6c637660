"""One scan for the files of many datasets.

A *part* is the files under one path, which belong to one dataset.  Parts that are read alike share a
scan: a table from file to part, made from the listing of the files, is joined to the rows by the
file they come from, and row numbers begin again with every part.  Schemas and headers come from the
first file of a path, read by the driver without a job, several at a time.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pairloom.operators.joins import BROADCAST_BYTES
from pairloom.sources.positions import READ_ID, START_BYTES, block_counts, most_blocks, text_rows

HEADER_BYTES = 1 << 16  # read at first; a longer header is read in steps twice as long
ROW_KEYS = ("rank", "part", "position")


@dataclass(frozen=True)
class Part:
    """``no`` is the place among the parts of the dataset, or -1 for its only one.  ``columns`` go along
    with every row."""

    rank: int
    path: str
    files: tuple[str, ...]
    no: int = -1
    columns: tuple[int, ...] = ()


def same_file(uri: str) -> str:
    """The way in which a scan writes the path of a file."""
    return re.sub(r"^(\w+):///", r"\1:/", uri)


def listed(df: DataFrame) -> tuple[str, ...]:
    return tuple(sorted(map(same_file, df.inputFiles())))


def flat_files(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """The Parquet files of a path, or None if they lie in folders that Spark must look at itself."""
    files = listed(spark.read.schema("_ string").parquet(path))
    name = path.rstrip("/").rpartition("/")[2]
    plain = all(name in (unquote(f).split("/")[-1], unquote(f).split("/")[-2]) for f in files)
    return files if files and plain else None


# What the driver reads of one file.

def parquet_schemas(spark: SparkSession, files: Iterable[str]) -> dict[str, T.StructType]:
    """The schema of each Parquet file, from its footer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    formats = jvm.org.apache.spark.sql.execution.datasources.parquet
    converter = formats.ParquetToSparkSchemaConverter(spark._jsparkSession.sessionState().conf())

    def read(file: str) -> tuple[str, T.StructType]:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(_path(spark, file), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            message = reader.getFileMetaData().getSchema()
        finally:
            reader.close()
        return file, T.StructType.fromJson(json.loads(converter.convert(message).json()))

    with ThreadPoolExecutor(8) as pool:
        return dict(pool.map(read, dict.fromkeys(files)))


def headers(spark: SparkSession, files: Iterable[tuple[str, str]]) -> dict[str, list[str]]:
    """The names in the first record of each (file, type), tsv or csv."""
    with ThreadPoolExecutor(8) as pool:
        return dict(pool.map(lambda f: (f[0], _header(spark, *f)), dict.fromkeys(files)))


def _path(spark: SparkSession, file: str):
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))


def _header(spark: SparkSession, file: str, file_type: str) -> list[str]:
    size = HEADER_BYTES
    while True:
        head = _first_bytes(spark, file, size)
        text = head.decode("utf-8-sig", "ignore").lstrip("\r\n")
        if file_type == "tsv":
            line, ended, _ = text.replace("\r", "\n").partition("\n")
            names = line.split("\t")
        else:
            ended = re.match(r'(?:[^"\n]|"[^"]*")*\n', text)
            names = next(csv.reader(io.StringIO(text, newline="")), [])
        if ended or len(head) < size:
            return names
        size *= 2


def _first_bytes(spark: SparkSession, file: str, size: int) -> bytes:
    conf, path = spark._jsc.hadoopConfiguration(), _path(spark, file)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        return bytes((codec.createInputStream(stream) if codec else stream).readNBytes(size))
    finally:
        stream.close()


# Scans.

def together(parts: Sequence[Part]) -> list[list[Part]]:
    """The parts in as few groups as there are parts of one file: a scan reads a file for one part only."""
    groups: list[tuple[set[str], list[Part]]] = []
    for part in parts:
        for taken, group in groups:
            if taken.isdisjoint(part.files):
                break
        else:
            groups.append(((taken := set()), (group := [])))
        taken.update(part.files)
        group.append(part)
    return [group for _, group in groups]


def part_table(spark: SparkSession, parts: Sequence[Part], names: Sequence[str] = ()) -> DataFrame:
    """(file, rank, part, names...): one row per file."""
    rows = [(f, p.rank, p.no, *p.columns) for p in parts for f in p.files]
    more = "".join(f", {n} int" for n in names)
    return spark.createDataFrame(rows, f"file string, rank int, part int{more}")


def _numbered(rows: DataFrame, blocks: DataFrame, keys: list[str], parts: DataFrame) -> DataFrame:
    """rows with the columns of their part and ``before``, the rows of the part before their block."""
    # A window over blocks of files, never over rows.
    earlier = Window.partitionBy("rank", "part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.join(F.broadcast(parts), "file") if small(rows) else blocks.join(parts, "file")
    starts = placed.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return rows.join(F.broadcast(starts) if small(rows) else starts, keys)


def small(rows: DataFrame) -> bool:
    return most_blocks(rows) * START_BYTES <= BROADCAST_BYTES


def table_rows(spark: SparkSession, parts: Sequence[Part], schema: T.StructType) -> DataFrame:
    """(rank, part, position, columns...) of Parquet files with one schema; positions run from 0 in each part."""
    rows = spark.read.schema(schema).parquet(*[p.path for p in parts]).select(
        *[F.col(f"`{c}`") for c in schema.names], F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("_row"))
    blocks = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    placed = _numbered(rows, blocks, ["file"], part_table(spark, parts))
    position = (F.col("before") + F.col("_row")).alias("position")
    return placed.select("rank", "part", position, *[F.col(f"`{c}`") for c in schema.names])


def line_rows(spark: SparkSession, parts: Sequence[Part], names: Sequence[str] = (), all_breaks: bool = False) -> DataFrame:
    """(rank, part, position, line, is_first, names...) of text files; ``is_first`` marks the first line of a file."""
    rows = text_rows(spark, [p.path for p in parts], all_breaks)
    placed = _numbered(rows, block_counts(rows), ["file", "block"], part_table(spark, parts, names))
    within = F.col(READ_ID) - F.col("first")
    return placed.where(within < F.col("n")).select(
        "rank", "part", (F.col("before") + within).alias("position"), "line",
        ((F.col("block") == 0) & (within == 0)).alias("is_first"), *names)


def in_scans(parts: Sequence[Part], read: Callable[[list[Part]], DataFrame]) -> list[DataFrame]:
    return [read(group) for group in together(parts)]
