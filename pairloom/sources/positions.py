"""Row numbers of files, computed where the files are read.

Spark tells for every row which file and which block of it the row came from.  Counting
rows per block and adding the counts up gives each block its first row number; the number
inside the block comes from the scan itself.  No row passes through Python or one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pairloom.operators.joins import BROADCAST_BYTES

READ_ID = "_read_id"
START_BYTES = 400  # of one block: a path and three numbers


def most_blocks(rows: DataFrame) -> int:
    """No scan has more blocks: whole blocks fill a partition each, and every file has at most
    one shorter block at its end.  Known from the listing of the files, without a job."""
    return rows.rdd.getNumPartitions() + len(rows.inputFiles())


def _with_offsets(rows: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """rows joined to the number of rows that lie before their block."""
    # A window over blocks (one row per file split), never over rows.
    earlier = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    if most_blocks(rows) * START_BYTES <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    return rows.join(starts, keys)


# The characters beyond \n and \r at which a strict line reader breaks lines, too.
FURTHER_BREAKS = "[\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029\\r]"


def text_rows(spark: SparkSession, path: str | list[str], all_breaks: bool = False) -> DataFrame:
    """(line, file, block, read id) of text files, and with ``all_breaks`` what ``block_counts`` needs beside.

    Lines end at \\n, \\r\\n or \\r.  With ``all_breaks`` each is split at the further characters in the scan
    itself, before its parts are numbered, so parts count like lines.
    """
    places = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    # Consecutive inside a block: a block is read by one task, front to back.
    number = F.monotonically_increasing_id().alias(READ_ID)
    if not all_breaks:
        return spark.read.text(path).select(F.col("value").alias("line"), *places, number)
    raw = spark.read.option("lineSep", "\n").text(path).select("value", *places, F.col("_metadata.file_size").alias("_size"))
    bare = F.when(F.endswith("value", F.lit("\r")), F.left("value", F.length("value") - 1)).otherwise(F.col("value"))
    # A break that ends a line which nothing else ends starts no further one.
    open_end = F.col("value").rlike(FURTHER_BREAKS + "$(?!\\n)") & ~F.endswith("value", F.lit("\r"))
    parts = raw.select("file", "block", "_size", F.octet_length("value").alias("_bytes"), open_end.alias("_open"),
                       F.posexplode(F.split(bare, FURTHER_BREAKS, -1)).alias("_part", "line"))
    whole = F.when(F.col("_part") == 0, F.col("_bytes"))
    return parts.select("line", "file", "block", "_size", whole.alias("_bytes"), "_open", number)


def block_counts(rows: DataFrame) -> DataFrame:
    """(file, block, n, first) of rows from ``text_rows``: their number, and the read id of the first.

    The last part of a file that ends with a further break, and not with the end of a line, is no
    line: it is the empty text behind that break, and ``n`` leaves it out.  Whether a line end
    comes last shows in the size of the file, but not in that of a compressed one.
    """
    counts = [F.count(F.lit(1)).alias("n"), F.min(READ_ID).alias("first")]
    if "_open" not in rows.columns:
        return rows.groupBy("file", "block").agg(*counts)
    last = F.max_by("_open", READ_ID).alias("_open")
    blocks = rows.groupBy("file", "block").agg(
        *counts, last, F.count("_bytes").alias("_lines"), F.sum("_bytes").alias("_bytes"), F.max("_size").alias("_size"))
    of_file = Window.partitionBy("file")
    rest = F.max("_size").over(of_file) - F.sum("_bytes").over(of_file) - F.sum("_lines").over(of_file)
    unended = rest.isin(-1, 2)  # 2: a byte order mark has three bytes, which no line has
    is_last = F.col("block") == F.max("block").over(of_file)
    return blocks.select("file", "block", F.when(unended & is_last & F.col("_open"), F.col("n") - 1).otherwise(F.col("n")).alias("n"), "first")


def numbered_lines(spark: SparkSession, path: str | list[str], all_breaks: bool = False) -> DataFrame:
    """(position, line) of text files, files in order of their path, lines from 0.

    Lines end at \\n, \\r\\n or \\r.  ``all_breaks`` also splits them at the further characters some line
    readers know, which can shift one side of an aligned pair of files against the other.
    """
    rows = text_rows(spark, path, all_breaks)
    blocks = block_counts(rows)
    placed = _with_offsets(rows, blocks.withColumns({"_n": F.col("n")}), ["file", "block"])
    within = F.col(READ_ID) - F.col("first")
    return placed.where(within < F.col("n")).select((F.col("_before") + within).alias("position"), "line")


def numbered_rows(spark: SparkSession, path: str | list[str], *columns: str) -> DataFrame:
    """(position, columns...) of Parquet files, files in order of their path, rows from 0."""
    rows = spark.read.parquet(*([path] if isinstance(path, str) else path)).select(
        *[F.col(f"`{c}`") for c in columns],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    placed = _with_offsets(rows, files, ["_file"])
    position = F.col("_before") + F.col("_row")
    return placed.select(position.alias("position"), *[F.col(f"`{c}`") for c in columns])
