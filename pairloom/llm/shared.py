"""Helpers of the operators in this folder: reading, shared storage, keys and sizes."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# ``stored`` cuts lineage: later steps read files, so a lost executor costs no recomputation,
# and ids that depend on partitioning keep their values.
from pairloom.session import cut_lineage as stored, small_batches, staging_folder as shared_folder  # noqa: F401
from pairloom.sources.spread import spread_small_input

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of words: digits, a-z, everything outside ASCII.  The rest separates words.
WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_small_input(df, df.columns[0])


def words_of(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text with A-Z lower-cased; null has none."""
    return (text or b"").lower().translate(WORD_BYTES).split()


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def stored_by_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` written once to shared storage in buckets of ``key``: a later join on ``key`` reads
    them where they lie, without shuffling this side."""
    spark = df.sparkSession
    path = shared_folder(spark)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    name = f"pairloom_{path.rpartition('/')[2]}"
    df.write.option("path", f"{path}/table").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def text_key(text: Column) -> Column:
    """Equal for equal texts (null counts as empty), 128 bits and the length."""
    text = F.coalesce(text, F.lit(""))
    return F.concat_ws(":", F.md5(text.cast("binary")), F.octet_length(text))


def parts_for(total_bytes: int, each: int = 16 << 20) -> int:
    return max(1, -(-total_bytes // each))


def batches(rows: Iterator, size: int) -> Iterator[list]:
    block = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block
