"""Lines that stand in several documents, found through levelled sorted runs of line hashes.

A *run* is a part of a bucketed table, sorted by the 128-bit hash of a line's key: one row per key
with the number of documents that hold it (counted up to ``least_docs``) and the largest id among
them.  Each new batch of documents is summed up to such rows, merge-anti-joins the runs of every
level, and adds what is left as its own run to level 0.  The anti join takes away the rows that can
change nothing: keys already found in enough documents, with an id at least as large.  When a level
has ``fanout`` runs they are merged into one run of the next level.  Runs lie in the buckets of
their hash, so neither the anti join nor a merge shuffles them; a batch is shuffled once, after it
was summed up where it was read.

At the end the levels are merged, and the keys with enough documents are looked up by every line.

Everything here is DataFrame functions.  The order of batches does not change the result.

Each row is a document of its own: repeated rows count as often as they stand there.  A null text
is one empty line.  A null id is smaller than any other; of documents that share the largest id, all
keep the line.  Further columns of ``docs`` stay as they are, but for those named like the results.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairloom.llm.shared import ASCII_LOWER, ASCII_UPPER, shared_folder, stored, text_key
from pairloom.operators.joins import BROADCAST_BYTES, fits_broadcast, lookup_join

LEAST_CHARS = 20
LEAST_DOCS = 3
FANOUT = 4
BATCHES = 6
BLANK = " \t\n\x0b\x0c\r"
HASH = ["__llm_h1", "__llm_h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """Blanks off both ends, A-Z lower-cased; ASCII lines, where ``lower`` does just that, take the short way."""
    bare = F.btrim(line, F.lit(BLANK))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, ASCII_UPPER, ASCII_LOWER))


def with_hash(keyed: DataFrame, least_chars: int) -> DataFrame:
    """Rows whose ``__llm_key`` has at least ``least_chars`` code points, with its hash in its place."""
    long = keyed.where(F.length("__llm_key") >= least_chars)
    hashed = long.withColumns({HASH[0]: F.xxhash64("__llm_key"), HASH[1]: F.xxhash64(F.lit("second"), "__llm_key")})
    return hashed.drop("__llm_key")


class LineRuns:
    """The runs of all batches added so far; close it to remove them."""

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS, fanout: int = FANOUT) -> None:
        self.spark, self.least_docs, self.least_chars, self.fanout = spark, least_docs, least_chars, fanout
        # As many buckets as a shuffle has partitions: the summed-up batch meets them where it lies.
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name, self.folder = f"line_runs_{uuid.uuid4().hex}", shared_folder(spark)
        self.runs: list[int] = []  # per level
        self.made = 0  # tables so far: a level that is filled again gets a new one
        self.tables: dict[int, str] = {}

    def _summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*HASH).agg(
            F.least(F.sum("n"), F.lit(self.least_docs).cast("bigint")).alias("n"), F.max("keeper").alias("keeper"))

    def _append(self, run: DataFrame, level: int) -> None:
        if level == len(self.runs):
            self.runs.append(0)
        if level not in self.tables:
            self.made += 1
            self.tables[level] = f"{self.name}_{self.made}"
        name = self.tables[level]
        writer = run.write.mode("append").format("parquet").option("path", f"{self.folder}/{name}")
        writer.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name)
        self.runs[level] += 1

    def _drop(self, level: int) -> None:
        name = self.tables.pop(level)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.runs[level] = 0

    def compact(self, level: int) -> None:
        """All runs of a level become one run of the next."""
        self._append(self._summed(self.spark.table(self.tables[level])), level + 1)
        self._drop(level)

    def add(self, batch: DataFrame, doc_id: str, text: str) -> None:
        # Every key once per document, so that counting rows counts documents.
        keys = F.array_distinct(F.transform(lines_of(F.col(f"`{text}`")), line_key))
        rows = batch.select(F.col(f"`{doc_id}`").alias("keeper"), F.lit(1).alias("n"), F.explode(keys).alias("__llm_key"))
        new = self._summed(with_hash(rows, self.least_chars))
        for level in sorted(self.tables):
            new = self._not_in(new, self.spark.table(self.tables[level]))
        self._append(new, 0)
        level = 0
        while self.runs[level] >= self.fanout:
            self.compact(level)
            level += 1

    def _not_in(self, new: DataFrame, runs: DataFrame) -> DataFrame:
        settled = runs.where(F.col("n") >= self.least_docs).hint("merge").alias("runs")
        same = [F.col(f"new.{h}") == F.col(f"runs.{h}") for h in HASH]
        return new.alias("new").join(settled, [*same, F.col("runs.keeper") >= F.col("new.keeper")], "left_anti")

    def settled(self) -> DataFrame:
        """(hash, keeper) of the keys in enough documents, stored; all runs are merged for it."""
        for level in range(len(self.runs) - 1):
            if self.runs[level]:
                self.compact(level)
        merged = self._summed(self.spark.table(self.tables[max(self.tables)]))
        return stored(merged.where(F.col("n") >= self.least_docs).select(*HASH, "keeper"))

    def close(self) -> None:
        for level in list(self.tables):
            self._drop(level)


def repeated_lines(batches: Sequence[DataFrame], doc_id: str, text: str, least_docs: int = LEAST_DOCS,
                   least_chars: int = LEAST_CHARS, fanout: int = FANOUT) -> DataFrame:
    """(hash, keeper) of every line key in at least ``least_docs`` documents of all ``batches``."""
    runs = LineRuns(batches[0].sparkSession, least_docs, least_chars, fanout)
    try:
        for batch in batches:
            runs.add(batch, doc_id, text)
        return runs.settled()
    finally:
        runs.close()


def drop_lines(docs: DataFrame, doc_id: str, text: str, settled: DataFrame, least_chars: int = LEAST_CHARS,
               limit: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept``: each text without the lines whose key is in
    ``settled`` under a larger id.

    Lines are looked up as hashes; the texts meet only the places of their own dropped lines.
    """
    doc, body = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    # Rows with the same id and text lose the same lines.
    keyed = docs.withColumn("__llm_of", F.concat_ws("/", F.coalesce(doc.cast("string"), F.lit("-")), text_key(body)))
    lines = keyed.select("__llm_of", doc.alias("__llm_doc"), F.posexplode(lines_of(body)).alias("__llm_pos", "__llm_line"))
    hashed = with_hash(lines.withColumn("__llm_key", line_key(F.col("__llm_line"))).drop("__llm_line"), least_chars)
    found = hashed.select("__llm_of", "__llm_doc", "__llm_pos", F.struct(*HASH).alias("__llm_hash"))
    known = settled.select(F.struct(*HASH).alias("__llm_hash"), F.col("keeper").alias("__llm_keeper"))
    met = lookup_join(found, known, "__llm_hash", "__llm_hash", "inner", small=fits_broadcast(settled, limit))
    later = F.coalesce(F.col("__llm_doc") < F.col("__llm_keeper"), F.col("__llm_keeper").isNotNull())
    drops = stored(met.where(later).groupBy("__llm_of").agg(F.array_sort(F.collect_set("__llm_pos")).alias("__llm_drops")))
    joined = lookup_join(keyed, drops, "__llm_of", "__llm_of", "left", limit)
    dropped = F.when(F.col("__llm_drops").isNull(), 0).otherwise(F.size("__llm_drops"))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")]
    whole = F.coalesce(body, F.lit(""))
    n_lines = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    return joined.select(
        *others, n_lines.cast("bigint").alias("n_lines"), dropped.cast("bigint").alias("n_dropped"),
        F.when(dropped == 0, whole).otherwise(_without(lines_of(body), F.col("__llm_drops"))).alias("kept"))


def _without(lines: Column, drops: Column) -> Column:
    """The lines but those at the sorted places ``drops``, joined: the slices between them, in one pass."""
    def between(all_lines: Column) -> Column:
        def gap(i: Column) -> Column:
            start = F.coalesce(F.get(drops, i - 1) + 1, F.lit(0))
            end = F.coalesce(F.get(drops, i), F.size(all_lines))
            return F.slice(all_lines, start + 1, end - start)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(drops)), gap)), "\n")

    # The lambda names the lines, so that the text is split once and not for every gap.
    return F.element_at(F.transform(F.array(lines), between), 1)


def file_batches(spark: SparkSession, path: str, batches: int = BATCHES) -> list[DataFrame]:
    """The files of a Parquet folder in up to ``batches`` parts of equally many files, the last files
    first: where ids grow with the files, a settled key then meets only smaller ids."""
    whole = spark.read.parquet(path)
    files = sorted(map(unquote, whole.inputFiles()), reverse=True)
    size = max(1, -(-len(files) // batches))
    parts = [files[i:i + size] for i in range(0, len(files), size)]
    return [spark.read.schema(whole.schema).parquet(*part) for part in parts] or [whole]
