"""Writing pairs, line-aligned text, metadata and summaries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from pairloom.functions.fixed_values import SUMMARY_HEADER
from pairloom.model import PAIR_SCHEMA, columns_except
from pairloom.plans.stages import COUNTS

FORMATS = ("parquet", "text")


def check_format(save_format: str) -> None:
    if save_format not in FORMATS:
        raise ValueError(f"unknown output format {save_format!r}, expected one of {FORMATS}")


def _empty_partitions(spark: SparkSession, folders: Iterable[str]) -> None:
    jvm = spark._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _without_rows(df: DataFrame, datasets: Sequence[str]) -> list[str]:
    """Folder names of those ``datasets`` that have no row in ``df``: as many as the catalog has at most."""
    present = {r.dataset for r in df.select("dataset").distinct().collect()} if datasets else set()
    escape = df.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return [escape(d) for d in datasets if d not in present]


def write_pairs(df: DataFrame, root: str, src_lang: str, tgt_lang: str, datasets: Sequence[str] = ()) -> None:
    """Parquet under root/lang_pair=../dataset=.., text columns named by language.  Only the
    datasets present in ``df`` are replaced, and those of ``datasets`` that have no row are emptied.

    The rebalance step gathers a small dataset into few files and splits a huge one over
    many tasks.
    """
    named = df.withColumnsRenamed({"src": src_lang, "tgt": tgt_lang})
    placed = named.withColumn("lang_pair", F.lit(f"{src_lang}-{tgt_lang}")).hint("rebalance", F.col("dataset"))
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("lang_pair", "dataset").parquet(root)
    pair = f"{root}/lang_pair={src_lang}-{tgt_lang}"
    _empty_partitions(df.sparkSession, [f"{pair}/dataset={d}" for d in _without_rows(df, datasets)])


def _read_as_text(spark: SparkSession, path: str, *partitions: str) -> DataFrame:
    """Parquet of ``path`` with its partition columns as text: a dataset may be named 007."""
    found = spark.read.parquet(path).schema
    kinds = [T.StructField(f.name, T.StringType()) if f.name in partitions else f for f in found.fields]
    return spark.read.schema(T.StructType(kinds)).parquet(path)


def _as_pairs(stored: DataFrame, src_lang: str, tgt_lang: str) -> DataFrame:
    renamed = stored.withColumnsRenamed({src_lang: "src", tgt_lang: "tgt"})
    rest = columns_except(renamed, "pair_id", "dataset", "src", "tgt", "lang_pair", "run")
    return renamed.select("pair_id", "dataset", "src", "tgt", *rest)


def read_pairs(spark: SparkSession, root: str, src_lang: str, tgt_lang: str) -> DataFrame:
    """The pairs of one language pair, read from its own folder: each pair names its columns itself."""
    return _as_pairs(_read_as_text(spark, f"{root}/lang_pair={src_lang}-{tgt_lang}", "dataset"), src_lang, tgt_lang)


# Runs.  The files of a run lie in a folder of its id and are never replaced.  Its rows in the manifest, written
# last as one file, say which run holds each dataset; readers go by them, so a run that fails leaves
# nothing that anyone reads.


def write_run(df: DataFrame, root: str, src_lang: str, tgt_lang: str, run: str) -> None:
    """Parquet under root/lang_pair=../run=../dataset=.., text columns named by language."""
    named = df.withColumnsRenamed({"src": src_lang, "tgt": tgt_lang})
    placed = named.withColumns({"lang_pair": F.lit(f"{src_lang}-{tgt_lang}"), "run": F.lit(run)})
    placed.hint("rebalance", F.col("dataset")).write.mode("append").partitionBy("lang_pair", "run", "dataset").parquet(root)


def of_runs(stored: DataFrame, runs: Sequence[Row]) -> DataFrame:
    """The rows of ``stored`` (run, dataset, ...) that ``runs`` (dataset_name, run) name: a filter on folders."""
    datasets: dict[str, list[str]] = {}
    for r in runs:
        datasets.setdefault(r.run, []).append(r.dataset_name)
    committed = [(F.col("run") == run) & F.col("dataset").isin(names) for run, names in datasets.items()]
    return stored.where(reduce(lambda x, y: x | y, committed, F.lit(False)))


def read_runs(spark: SparkSession, root: str, src_lang: str, tgt_lang: str, runs: Sequence[Row]) -> DataFrame:
    """The pairs of the datasets that ``runs`` (dataset_name, run) list, as many rows as the catalog has."""
    path = f"{root}/lang_pair={src_lang}-{tgt_lang}"
    if not runs or not folder_exists(spark, path):
        return spark.createDataFrame([], PAIR_SCHEMA)
    return _as_pairs(of_runs(_read_as_text(spark, path, "dataset", "run"), runs), src_lang, tgt_lang)


def read_run_lines(spark: SparkSession, root: str, src_lang: str, tgt_lang: str, runs: Sequence[Row]) -> DataFrame:
    """(lang, dataset, value) of the text files of the datasets that ``runs`` list."""
    path = f"{root}/lang_pair={src_lang}-{tgt_lang}"
    schema = "value string, run string, lang string, dataset string"
    if not runs or not folder_exists(spark, path):
        return spark.createDataFrame([], schema).select("lang", "dataset", "value")
    return of_runs(spark.read.schema(schema).text(path), runs).select("lang", "dataset", "value")


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def remove_unread_runs(spark: SparkSession, root: str, src_lang: str, tgt_lang: str, runs: Sequence[Row], keep: Sequence[str] = ()) -> list[str]:
    """Delete the folders of runs under ``root`` that ``runs`` does not name and ``keep`` (such as runs that
    still go on) does not either; returns their ids."""
    used = {r.run for r in runs} | set(keep)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/lang_pair={src_lang}-{tgt_lang}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    ids = [s.getPath().getName().partition("=") for s in fs.listStatus(folder) if s.isDirectory()]
    gone = sorted(run for name, _, run in ids if name == "run" and run not in used)
    _empty_partitions(spark, [f"{root}/lang_pair={src_lang}-{tgt_lang}/run={run}" for run in gone])
    return gone


def one_line(text: Column | str) -> Column:
    """Line breaks inside a text would shift every later line of its file."""
    return F.translate(text, "\r\n", "  ")


def write_aligned_text(df: DataFrame, root: str, src_lang: str, tgt_lang: str, reject: bool = False,
                       datasets: Sequence[str] = (), run: str | None = None) -> None:
    """Text files under root/lang_pair=<pair>/lang=<code>/dataset=<name>, line i of one side
    belonging to line i of the other.  Datasets are replaced or emptied as in ``write_pairs``.
    With ``run`` they lie in that run's folder below the language pair, and nothing is replaced.

    One sort by (side, dataset, pair_id) and one write serve both sides.  The range
    partitions of the sort spread a large dataset over many files whose names follow the
    order of the rows.  Line breaks inside texts become spaces, or fail with ``reject``.
    """

    def line(side: str) -> Column:
        text = F.coalesce(F.col(side), F.lit(""))
        if reject:
            broken = text.contains("\n") | text.contains("\r")
            return F.when(broken, F.raise_error(F.concat(F.lit("line break in pair "), F.col("pair_id").cast("string"))).cast("string")).otherwise(text)
        return one_line(text)

    sides = F.array(
        F.struct(F.lit(src_lang).alias("lang"), line("src").alias("value")),
        F.struct(F.lit(tgt_lang).alias("lang"), line("tgt").alias("value")),
    )
    rows = df.select("dataset", "pair_id", F.inline(sides)).orderBy("lang", "dataset", "pair_id")
    placed = rows.select(F.lit(f"{src_lang}-{tgt_lang}").alias("lang_pair"), "lang", "dataset", "value")
    if run is not None:
        placed.withColumn("run", F.lit(run)).write.mode("append").partitionBy("lang_pair", "run", "lang", "dataset").text(root)
        return
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("lang_pair", "lang", "dataset").text(root)
    pair, gone = f"{root}/lang_pair={src_lang}-{tgt_lang}", _without_rows(df, datasets)
    _empty_partitions(df.sparkSession, [f"{pair}/lang={c}/dataset={d}" for c in (src_lang, tgt_lang) for d in gone])


def write_metadata(metadata: DataFrame, path: str, mode: str = "append") -> None:
    """Metadata rows as JSON lines, one file per run: the manifest of the next run."""
    metadata.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)


METADATA = "source string, dataset_name string, lang_pair string, {counts}, quality_score double, processed_at timestamp".format(
    counts=", ".join(f"{c} bigint" for c in COUNTS))
#: What a run adds: where its rows are, and whether the dataset was read to its end.
MANIFEST = f"{METADATA}, run string, complete boolean"


def read_metadata(spark: SparkSession, path: str, schema: str = METADATA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def summary_table(summary: DataFrame) -> DataFrame:
    """Eight named columns; the TOTAL row shows "-" for its dataset and its quality."""
    total = F.col("dataset") == "TOTAL"
    values = [
        F.when(total, "TOTAL").otherwise(F.col("source")),
        F.when(total, "-").otherwise(F.col("dataset")),
        *[F.col(c) for c in COUNTS],
        F.when(total, "-").otherwise(F.col("quality_score").cast("string")),
    ]
    return summary.select(*[v.alias(name) for v, name in zip(values, SUMMARY_HEADER)])


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """One row per dataset and the total, so one file."""
    summary_table(summary).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_merged(df: DataFrame, root: str, src_lang: str, tgt_lang: str) -> str:
    path = f"{root}/merged_{src_lang}-{tgt_lang}"
    renamed = df.withColumnsRenamed({"src": src_lang, "tgt": tgt_lang})
    renamed.hint("rebalance").write.mode("overwrite").parquet(path)
    return path
