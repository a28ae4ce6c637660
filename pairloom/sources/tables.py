"""Sentence pairs in tables: delimited text, flat, nested and two-table layouts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pairloom.functions.fixed_values import NULL_WORDS
from pairloom.sources.alignment import alignment_report, require_aligned, zip_sides
from pairloom.sources.positions import _with_offsets, numbered_rows
from pairloom.sources.quoted_records import read_records

BAD = "_corrupt_record"
KEPT = ("rank", "position", "split_rank", "split")  # columns that stay beside the texts


def _header(spark: SparkSession, path: str, separator: str, quoted: bool) -> list[str]:
    reader = spark.read.option("header", True).option("sep", separator).option("inferSchema", False)
    reader = reader.option("quote", '"' if quoted else "").option("escape", '"' if quoted else "\\")
    return reader.option("multiLine", quoted).csv(path).columns


def read_table(
    spark: SparkSession,
    path: str,
    src_col: str,
    tgt_col: str,
    file_type: str = "tsv",
    legacy_null_strings: bool = False,
    line_breaks: bool = True,
    whole_files: bool = False,
) -> DataFrame:
    """(position, src, tgt) of a delimited file with a header.

    tsv: no quoting; a row with too many fields is dropped, one with too few is kept with
    nulls.  csv: quoted fields, which may span lines; a row with too many fields fails.  Files
    are read in pieces; quotes must then stand around fields, or in pairs within a line.  Others
    are read one file a task with ``whole_files``.  A file known to have no line breaks inside
    fields takes fewer scans with ``line_breaks=False``.
    Null words become null, or with ``legacy_null_strings`` the texts "nan" and, for a field
    the row does not have, "None".
    """
    if file_type not in ("tsv", "csv"):
        raise ValueError(f"file type {file_type!r}: expected tsv or csv")
    names = _header(spark, path, "\t" if file_type == "tsv" else ",", file_type == "csv")
    for name in (src_col, tgt_col):
        if name not in names:
            raise ValueError(f"{path} has no column {name!r}")
    if file_type == "tsv":
        rows = _read_tsv(spark, path, names)
    else:
        read = _read_csv if whole_files else _read_csv_records if line_breaks else _read_csv_lines
        rows = read(spark, path, names)
    texts = {
        "src": null_words(F.col("fields")[names.index(src_col)], legacy_null_strings),
        "tgt": null_words(F.col("fields")[names.index(tgt_col)], legacy_null_strings),
    }
    return rows.select("position", *[value.alias(name) for name, value in texts.items()])


def null_words(value: Column, legacy: bool) -> Column:
    if legacy:
        return F.when(value.isNull(), "None").when(value.isin(*NULL_WORDS), "nan").otherwise(value)
    return F.when(~value.isin(*NULL_WORDS), value)


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with their ``position`` among the rows of all files; ``_first`` is the id of the
    first row of the block."""
    blocks = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_read_id").alias("_first"))
    placed = _with_offsets(rows, blocks, keys)
    return placed.withColumn("position", F.col("_before") + F.col("_read_id") - F.col("_first"))


def _data_lines(spark: SparkSession, path: str) -> DataFrame:
    """(position, value) of the lines that are neither empty nor the header of a file."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_read_id"),
    )
    is_header = (F.col("_block") == 0) & (F.col("_read_id") == F.col("_first"))
    return _numbered(lines, ["_file", "_block"]).where((F.col("value") != "") & ~is_header).select("position", "value")


def _read_tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Without quoting a row is a line, so the line reader gives rows and positions, and
    splitting shows how many fields there really are."""
    fields = _data_lines(spark, path).select("position", F.split("value", "\t").alias("fields"))
    padded = F.transform(
        F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda i: F.get("fields", i)
    )
    return fields.where(F.size("fields") <= len(names)).select("position", padded.alias("fields"))


def _csv_schema(n: int) -> T.StructType:
    return T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(n)] + [T.StructField(BAD, T.StringType())])


def _csv_fields(row: str, n: int) -> Column:
    """The fields of a parsed row, whose columns are behind the prefix ``row``.  Rows that are
    too short are legal (their fields are null); too long ones are not."""
    bad = F.col(f"{row}{BAD}")
    quoted_out = F.regexp_replace(bad, F.lit(r'(?s)"(?:[^"]|"")*"'), F.lit(""))
    too_long = F.size(F.split(quoted_out, ",")) > n
    return F.when(
        bad.isNotNull() & too_long,
        F.raise_error(F.concat(F.lit("row with too many fields: "), bad)).cast("array<string>"),
    ).otherwise(F.array(*[F.col(f"{row}_{i}") for i in range(n)]))


def _read_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A file is one unit of reading, whatever its quotes."""
    reader = spark.read.schema(_csv_schema(len(names))).option("header", True).option("quote", '"').option("escape", '"')
    rows = reader.option("multiLine", True).option("enforceSchema", True).option("columnNameOfCorruptRecord", BAD).csv(path)
    read = rows.select(
        _csv_fields("", len(names)).alias("fields"),
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_read_id"),
    )
    return _numbered(read, ["_file"]).select("position", "fields")


def _read_csv_lines(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """No field holds a line break, so a file is read in as many pieces as it has blocks."""
    return parsed_records(_data_lines(spark, path).select("position", closed_line(F.col("value")).alias("record")), len(names))


def _read_csv_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Quoted fields may hold line breaks; a file is read in as many pieces as it has blocks."""
    return parsed_records(read_records(spark, path), len(names))


def closed_line(line: Column) -> Column:
    """The line; one in which a quote stays open breaks the promise that no field has a line break, and fails."""
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    failed = F.raise_error(F.concat(F.lit("quote left open in line: "), line)).cast("string")
    return F.when(quotes % 2 == 1, failed).otherwise(line)


def parsed_records(records: DataFrame, n: int) -> DataFrame:
    """The column ``record``, text of a csv record of ``n`` fields, replaced by ``fields``."""
    options = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": BAD, "multiLine": "true"}
    schema = ", ".join(f"{name} string" for name in _csv_schema(n).names)
    kept = [c for c in records.columns if c != "record"]
    rows = records.select(*kept, F.from_csv("record", schema, options).alias("row"))
    return rows.select(*kept, _csv_fields("row.", n).alias("fields"))


def select_flat(
    df: DataFrame, src_col: str, tgt_col: str, filter_param: Mapping[str, object] | None = None
) -> DataFrame:
    """df with the two columns as src and tgt, behind the columns kept from ``df``.

    Only the first entry of ``filter_param`` is used; a column the table lacks counts as
    null, so it matches only None.
    """
    if filter_param:
        key, value = next(iter(filter_param.items()))
        column = F.col(f"`{key}`") if key in df.columns else F.lit(None)
        df = df.where(column.isNull() if value is None else column == F.lit(value))
    return df.select(
        *[c for c in KEPT if c in df.columns],
        F.col(f"`{src_col}`").alias("src"),
        F.col(f"`{tgt_col}`").alias("tgt"),
    )


def select_nested(df: DataFrame, column: str, src_key: str, tgt_key: str) -> DataFrame:
    """Two keys of a map or struct column.  A struct must have both; a key missing from a
    map, or a null, gives null, which the rule filter drops."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        missing = {src_key, tgt_key} - set(kind.names)
        if missing:
            raise ValueError(f"{column} has no key {sorted(missing)}")
        src, tgt = F.col(f"`{column}`").getField(src_key), F.col(f"`{column}`").getField(tgt_key)
    elif isinstance(kind, T.MapType):
        src, tgt = F.try_element_at(F.col(f"`{column}`"), F.lit(src_key)), F.try_element_at(F.col(f"`{column}`"), F.lit(tgt_key))
    else:
        raise ValueError(f"{column} is neither a map nor a struct")
    kept = [c for c in KEPT if c in df.columns]
    return df.select(*kept, src.alias("src"), tgt.alias("tgt"))


def read_dual(
    spark: SparkSession, src_path: str, tgt_path: str, column: str, strict: bool = True
) -> DataFrame:
    """(position, src, tgt): the same column of two Parquet tables, row beside row."""
    src = numbered_rows(spark, src_path, column).withColumnRenamed(column, "src")
    tgt = numbered_rows(spark, tgt_path, column).withColumnRenamed(column, "tgt")
    if strict:
        name = F.lit(src_path).alias("dataset")
        require_aligned(alignment_report(src.select(name), tgt.select(name)))
    return zip_sides(src, tgt)


def union_splits(splits: Mapping[str, DataFrame], expression: str) -> DataFrame:
    """"dev+devtest" -> the named splits one after the other, with their rank and name."""
    parts = []
    for rank, name in enumerate(expression.split("+")):
        if name not in splits:
            raise ValueError(f"no split {name!r} in {sorted(splits)}")
        parts.append(splits[name].withColumns({"split_rank": F.lit(rank), "split": F.lit(name)}))
    return reduce(lambda a, b: a.unionByName(b), parts)
