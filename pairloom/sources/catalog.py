"""The catalog: which datasets exist, in which order, and how each is read."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pairloom.model import POSITION_BITS, SPLIT_BITS, below, ranked_id
from pairloom.sources import scans
from pairloom.sources.alignment import alignment_report, require_aligned, zip_sides
from pairloom.sources.lines import list_files, pick_files, require_found
from pairloom.sources.positions import numbered_rows
from pairloom.sources.quoted_records import read_records
from pairloom.sources.tables import (
    closed_line, null_words, parsed_records, read_dual, read_table, select_flat, select_nested, union_splits,
)

KINDS = ("hf", "opus", "url", "table", "csv", "local")
FORMATS = ("flat_column", "nested_translation", "dual_config")


@dataclass(frozen=True)
class Entry:
    """One dataset.  ``path`` is a staged folder or file; for ``hf`` tables it may also be
    a mapping from split name to path."""

    name: str
    path: str | Mapping[str, str] = ""
    kind: str = "hf"
    format: str = "flat_column"
    split: str = ""
    src_col: str = "src"
    tgt_col: str = "tgt"
    column: str = ""
    src_key: str = ""
    tgt_key: str = ""
    src_path: str = ""
    tgt_path: str = ""
    file_type: str = "tsv"
    strict: bool = True
    legacy_null_strings: bool = False
    line_breaks: bool = True
    whole_files: bool = False
    all_breaks: bool = False
    filter_param: Mapping[str, object] = field(default_factory=dict)


Named = tuple[int, str, Entry]  # rank, dataset, entry


def catalog_table(spark: SparkSession, entries: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per kind with its dataset names in order: the input of ``enumerate_catalog``."""
    return spark.createDataFrame(
        [(kind, list(names)) for kind, names in entries.items()], "kind string, names array<string>"
    )


def enumerate_catalog(catalog: DataFrame, selected: Sequence[str]) -> DataFrame:
    """(dataset_rank order) kind by kind as selected, entry by entry; a selected kind the
    catalog lacks adds nothing."""
    kinds = F.array(*[F.lit(k) for k in selected])
    ranked = catalog.withColumn("kind_no", F.array_position(kinds, F.col("kind")) - 1).where("kind_no >= 0")
    return ranked.select(
        "kind_no", F.posexplode("names").alias("entry_no", "dataset"), F.col("kind").alias("source")
    )


def located(spark: SparkSession, named: Sequence[Named], src_lang: str, tgt_lang: str) -> list[Named]:
    """The entries with the file names of ``opus`` folders filled in: one job for all of them."""
    folders = [(name, entry) for _, name, entry in named if entry.kind == "opus"]
    if not folders:
        return list(named)
    listings = [
        list_files(spark, entry.path).select(
            F.lit(name).alias("name"), "file_name", F.lit(entry.name).alias("entry"),
            F.lit(src_lang).alias("src_lang"), F.lit(tgt_lang).alias("tgt_lang"),
        )
        for name, entry in folders
    ]
    # Two or four values per entry of the catalog.
    found = {r.dataset: r for r in pick_files(_union(listings), named="entry", by="name").collect()}
    placed = []
    for rank, name, entry in named:
        if entry.kind == "opus":
            row = found.get(name)
            require_found(row, entry.name, src_lang, tgt_lang, entry.path)
            entry = replace(entry, kind="local", strict=True,
                            src_path=f"{entry.path}/{row.src_file}", tgt_path=f"{entry.path}/{row.tgt_file}")
        placed.append((rank, name, entry))
    return placed


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


class _Reader:
    """Plans of all entries of a catalog: entries that are read alike share their scans."""

    def __init__(self, spark: SparkSession, named: Sequence[Named]) -> None:
        self.spark, self.named = spark, named
        self.alone: list[DataFrame] = []
        for _, name, entry in named:
            if entry.kind not in ("hf", "url", "local", "table", "csv"):
                raise ValueError(f"{entry.name}: unknown kind {entry.kind!r}, expected one of {KINDS}")
            if entry.kind == "hf" and entry.format not in FORMATS:
                raise ValueError(f"{entry.name}: unknown format {entry.format!r}, expected one of {FORMATS}")
        hub = [n for n in named if n[2].kind == "hf"]
        self._hub_tables([n for n in hub if n[2].format != "dual_config"])
        self._dual_tables([n for n in hub if n[2].format == "dual_config"])
        self._aligned_lines([n for n in named if n[2].kind in ("url", "local")])
        self._delimited([n for n in named if n[2].kind in ("table", "csv")])

    def frames(self) -> list[DataFrame]:
        """(rank, position, src, tgt) of all entries, a plan per layout."""
        return self.alone

    # Parquet.

    def _schemas(self, paths: Sequence[str]) -> dict[str, tuple[tuple[str, ...], T.StructType] | None]:
        """Files and schema of every path; None where Spark has to look at folders itself."""
        files = {path: scans.flat_files(self.spark, path) for path in dict.fromkeys(paths)}
        read = scans.parquet_schemas(self.spark, [f[0] for f in files.values() if f])
        return {path: (f, read[f[0]]) if f else None for path, f in files.items()}

    def _hub_tables(self, named: Sequence[Named]) -> None:
        def parts_of(entry: Entry) -> list[tuple[int, str]]:
            if isinstance(entry.path, str):
                return [(-1, entry.path)]
            names = entry.split.split("+")
            if len(names) > 1 << (POSITION_BITS - SPLIT_BITS):
                raise ValueError(f"{entry.name}: more than {1 << (POSITION_BITS - SPLIT_BITS)} splits")
            for n in names:
                if n not in entry.path:
                    raise ValueError(f"no split {n!r} in {sorted(entry.path)}")
            return [(no, entry.path[n]) for no, n in enumerate(names)]

        known = self._schemas([path for _, _, entry in named for _, path in parts_of(entry)])
        groups: dict[tuple, tuple[Entry, T.StructType, list[scans.Part]]] = {}
        for rank, _, entry in named:
            needed = [entry.column] if entry.format == "nested_translation" else list(
                dict.fromkeys([entry.src_col, entry.tgt_col, *list(entry.filter_param)[:1]]))
            parts = parts_of(entry)
            if any(known[path] is None for _, path in parts):
                self.alone.append(_read_alone(self.spark, entry, needed).withColumn("rank", F.lit(rank)))
                continue
            for no, path in parts:
                files, schema = known[path]
                own = T.StructType([f for f in schema.fields if f.name in needed])
                for c in needed:
                    if c not in own.names and c not in entry.filter_param:
                        raise ValueError(f"{entry.name}: {path} has no column {c!r}")
                way = (entry.format, entry.column, entry.src_key, entry.tgt_key, *needed, *map(repr, list(entry.filter_param.items())[:1]))
                _, _, group = groups.setdefault((*way, own.json()), (entry, own, []))
                group.append(scans.Part(rank, path, files, no))
        for entry, schema, parts in groups.values():
            for rows in scans.in_scans(parts, lambda group, schema=schema: scans.table_rows(self.spark, group, schema)):
                self.alone.append(_picked(_placed(rows), entry))

    def _dual_tables(self, named: Sequence[Named]) -> None:
        known = self._schemas([path for _, _, e in named for path in (e.src_path, e.tgt_path)])
        groups: dict[tuple, dict[str, list[scans.Part]]] = {}
        for rank, name, entry in named:
            sides = {"src": entry.src_path, "tgt": entry.tgt_path}
            if any(known[path] is None for path in sides.values()):
                both = read_dual(self.spark, entry.src_path, entry.tgt_path, entry.column, entry.strict)
                self.alone.append(both.withColumn("rank", F.lit(rank)))
                continue
            own = {}
            for side, path in sides.items():
                own[side] = T.StructType([f for f in known[path][1].fields if f.name == entry.column])
                if not own[side].names:
                    raise ValueError(f"{entry.name}: {path} has no column {entry.column!r}")
            group = groups.setdefault((own["src"].json(), own["tgt"].json(), entry.strict), {"src": [], "tgt": [], "schemas": own})
            for side, path in sides.items():
                group[side].append(scans.Part(rank, path, known[path][0]))
        for (_, _, strict), group in groups.items():
            def side(name: str) -> DataFrame:
                schema = group["schemas"][name]
                read = scans.in_scans(group[name], lambda parts: scans.table_rows(self.spark, parts, schema))
                return _union(read).drop("part").withColumnRenamed(schema.names[0], name)

            self._zipped(side("src"), side("tgt"), strict)

    # Text.

    def _aligned_lines(self, named: Sequence[Named]) -> None:
        ways = {}
        for n in named:
            ways.setdefault((n[2].strict, n[2].all_breaks), []).append(n)
        for (strict, breaks), own in ways.items():
            def side(name: str) -> DataFrame:
                parts = [scans.Part(rank, path := getattr(e, f"{name}_path"), scans.listed(self.spark.read.text(path)))
                         for rank, _, e in own]
                lines = _union(scans.in_scans(parts, lambda group: scans.line_rows(self.spark, group, all_breaks=breaks)))
                return lines.select("rank", "position", F.col("line").alias(name))

            self._zipped(side("src"), side("tgt"), strict)

    def _zipped(self, src: DataFrame, tgt: DataFrame, strict: bool) -> None:
        """Sides paired by rank and position; ``strict`` ones are counted first, all in one job."""
        if strict:
            names = self.spark.createDataFrame([(rank, name) for rank, name, _ in self.named], "rank int, dataset string")
            named = [side.select("rank").join(F.broadcast(names), "rank").select("dataset") for side in (src, tgt)]
            require_aligned(alignment_report(*named))
        self.alone.append(zip_sides(src, tgt, ("rank",)))

    # Delimited text.

    def _delimited(self, named: Sequence[Named]) -> None:
        files = {e.path: scans.listed(self.spark.read.text(e.path)) for _, _, e in named}
        kind = {e.path: "csv" if e.kind == "csv" else e.file_type for _, _, e in named}
        names = scans.headers(self.spark, [(f[0], kind[path]) for path, f in files.items() if f])
        groups: dict[tuple, list[scans.Part]] = {}
        for rank, _, entry in named:
            file_type = "csv" if entry.kind == "csv" else entry.file_type
            if file_type not in ("tsv", "csv"):
                raise ValueError(f"file type {file_type!r}: expected tsv or csv")
            header = names[files[entry.path][0]] if files[entry.path] else []
            for c in (entry.src_col, entry.tgt_col):
                if c not in header:
                    raise ValueError(f"{entry.path} has no column {c!r}")
            if entry.whole_files and file_type == "csv":
                rows = read_table(self.spark, entry.path, entry.src_col, entry.tgt_col, "csv", entry.legacy_null_strings, whole_files=True)
                self.alone.append(rows.withColumn("rank", F.lit(rank)))
                continue
            way = ("tsv",) if file_type == "tsv" else ("csv", len(header), entry.line_breaks)
            at = header.index(entry.src_col), header.index(entry.tgt_col), len(header)
            part = scans.Part(rank, entry.path, files[entry.path], columns=(*at, int(entry.legacy_null_strings)))
            groups.setdefault(way, []).append(part)
        for way, parts in groups.items():
            self.alone.extend(scans.in_scans(parts, lambda group, way=way: self._fields(way, group)))

    def _fields(self, way: tuple, parts: Sequence[scans.Part]) -> DataFrame:
        columns = ("src_at", "tgt_at", "width", "legacy")
        if way[0] == "csv" and way[2]:
            owners = scans.part_table(self.spark, parts, columns)
            records = read_records(self.spark, [p.path for p in parts], owners=owners.select("file", F.col("rank").cast("bigint").alias("owner")))
            of_rank = F.broadcast(owners.select(F.col("rank").cast("bigint").alias("owner"), "rank", *columns).distinct())
            rows = parsed_records(records.join(of_rank, "owner"), way[1])
        else:
            lines = scans.line_rows(self.spark, parts, columns).where((F.col("line") != "") & ~F.col("is_first"))
            if way[0] == "tsv":
                rows = lines.withColumn("fields", F.split("line", "\t")).where(F.size("fields") <= F.col("width"))
            else:
                rows = parsed_records(lines.withColumn("record", closed_line(F.col("line"))), way[1])

        def text(at: str) -> Column:
            value = F.get("fields", at)
            return F.when(F.col("legacy") == 1, null_words(value, True)).otherwise(null_words(value, False))

        return rows.select("rank", "position", text("src_at").alias("src"), text("tgt_at").alias("tgt"))


def _placed(rows: DataFrame) -> DataFrame:
    """Positions in the dataset: splits follow one another, the place of the split above the row number."""
    within = F.shiftleft(F.col("part").cast("bigint"), SPLIT_BITS) + below(F.col("position"), SPLIT_BITS, "rows of a split")
    return rows.withColumn("position", F.when(F.col("part") < 0, F.col("position")).otherwise(within)).drop("part")


def _picked(rows: DataFrame, entry: Entry) -> DataFrame:
    if entry.format == "nested_translation":
        return select_nested(rows, entry.column, entry.src_key, entry.tgt_key)
    return select_flat(rows, entry.src_col, entry.tgt_col, entry.filter_param)


def _read_alone(spark: SparkSession, entry: Entry, needed: Sequence[str]) -> DataFrame:
    """(position, src, tgt) of a table in folders of its own, e.g. partitioned ones."""
    def read(path: str) -> DataFrame:
        table = spark.read.parquet(path)
        return numbered_rows(spark, path, *[c for c in needed if c in table.columns])

    if isinstance(entry.path, str):
        return _picked(read(entry.path), entry)
    names = entry.split.split("+")
    rows = union_splits({n: read(p) for n, p in entry.path.items() if n in names}, entry.split)
    return _picked(_placed(rows.withColumnRenamed("split_rank", "part").drop("split")), entry)


def named_entries(entries: Sequence[Entry]) -> list[Named]:
    """(rank, dataset, entry): the rank is the place in the list; a name used before gets
    its rank appended, so that two entries never share their output."""
    seen: set[str] = set()
    named = []
    for rank, entry in enumerate(entries):
        name = entry.name
        while name in seen:
            name = f"{name}-{rank}"
        seen.add(name)
        named.append((rank, name, entry))
    return named


def read_catalog(
    spark: SparkSession,
    entries: Sequence[Entry],
    src_lang: str = "",
    tgt_lang: str = "",
    skip: Collection[str] = (),
) -> DataFrame:
    """All datasets (but those to skip) in one table of pairs.

    The rank is the upper part of the pair ids, so a catalog that grows from run to run
    grows at its end; skipped datasets keep their ranks.  Entries that are read alike share a
    scan, and the number of jobs before the result is read does not depend on how many they are.
    """
    named = [n for n in named_entries(entries) if n[1] not in skip]
    if not named:
        raise ValueError("the catalog has no entries to read")
    named = located(spark, named, src_lang, tgt_lang)
    frames = _Reader(spark, named).frames()
    columns = [F.col("rank").cast("int").alias("rank"), "position", *[F.col(c).cast("string").alias(c) for c in ("src", "tgt")]]
    rows = _union([frame.select(*columns) for frame in frames])
    # As many rows as the catalog has entries.
    names = spark.createDataFrame([(rank, name) for rank, name, _ in named], "rank int, dataset string")
    return rows.join(F.broadcast(names), "rank").select(
        ranked_id(F.col("rank"), max(rank for rank, _, _ in named), F.col("position")).alias("pair_id"), "dataset", "src", "tgt")
