from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import texts
from pairloom.sources import alignment, catalog, lines, tables
from pairloom.sources.catalog import Entry
from pairloom.sources.positions import numbered_lines, numbered_rows


def write(path, content):
    path.write_bytes(content.encode())
    return str(path)


def test_line_ends_and_odd_separators(spark, tmp_path):
    path = write(tmp_path / "a.txt", "one\r\ntwo\rthree\n\nfi ve\x0bx\x85y\nlast")
    got = [r.line for r in numbered_lines(spark, path).orderBy("position").collect()]
    assert got == ["one", "two", "three", "", "fi ve\x0bx\x85y", "last"]


def test_positions_run_through_blocks_and_files(spark, tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    every = [f"line {i} {'x' * (i % 40)}" for i in range(3000)]
    for part, (a, b) in enumerate([(0, 1700), (1700, 1701), (1701, 3000)]):
        write(folder / f"part-{part}.txt", "\n".join(every[a:b]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        numbered = numbered_lines(spark, str(folder))
        assert numbered.rdd.getNumPartitions() > 5
        got = {r.position: r.line for r in numbered.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == dict(enumerate(every))


def test_positions_of_parquet_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).select("id", F.col("id").cast("string").alias("a b")).repartitionByRange(3, "id").sortWithinPartitions("id").write.parquet(path)
    got = {r.position: r["a b"] for r in numbered_rows(spark, path, "a b").collect()}
    assert got == {i: str(i) for i in range(1000)}


def test_unequal_sides(spark, tmp_path):
    src, tgt = write(tmp_path / "s", "a\nb\nc\n"), write(tmp_path / "t", "x\ny")
    with pytest.raises(ValueError, match="3 source and 2 target"):
        lines.read_aligned_lines(spark, src, tgt)
    assert texts(lines.read_aligned_lines(spark, src, tgt, strict=False)) == [("a", "x"), ("b", "y"), ("c", None)]


def test_alignment_report(spark):
    src = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "dataset string, position bigint")
    tgt = spark.createDataFrame([("a", 0), ("c", 0)], "dataset string, position bigint")
    report = {r.dataset: (r.src_rows, r.tgt_rows, r.unmatched) for r in alignment.alignment_report(src, tgt).collect()}
    assert report == {"a": (2, 1, 1), "b": (1, 0, 1), "c": (0, 1, 1)}
    alignment.require_aligned(alignment.alignment_report(src, src))


def test_pick_files_in_a_folder(spark, tmp_path):
    names = ["Corp.am-en.am", "Corp.am-en.en", "Corp.am-en.ids", "Corp.xml", "README", "LICENSE", "Other.am-en.en"]
    for name in names:
        write(tmp_path / name, f"{name}\n")
    got = texts(lines.read_aligned_folder(spark, str(tmp_path), "Corp", "en", "am"))
    assert got == [("Corp.am-en.en", "Corp.am-en.am")]
    with pytest.raises(FileNotFoundError, match="0 target"):
        lines.read_aligned_folder(spark, str(tmp_path), "Other", "en", "am")
    write(tmp_path / "Corp2.am-en.en", "again\n")
    with pytest.raises(FileNotFoundError, match="2 source"):
        lines.read_aligned_folder(spark, str(tmp_path), "Corp", "en", "am")


def test_source_code_is_tried_first(spark):
    rows = [("d", "d.en", "en", "n"), ("d", "d.xn", "en", "n")]
    listing = spark.createDataFrame(rows, "dataset string, file_name string, src_lang string, tgt_lang string")
    row = lines.pick_files(listing).first()
    assert (row.src_file, row.tgt_file, row.status) == ("d.en", "d.xn", "ok")


TSV = 'no\tSource Text\tTarget\n1\ta "quoted\tb\n2\ttoo\tmany\tfields\n3\tshort\n4\tNA\td\n5\t\tempty\n\n6\tlast\tone'


def test_tsv(spark, tmp_path):
    path = write(tmp_path / "t.tsv", TSV)
    got = texts(tables.read_table(spark, path, "Source Text", "Target"))
    assert got == sorted([('a "quoted', "b"), ("short", None), (None, "d"), (None, "empty"), ("last", "one")], key=repr)
    legacy = texts(tables.read_table(spark, path, "Source Text", "Target", legacy_null_strings=True))
    assert ("short", "None") in legacy and ("nan", "d") in legacy and ("nan", "empty") in legacy


def test_csv(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b,c\n1,"x, ""y""\nz",w\n2,p,q\n3,short\n')
    assert texts(tables.read_table(spark, path, "b", "c", "csv")) == sorted([('x, "y"\nz', "w"), ("p", "q"), ("short", None)], key=repr)
    long = write(tmp_path / "u.csv", "a,b\n1,2,3\n")
    with pytest.raises(Exception, match="too many fields"):
        tables.read_table(spark, long, "a", "b", "csv").collect()
    with pytest.raises(ValueError, match="tsv or csv"):
        tables.read_table(spark, path, "a", "b", "json")
    with pytest.raises(ValueError, match="no column"):
        tables.read_table(spark, path, "a", "zz", "csv")


def test_flat_columns_and_filter(spark):
    df = spark.createDataFrame([("x", "y", None), ("p", "q", "k")], "`src text` string, `t-g` string, tag string")
    assert texts(tables.select_flat(df, "src text", "t-g")) == [("p", "q"), ("x", "y")]
    assert texts(tables.select_flat(df, "src text", "t-g", {"tag": "k", "t-g": "ignored"})) == [("p", "q")]
    assert texts(tables.select_flat(df, "src text", "t-g", {"absent": None})) == [("p", "q"), ("x", "y")]
    assert texts(tables.select_flat(df, "src text", "t-g", {"absent": "k"})) == []


def test_nested_keys(spark):
    df = spark.createDataFrame([({"en": "a", "am": "b"},), ({"en": "c"},)], "t map<string,string>")
    assert texts(tables.select_nested(df, "t", "en", "am")) == sorted([("a", "b"), ("c", None)], key=repr)
    struct = df.select(F.struct(F.lit("a").alias("en")).alias("t"))
    with pytest.raises(ValueError, match="no key"):
        tables.select_nested(struct, "t", "en", "am")


def test_unknown_split(spark):
    with pytest.raises(ValueError, match="no split 'dev'"):
        tables.union_splits({"train": spark.range(1)}, "train+dev")


def test_enumerate_catalog(spark):
    table = catalog.catalog_table(spark, {"hf": ["b", "a"], "url": ["c"], "opus": ["d"]})
    rows = catalog.enumerate_catalog(table, ["url", "none", "hf"]).orderBy("kind_no", "entry_no").collect()
    assert [(r.source, r.dataset) for r in rows] == [("url", "c"), ("hf", "b"), ("hf", "a")]


def test_read_catalog_of_every_kind(spark, tmp_path):
    src, tgt = write(tmp_path / "s", "ls\n"), write(tmp_path / "t", "lt\n")
    folder = tmp_path / "folder"
    folder.mkdir()
    write(folder / "op.am-en.en", "os\n"), write(folder / "op.am-en.am", "ot\n")
    hub = str(tmp_path / "hub")
    spark.createDataFrame([("hs", "ht", {"en": "ns", "am": "nt"})], "s string, t string, tr map<string,string>").write.parquet(hub)
    entries = [
        Entry("local", kind="local", src_path=src, tgt_path=tgt),
        Entry("url", kind="url", src_path=tgt, tgt_path=src),
        Entry("op", str(folder), kind="opus"),
        Entry("tab", write(tmp_path / "x.tsv", "a\tb\nts\ttt\n"), kind="table", src_col="a", tgt_col="b"),
        Entry("comma", write(tmp_path / "x.csv", "a,b\ncs,ct\n"), kind="csv", src_col="a", tgt_col="b"),
        Entry("flat", hub, src_col="s", tgt_col="t"),
        Entry("nested", hub, format="nested_translation", column="tr", src_key="en", tgt_key="am"),
        Entry("dual", format="dual_config", src_path=hub, tgt_path=hub, column="s"),
        Entry("flat", {"train": hub, "dev": hub}, split="dev+train", src_col="t", tgt_col="s"),
    ]
    got = sorted((r.pair_id, r.dataset, r.src, r.tgt) for r in catalog.read_catalog(spark, entries, "en", "am").collect())
    assert [r[1:] for r in got] == [
        ("local", "ls", "lt"), ("url", "lt", "ls"), ("op", "os", "ot"), ("tab", "ts", "tt"), ("comma", "cs", "ct"),
        ("flat", "hs", "ht"), ("nested", "ns", "nt"), ("dual", "hs", "hs"), ("flat-8", "ht", "hs"), ("flat-8", "ht", "hs"),
    ]
    assert len({r[0] for r in got}) == len(got)
    for bad in (Entry("x", kind="ftp"), Entry("x", hub, format="other")):
        with pytest.raises(ValueError, match="unknown"):
            catalog.read_catalog(spark, [bad])


def test_jobs_do_not_grow_with_the_catalog(spark, tmp_path):
    import os

    def entries(n):
        found = []
        for i in range(n):
            folder = tmp_path / f"{n}-{i}"
            os.mkdir(folder)
            for code in ("en", "am"):
                (folder / f"set{i}.{code}").write_text("".join(f"{code} {i} {k}\n" for k in range(3)), encoding="utf-8")
            found.append(catalog.Entry(f"set{i}", str(folder), kind="opus") if i % 2 else catalog.Entry(
                f"set{i}", kind="local", src_path=f"{folder}/set{i}.en", tgt_path=f"{folder}/set{i}.am"))
        return found

    def jobs(n):
        listed = entries(n)
        context = spark.sparkContext
        context.setJobGroup(f"catalog-{n}", "")
        frame = catalog.read_catalog(spark, listed, "en", "am")
        used = len(context.statusTracker().getJobIdsForGroup(f"catalog-{n}"))
        context.setJobGroup("", "")
        return used, frame

    few, _ = jobs(3)
    many, frame = jobs(9)
    assert few == many
    assert frame.count() == 27 and frame.where("src is null or tgt is null").count() == 0


@pytest.mark.parametrize("block", [7, 50, 1 << 20])
def test_all_breaks_equal_python_lines(spark, tmp_path, block):
    import random

    rnd = random.Random(block)
    bits = ["a", "bc", "é", "日", " ", "", "\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029", "\x1f", "\t"]
    ends = ["", "\n", "\r\n", "\r", "\x0b", "\u2028", "\x0b\r", "x\x85", "\x0b\n", "\x0b\x0b", "\u2028 "]
    folder = tmp_path / "in"
    folder.mkdir()
    want = []
    for k in range(40):
        text = "".join(rnd.choices(bits, k=rnd.randint(0, 40))) + ends[k % len(ends)]
        text = ("\ufeff" if k % 9 == 4 else "") + text
        (folder / f"{k:02}.txt").write_bytes(text.encode())
        # Text files are opened with universal line ends, and then split.
        want += [line.lstrip("\ufeff") for line in text.replace("\r\n", "\n").replace("\r", "\n").splitlines()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        frame = numbered_lines(spark, str(folder), all_breaks=True)
        got = sorted((r.position, r.line) for r in frame.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(enumerate(want))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_all_breaks_of_a_catalog_entry(spark, tmp_path):
    src, tgt = write(tmp_path / "s", "one\u2028two\nthree\n"), write(tmp_path / "t", "eins\nzwei\x0bdrei\x0b")
    plain, strict = (Entry(n, kind="local", src_path=src, tgt_path=tgt, all_breaks=n == "strict", strict=False) for n in ("plain", "strict"))
    got = sorted((r.dataset, r.src, r.tgt) for r in catalog.read_catalog(spark, [plain, strict]).collect())
    assert got == [("plain", "one\u2028two", "eins"), ("plain", "three", "zwei\x0bdrei\x0b"),
                   ("strict", "one", "eins"), ("strict", "three", "drei"), ("strict", "two", "zwei")]


def test_jobs_and_scans_of_every_kind_do_not_grow(spark, tmp_path):
    def stage(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        found = []
        for i in range(n):
            hub = str(folder / f"hub {i}")
            rows = [(f"s{i}.{k}", f"t{i}.{k}", {"en": f"n{i}.{k}", "am": "x"}) for k in range(3)]
            spark.createDataFrame(rows, "s string, t string, tr map<string,string>").coalesce(1).write.parquet(hub)
            columns = ("b", "a") if i % 2 else ("a", "b")  # the order of columns differs from file to file
            tsv = write(folder / f"{i}.tsv", "\t".join([*columns, "c"]) + f"\n{columns[0]}{i}\t{columns[1]}{i}\textra\n")
            comma = write(folder / f"{i}.csv", ",".join(columns) + f'\n"{columns[0]}\n{i}",{columns[1]}{i}\nNA,q\n')
            found += [
                Entry(f"flat{i}", hub, src_col="s", tgt_col="t"), Entry(f"splits{i}", {"p": hub, "q": hub}, split="q+p", src_col="t", tgt_col="s"),
                Entry(f"nested{i}", hub, format="nested_translation", column="tr", src_key="en", tgt_key="am"),
                Entry(f"dual{i}", format="dual_config", src_path=hub, tgt_path=hub, column="s"),
                Entry(f"tsv{i}", tsv, kind="table", src_col="a", tgt_col="b", legacy_null_strings=i % 3 == 0),
                Entry(f"csv{i}", comma, kind="csv", src_col="a", tgt_col="b"),
                Entry(f"csv1{i}", write(folder / f"{i}-1.csv", "a,b\nu,v\n"), kind="csv", src_col="a", tgt_col="b", line_breaks=False),
            ]
        return found

    def jobs(n):
        listed = stage(n)
        context = spark.sparkContext
        context.setJobGroup(f"kinds-{n}", "")
        frame = catalog.read_catalog(spark, listed)
        used = len(context.statusTracker().getJobIdsForGroup(f"kinds-{n}"))
        context.setJobGroup("", "")
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        return used, plan.count("Relation"), frame

    few, few_scans, _ = jobs(3)
    many, many_scans, frame = jobs(30)
    assert (few, few_scans) == (many, many_scans)
    rows = sorted((r.pair_id, r.dataset, r.src, r.tgt) for r in frame.collect())
    assert len({r[0] for r in rows}) == len(rows) == 30 * (3 + 6 + 3 + 3 + 1 + 2 + 1)
    of = lambda name: [r[2:] for r in rows if r[1] == name]
    assert of("flat7") == [(f"s7.{k}", f"t7.{k}") for k in range(3)] == [(b, a) for a, b in of("splits7")[:3]] == [(b, a) for a, b in of("splits7")[3:]]
    assert of("nested9") == [(f"n9.{k}", "x") for k in range(3)] and of("dual4") == [(f"s4.{k}",) * 2 for k in range(3)]
    assert of("tsv7") == [("a7", "b7")] == of("tsv7") and of("csv8") == [("a\n8", "b8"), (None, "q")] and of("csv7") == [("a7", "b\n7"), ("q", None)]
    assert of("csv15") == [("u", "v")]


def test_catalog_errors_and_folders_of_folders(spark, tmp_path):
    hub = str(tmp_path / "hub")
    spark.createDataFrame([("a", "b", 1), ("c", "d", 2)], "s string, t string, part int").write.partitionBy("part").parquet(hub)
    got = catalog.read_catalog(spark, [Entry("x", hub, src_col="s", tgt_col="t"), Entry("y", f"{hub}/part=2", src_col="s", tgt_col="t")])
    assert sorted((r.dataset, r.src, r.tgt) for r in got.collect()) == [("x", "a", "b"), ("x", "c", "d"), ("y", "c", "d")]
    with pytest.raises(ValueError, match="no column 'q'"):
        catalog.read_catalog(spark, [Entry("y", f"{hub}/part=2", src_col="s", tgt_col="q")])
    with pytest.raises(ValueError, match="no column 'q'"):
        catalog.read_catalog(spark, [Entry("t", write(tmp_path / "x.tsv", "a\tb\n"), kind="table", src_col="a", tgt_col="q")])
    with pytest.raises(ValueError, match="no split 'dev'"):
        catalog.read_catalog(spark, [Entry("y", {"train": f"{hub}/part=2"}, split="dev+train", src_col="s", tgt_col="t")])
    src, tgt = write(tmp_path / "s", "1\n2\n"), write(tmp_path / "u", "1\n")
    with pytest.raises(ValueError, match="pair: 2 source and 1 target rows"):
        catalog.read_catalog(spark, [Entry("pair", kind="local", src_path=src, tgt_path=tgt)])
    loose = catalog.read_catalog(spark, [Entry("pair", kind="local", src_path=src, tgt_path=tgt, strict=False)])
    assert sorted((r.src, r.tgt) for r in loose.collect()) == [("1", "1"), ("2", None)]


def test_long_and_packed_headers(spark, tmp_path, monkeypatch):
    import gzip

    from pairloom.sources import scans

    monkeypatch.setattr(scans, "HEADER_BYTES", 16)
    names = [f'column, "{i}"\nx' for i in range(50)]
    quoted = ",".join('"' + n.replace('"', '""') + '"' for n in names)
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress((quoted + "\n1,2\n").encode()))
    write(tmp_path / "b.tsv", "\ufeff" + "\t".join(f"c{i}" for i in range(50)) + "\r\n")
    found = scans.headers(spark, [(f"file:{tmp_path}/a.csv.gz", "csv"), (f"file:{tmp_path}/b.tsv", "tsv")])
    assert [*found.values()] == [names, [f"c{i}" for i in range(50)]]


def test_csv_in_pieces(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n' + "".join(f'"x, ""{i}""",y{i}\n' for i in range(2000)) + "\nshort\n", encoding="utf-8")
    whole = tables.read_table(spark, str(path), "a", "b", "csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        pieces = tables.read_table(spark, str(path), "a", "b", "csv", line_breaks=False)
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 1
        rows = [(r.src, r.tgt) for r in pieces.orderBy("position").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == [(r.src, r.tgt) for r in whole.orderBy("position").collect()] and len(rows) == 2001
    assert rows[7] == ('x, "7"', "y7") and rows[-1] == ("short", None)
    path.write_text('a,b\n"open,y\n', encoding="utf-8")
    with pytest.raises(Exception, match="quote left open"):
        tables.read_table(spark, str(path), "a", "b", "csv", line_breaks=False).collect()
    path.write_text('a,b\nx,y,z\n', encoding="utf-8")
    with pytest.raises(Exception, match="too many fields"):
        tables.read_table(spark, str(path), "a", "b", "csv", line_breaks=False).collect()


def test_a_document_with_too_many_lines_for_its_ids_fails(spark, monkeypatch):
    from checks import views
    monkeypatch.setattr(views, "LINE_IDS", 3)
    docs = spark.createDataFrame([(1, "s", "a\nb\nc"), (2, "s", "d")], "doc_id bigint, source string, text string")
    assert sorted(r.pair_id for r in views.adjacent_lines(docs).collect()) == [4, 5, 6, 7]
    longer = spark.createDataFrame([(1, "s", "a\nb\nc\nx"), (2, "s", "d")], "doc_id bigint, source string, text string")
    with pytest.raises(Exception, match="too many lines for the ids of document 1"):
        views.adjacent_lines(longer).collect()


def _staged_sizes(spark, tmp_path, monkeypatch, query, pattern, ids):
    """The rows of a query over documents of 100 characters, and the bytes of the files that it stages."""
    from checks import queries_sources
    from pairloom.sources import spread
    monkeypatch.setattr(spread, "PART_BYTES", 2000, raising=False)
    monkeypatch.setattr(queries_sources, "staging_folder", lambda _: str(tmp_path / "staged"))
    docs = spark.createDataFrame([(i, "en", "s", f"{n:05d}\n{'x' * 94}") for n, i in enumerate(ids)], "doc_id long, lang string, source string, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    rows = query(spark, str(tmp_path)).collect()
    return rows, [p.stat().st_size for p in (tmp_path / "staged").glob(pattern)]


# A third of the ids are equal, and some null: they come first, and stay as they are read.
REPEATED = sorted([None] * 30 + [7] * 100 + list(range(170)), key=lambda i: -1 if i is None else i)


def test_csv_records_are_staged_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    from checks.queries_sources import src_table_csv_records
    rows, sizes = _staged_sizes(spark, tmp_path, monkeypatch, src_table_csv_records, "table/*.csv", REPEATED)
    for way in ("whole", "pieces"):
        got = sorted((r.position, r.src) for r in rows if r.read == way)
        assert got == [(n, f"{n:05d}\n{'x' * 94}") for n in range(300)]
    assert len(sizes) > 10 and max(sizes) < 6000


def test_strict_lines_are_staged_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    from checks.queries_sources import src_lines_strict
    rows, sizes = _staged_sizes(spark, tmp_path, monkeypatch, src_lines_strict, "text/*.txt", REPEATED)
    got = [r.line for r in sorted(rows, key=lambda r: r.position)]
    assert got == [line for n in range(300) for line in (f"{n:05d}", "x" * 94)]
    assert [r.position for r in sorted(rows, key=lambda r: r.position)] == list(range(600))
    assert len(sizes) > 10 and max(sizes) < 6000
