"""Quoted files read in pieces give what a whole-file read gives."""

from __future__ import annotations

import csv
import io
import random

import pytest

from pairloom.sources.quoted_records import read_records
from pairloom.sources.tables import read_table


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def planted(rnd, n, end):
    bits = ["word", " ", '"', '""', ",", "\n", "\n\n", "\r\n", "é", "日本", "", "x" * 40, '"\n"', ',"', '",', "\n,\n"]
    rows = [["".join(rnd.choices(bits, k=rnd.randint(0, 12))), str(i), "".join(rnd.choices(bits, k=rnd.randint(0, 5)))] for i in range(n)]
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end)
    writer.writerow(["so,\nurce", "no", "tar\nget"])
    for i, row in enumerate(rows):
        writer.writerow(row)
        if i % 17 == 0:
            out.write(end)  # an empty line between records
    return rows, out.getvalue()


@pytest.mark.parametrize("block", [64, 300, 5000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equal_to_the_whole_file_read(spark, tmp_path, small_blocks, block, end):
    rnd = random.Random(block)
    want = []
    folder = tmp_path / "in"
    folder.mkdir()
    for k, n in enumerate([40, 0, 1, 60]):
        rows, text = planted(rnd, n, end)
        want += rows
        (folder / f"{k}.csv").write_bytes(text.encode())
    small_blocks(block)
    names = "so,\nurce", "tar\nget"
    pieces = read_table(spark, str(folder), *names, "csv")
    got = sorted(tuple(r) for r in pieces.collect())
    value = lambda v: None if v in ("", "NA", "null") else v
    assert [r[0] for r in got] == list(range(len(want)))
    assert [(r[1], r[2]) for r in got] == [(value(a), value(c)) for a, _, c in want]
    if block == 1 << 20 and end == "\n":  # Spark guesses the end of records from the first lines
        whole = read_table(spark, str(folder), *names, "csv", whole_files=True)
        assert sorted(tuple(r) for r in whole.collect()) == got


def test_a_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    rows = "".join(f'"line {i}\nand\nmore","t{i}"\n' for i in range(3000))
    (tmp_path / "a.csv").write_text("s,t\n" + rows)
    small_blocks(4000)
    records = read_records(spark, str(tmp_path / "a.csv"))
    assert records.rdd.getNumPartitions() > 15
    assert records.count() == 3000 and records.selectExpr("max(position)").first()[0] == 2999


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f"part {i}" for i in range(2000))
    (tmp_path / "a.csv").write_text(f's,t\na,b\n"{long}",x\nc,"d ""q"" e"\n')
    small_blocks(500)
    got = read_table(spark, str(tmp_path / "a.csv"), "s", "t", "csv").orderBy("position").collect()
    assert [tuple(r) for r in got] == [(0, "a", "b"), (1, long, "x"), (2, "c", 'd "q" e')]


def test_stray_quotes(spark, tmp_path):
    """In pairs within a line they are text; an odd one would turn inside and outside round."""
    (tmp_path / "pairs.csv").write_text('s,t\nsays "hi" twice,b\nc,d\n')
    got = read_table(spark, str(tmp_path / "pairs.csv"), "s", "t", "csv").orderBy("position").collect()
    assert [tuple(r)[1:] for r in got] == [('says "hi" twice', "b"), ("c", "d")]
    for text in ('s,t\na 5" pipe,b\na 6" pipe,d\n', 's,t\na,"never closed\nx,y\n'):
        (tmp_path / "odd.csv").write_text(text)
        with pytest.raises(Exception, match="quote inside an unquoted field, or left open"):
            read_table(spark, str(tmp_path / "odd.csv"), "s", "t", "csv").collect()
    (tmp_path / "odd.csv").write_text('s,t\na 5" pipe,b\na 6" pipe,d\n')
    assert read_table(spark, str(tmp_path / "odd.csv"), "s", "t", "csv", whole_files=True).count() == 2


def test_long_fields_full_of_quotes(spark, tmp_path):
    field = '""' * 50_000 + "\n" + '""' * 50_000
    (tmp_path / "a.csv").write_text(f's,t\n"{field}",x\n')
    got = read_table(spark, str(tmp_path / "a.csv"), "s", "t", "csv").first()
    assert got.src == field.replace('""', '"') and got.tgt == "x"
