"""Line deduplication: batches, levels and hard texts against a plain version."""

from __future__ import annotations

import random
import string
from collections import defaultdict

import pytest

from pairloom.llm import line_runs


def plain_lines(rows, least_docs=3, least_chars=20):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    holders = defaultdict(list)
    for n, (doc, text) in enumerate(rows):
        for k in {key(line) for line in (text or "").split("\n")}:
            holders[k].append(doc)
    keeper = {k: max((d for d in docs if d is not None), default=None)
              for k, docs in holders.items() if len(docs) >= least_docs and len(k) >= least_chars}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = [keeper.get(key(line)) is not None and (doc is None or doc < keeper[key(line)]) for line in lines]
        out.append((doc, len(lines), sum(gone), "\n".join(line for line, g in zip(lines, gone) if not g)))
    return out


def random_rows(n, seed):
    rnd = random.Random(seed)
    pool = [f"line number {i} of some length é"[:rnd.choice([19, 20, 21, 60])] for i in range(40)]
    def line():
        text = rnd.choice(pool)
        text = text.upper() if rnd.random() < 0.2 else text
        return rnd.choice(["", " ", "\t", "\r", " "]) + text + rnd.choice(["", " ", "\x0b", "\x0c"])
    rows = [(i, "\n".join(line() for _ in range(rnd.randint(0, 9)))) for i in range(n)]
    return rows + [(None, rows[0][1]), (n - 1, rows[n - 1][1]), (n, None), (n + 1, ""), (n + 2, "\n\n"), (None, None)]


def as_rows(df):
    key = lambda r: (r[0] is None, r[0] or 0, repr(r))
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()], key=key)


def expected(rows):
    return sorted(plain_lines(rows), key=lambda r: (r[0] is None, r[0] or 0, repr(r)))


@pytest.mark.parametrize("n_batches, fanout, limit", [(1, 4, 1 << 20), (5, 2, 1 << 20), (9, 3, 0)])
def test_batches_and_levels(spark, n_batches, fanout, limit):
    rows = random_rows(60, n_batches)
    schema = "doc_id bigint, text string, n_lines string, hash int, keeper int, n int"
    frame = lambda part: spark.createDataFrame([(*r, "x", 1, 2, 3) for r in part], schema)
    batches = [frame(rows[i::n_batches]) for i in range(n_batches)]
    random.Random(1).shuffle(batches)
    settled = line_runs.repeated_lines(batches, "doc_id", "text", fanout=fanout)
    got = line_runs.drop_lines(frame(rows), "doc_id", "text", settled, limit=limit)
    assert {"hash", "keeper", "n"} <= set(got.columns)
    assert as_rows(got) == expected(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_runs_")]


def test_runs_are_compacted_and_settled_keys_absorbed(spark):
    line = "a line that is long enough"
    runs = line_runs.LineRuns(spark, fanout=3)
    try:
        docs = lambda ids: spark.createDataFrame([(i, f"{line}\nunique line of document {i} here") for i in ids], "doc_id bigint, text string")
        runs.add(docs([50, 51, 52]), "doc_id", "text")
        runs.add(docs([1, 2]), "doc_id", "text")  # the common line is settled and these ids are smaller: nothing of it is added
        assert spark.table(runs.tables[0]).where("n >= 2").count() == 1
        assert runs.runs == [2]
        runs.add(docs([60]), "doc_id", "text")  # a larger id is news
        assert runs.runs == [0, 1]
        assert [r.keeper for r in runs.settled().collect()] == [60]
        assert runs.runs[-1] >= 1
    finally:
        runs.close()


def test_neither_runs_nor_their_merge_are_shuffled(spark, tmp_path):
    runs = line_runs.LineRuns(spark)
    try:
        docs = spark.createDataFrame([(1, "x" * 30), (2, "y" * 30)], "doc_id bigint, text string")
        runs.add(docs, "doc_id", "text")
        table = spark.table(runs.tables[0])
        plan = runs._summed(table)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        new = runs._summed(table.selectExpr("__llm_h1", "__llm_h2", "n", "keeper").repartition(3))
        joined = runs._not_in(new, table)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in joined and joined.count("Exchange hashpartitioning") == 1
    finally:
        runs.close()


def test_many_drops_in_a_long_text(spark):
    common = [f"common line number {i} of the texts" for i in range(3000)]
    long = "\n".join(x for i, c in enumerate(common) for x in (c, f"own {i}"))
    rows = [(1, long), *[(i, "\n".join(common)) for i in range(2, 6)]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = line_runs.drop_lines(df, "doc_id", "text", line_runs.repeated_lines([df], "doc_id", "text"))
    assert as_rows(got) == expected(rows)


def test_files_in_batches(spark, tmp_path):
    spark.range(100).repartition(7).write.parquet(str(tmp_path / "a b"))
    batches = line_runs.file_batches(spark, str(tmp_path / "a b"), 3)
    assert 1 < len(batches) <= 3
    assert sorted(r.id for b in batches for r in b.collect()) == list(range(100))
