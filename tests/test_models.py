"""Models behind scores: loads per worker, batches, families; and the cosine kernel."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.functions.vectors import cosine, cosines
from pairloom.operators.scoring import Model, attach_score, batches_by_length, model_column


def counted(folder, score):
    """A load that leaves a file, and batches that leave their sizes."""
    def load():
        (folder / f"load-{os.getpid()}-{uuid.uuid4().hex}").touch()

        def run(*columns):
            with open(folder / f"sizes-{os.getpid()}", "a") as f:
                f.write(f"{len(columns[0])} {max(map(len, columns[0]))} {min(map(len, columns[0]))}\n")
            return [score(*row) for row in zip(*columns)]

        return run

    return load


def rows_of(pairs_of, n=3000):
    return pairs_of([("x" * (i * 7 % 90), None if i % 50 == 0 else f"t{i % 40}") for i in range(n)])


@pytest.mark.parametrize("batch_size", [1, 7, 64, 5000])
def test_equal_scores_for_every_batch_size_and_one_load_per_worker(spark, pairs_of, tmp_path, batch_size):
    df = rows_of(pairs_of)
    model = Model(f"m{batch_size}-{tmp_path}", counted(tmp_path, lambda s, t: len(s) + len(t) / 8), batch_size)
    for _ in range(2):  # a second query finds the models loaded
        got = attach_score(df, "score", model).collect()
        assert {r.score for r in got if r.tgt is None} == {None}
        assert all(r.score == len(r.src) + len(r.tgt) / 8 for r in got if r.tgt is not None) and len(got) == 3000
    loads = [p.name.split("-")[1] for p in tmp_path.glob("load-*")]
    assert loads and len(loads) == len(set(loads))
    sizes = [tuple(map(int, line.split())) for p in tmp_path.glob("sizes-*") for line in p.read_text().splitlines()]
    assert max(n for n, _, _ in sizes) <= batch_size
    assert batch_size != 7 or all(most - least <= 30 for _, most, least in sizes)  # of similar length


def test_families_have_their_own_batches(spark, pairs_of, tmp_path):
    folders = {name: tmp_path / name for name in ("a", "b", "c")}
    for f in folders.values():
        f.mkdir()
    models = {n: Model(f"{n}-{tmp_path}", counted(folders[n], lambda s, k=k: [float(len(s)), float(k)]), 3 + 10 * k)
              for k, n in enumerate(folders)}
    df = rows_of(pairs_of, 400).withColumn("encoder", F.when(F.col("pair_id") % 4 == 0, "a").when(F.col("pair_id") % 4 == 1, "b").when(
        F.col("pair_id") % 4 == 2, "unknown"))
    got = attach_score(df, "vector", models, inputs=("src",), returns="array<float>").collect()
    for r in got:
        k = {"a": 0, "b": 1}.get(r.encoder)
        assert r.vector == (None if k is None else [float(len(r.src)), float(k)])
    most = {n: max((int(line.split()[0]) for p in f.glob("sizes-*") for line in p.read_text().splitlines()), default=0) for n, f in folders.items()}
    assert most["a"] <= 3 < most["b"] <= 13 and most["c"] == 0
    assert not list(folders["c"].glob("load-*"))  # nothing to score, nothing loaded


def test_a_model_that_loses_scores_fails(spark, pairs_of):
    short = Model("short", lambda: lambda texts: texts[1:])
    with pytest.raises(Exception, match="gave .* scores for"):
        rows_of(pairs_of, 5).select(model_column(short, ["src"], "string")).collect()


def test_batches_cover_all_rows_once():
    sizes = np.array([5, 1, 9, 9, 3])
    batches = list(batches_by_length(sizes, 2))
    assert [b.tolist() for b in batches] == [[2, 3], [0, 4], [1]]


# Cosine.

def test_cosines_of_hard_vectors():
    a = pa.array([[1, 0], [3, 4], [0, 0], None, [1, 2, 3], [1, None], [], [1.5] * 5, [2, 2]], pa.list_(pa.float32()))
    b = pa.array([[0, 1], [3, 4], [1, 1], [1, 2], [1, 2], [1, 1], [], [1.5] * 5, [-2, -2]], pa.list_(pa.float64()))
    got = cosines(a, b).to_pylist()
    assert got[:7] == [0.0, 1.0, 0.0, None, None, None, 0.0] and got[7:] == pytest.approx([1.0, -1.0])
    assert cosines(a.slice(1, 3), b.slice(1, 3)).to_pylist() == [1.0, 0.0, None]
    assert cosines(a.slice(0, 0), b.slice(0, 0)).to_pylist() == []


def test_cosine_at_768_numbers_without_lambdas(spark, monkeypatch):
    rnd = np.random.default_rng(1)
    x, y = rnd.normal(size=(50, 768)), rnd.normal(size=(50, 768))
    df = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y))], "id int, a array<double>, b array<double>")
    scored = df.select("id", cosine("a", "b").alias("c"))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "ArrowEvalPython" in plan
    want = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))
    assert [r.c for r in scored.orderBy("id").collect()] == pytest.approx(want.tolist())
