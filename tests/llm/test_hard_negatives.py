"""Hard negatives: windows, ties and hard vectors against a plain version."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import hard_negatives
from pairloom.llm.queries import QUERIES

from llm.conftest import hard_vectors

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, is_anchor, scale=256, n_pos=5, n_neg=3):
    part = []
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        part.append((i, label, [math.floor(scale * x) for x in vector]))
    out = []
    for i, label, a in sorted(p for p in part if is_anchor(p[0])):
        dot = lambda b: sum(x * y for x, y in zip(a, b))
        others = [(-dot(b), j, k) for j, k, b in part if j != i and len(b) == len(a)]
        for p, j, _ in sorted(o for o in others if o[2] == label)[:n_pos]:
            fit = sorted(o for o in others if o[2] != label and 50 * -p <= 100 * -o[0] <= 95 * -p)[:n_neg]
            out += [(i, j, r + 1, o[1], -p, -o[0]) for r, o in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, group_bytes=hard_negatives.GROUP_BYTES, anchor="id % 5 = 0", **options):
    df = spark.createDataFrame(rows, "id bigint, label int, vector array<double>").repartition(4)
    got = hard_negatives.mine_hard_negatives(df, "id", "label", "vector", F.expr(anchor), group_bytes=group_bytes, **options)
    return sorted(tuple(r) for r in got.select(*COLUMNS).collect())


def noisy(i, label):
    return (label + 1) % 10 if label is not None and i is not None and i % 7 == 0 else label


@pytest.mark.parametrize("seed, dims, spread, group_bytes", [(1, 12, 3, 1 << 20), (2, 40, 1000, 500), (3, 1, 2, 200), (4, 9, 10**8, 1 << 20)])
def test_random_vectors(spark, monkeypatch, seed, dims, spread, group_bytes):
    """Few values give ties; small groups give many cells; large numbers leave doubles behind."""
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 17)
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 2), [float(rnd.randint(-spread, spread)) for _ in range(dims)]) for i in range(90)]
    rows += [(200 + i, rnd.randint(0, 2), rows[5][2]) for i in range(6)]
    want = plain(rows, lambda i: i % 5 == 0, scale=1)
    assert mined(spark, rows, group_bytes, scale=1) == want and want


def test_hard_vectors(spark, hard_dir):
    got = sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, hard_dir).select(*COLUMNS).collect())
    rows = [(r["vec_id"], noisy(r["vec_id"], r["label"]), r["embedding"]) for r in hard_vectors().to_pylist()]
    assert got == plain(rows, lambda i: i % 50 == 0) and got


def test_repeated_ids(spark):
    rows = [(5, 0, [1.0, 1.0]), (5, 0, [2.0, 0.0]), (6, 0, [3.0, 1.0]), (6, 0, [3.0, 1.0]), (7, 1, [2.0, 1.0])]
    # The anchor with the smallest vector counts; either row of id 6 is a positive, and no row of id 5 is.
    assert mined(spark, rows, scale=1) == [(5, 6, 1, 7, 4, 3), (5, 6, 1, 7, 4, 3)]


def test_scores_beyond_64_bits_fail(spark):
    rows = [(5, 0, [1e9] * 8), (6, 0, [2e10] * 8)]
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, rows, scale=1)


def test_bitmap_shrinks_and_keeps_what_counts():
    rnd = np.random.default_rng(5)
    rows = [rnd.integers(-50, 50, 30) * (10 if k % 50 == 0 else 1) for k in range(1000)]
    block = hard_negatives.Block(hard_negatives.column_block(list(range(1000)), [0] * 1000, rows))
    anchor = rows[0].astype(np.int64)
    windows = hard_negatives.Windows([-1 << 63], [(1 << 63) - 1], 5)
    seen = []
    admit = windows.admit
    windows.admit = lambda least, most: seen.append(len(least)) or admit(least, most)
    places, scores = block.scan(anchor, np.ones(1000, bool), windows)
    exact = np.stack(rows) @ anchor
    assert seen[0] == 1000 and seen == sorted(seen, reverse=True) and len(places) < 50
    assert (scores == exact[places]).all()
    assert set(np.argsort(-exact, kind="stable")[:5]) <= set(places)
