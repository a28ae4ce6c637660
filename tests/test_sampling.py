from __future__ import annotations

import hashlib

import pytest

from conftest import ids
from pairloom.operators import sampling


def smallest(rows, n, seed="s"):
    return sorted(sorted(rows, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))[:n])


@pytest.mark.parametrize("wanted, n", [(0.5, 2), (10, 5), (None, 5), (1.0, 5), (0, 0), (3, 3), (1.5, 5), (0.1, 0), (True, 1)])
def test_sample_sizes(pairs_of, wanted, n):
    df = pairs_of([(str(i), "t") for i in range(5)])
    assert ids(sampling.sample(df, wanted, "s")) == smallest(range(5), n)


def test_sample_per_dataset(pairs_of):
    rows = [("big" if i % 3 else "small", str(i), "t") for i in range(900)]
    df = pairs_of(rows)
    got = ids(sampling.sample(df, {"big": 0.25, "small": 7}, "s"))
    big, small = [i for i in range(900) if i % 3], [i for i in range(900) if i % 3 == 0]
    assert got == sorted(smallest(big, 150) + smallest(small, 7))
    assert got == ids(sampling.sample(df.repartition(9), {"big": 0.25, "small": 7}, "s"))
    assert got != ids(sampling.sample(df, {"big": 0.25, "small": 7}, "other"))


@pytest.mark.parametrize("cap", [0, 1, 4, 5, 6, 9, 10, 11, 1000])
def test_row_cap_over_sparse_ids(spark, cap):
    values = [0, 1, 2, 3, 1 << 20, (1 << 20) + 1, 1 << 40, (1 << 40) + 5, (3 << 40) + (7 << 20), (3 << 40) + (7 << 20) + 9]
    df = spark.createDataFrame([(v, "x") for v in values], "pair_id bigint, src string").repartition(4)
    assert ids(sampling.row_cap(df, cap)) == values[:cap]
