"""Near matches: what is sent, bounds, hard texts, and a hot text."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import ids
from pairloom.operators import leakage, near_leakage
from pairloom.operators.near_leakage import LeakIndex, both_sides, meetings


def tokens(text):
    return set((text or "").split(" ")) - {""}


def jaccard(a, b):
    a, b = tokens(a), tokens(b)
    return len(a & b) / len(a | b) if a and b else 0.0


def sentences(rnd, n, words):
    return [" ".join(rnd.choices(words, k=rnd.randint(0, 14))) if rnd.random() < 0.95 else rnd.choice([None, "", "  "]) for _ in range(n)]


@pytest.mark.parametrize("threshold", [0.2, 0.5, 2 / 3, 0.8, 0.99])
def test_index_against_all_pairs(threshold, monkeypatch):
    monkeypatch.setattr(near_leakage, "CHUNK", 64)
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(15)] + ["the", "of"] * 5
    test, corpus = sentences(rnd, 80, words), sentences(rnd, 400, words)
    corpus += [" ".join(reversed((t or "").split(" "))) for t in test]
    index = LeakIndex.build(pa.array([t for t in test if t is not None], pa.string()), threshold)
    got = index.near(pa.array(corpus, pa.string())).to_pylist()
    want = [any(jaccard(c, t) > threshold for t in test) for c in corpus]
    assert got == want and any(want) and not all(want)


def test_empty_index():
    index = LeakIndex.build(pa.array([], pa.string()), 0.5)
    assert index.near(pa.array(["a b", None, ""], pa.string())).to_pylist() == [False] * 3
    assert index.near(pa.array([], pa.string())).to_pylist() == []


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_hard_and_hot_texts(spark, pairs_of, limit):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    hot = "one very frequent source text"
    rows = [(hot if i % 3 == 0 else s, t) for i, (s, t) in enumerate(zip(sentences(rnd, 300, words), sentences(rnd, 300, words)))]
    keys = [*zip(sentences(rnd, 40, words), sentences(rnd, 40, words)), (hot + " indeed", None), (None, hot)]
    test = spark.createDataFrame(keys, "src string, tgt string")
    want = [i for i, (s, t) in enumerate(rows) if not any(jaccard(s, a) > 0.6 or jaccard(t, b) > 0.6 for a, b in keys)]
    got = leakage.drop_near_leaked(pairs_of(rows).withColumn("side", F.lit("kept")).withColumn("n", F.lit(1)), test, 0.6, limit=limit)
    assert ids(got) == want and got.columns == ["pair_id", "dataset", "src", "tgt", "side", "n"]
    nothing = leakage.drop_near_leaked(pairs_of(rows), test.limit(0), 0.6, limit=limit)
    assert len(ids(nothing)) == len(rows)


def test_with_a_small_test_set_no_row_moves(spark, pairs_of):
    test = spark.createDataFrame([("a b c", "d e f")], "src string, tgt string")
    plan = leakage.drop_near_leaked(pairs_of([("a b c d", "x")]), test, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange hash" not in plan and "Generate" not in plan


def test_a_large_test_set_meets_prefixes_only(spark, pairs_of):
    """Texts of ten tokens at 0.8 send three tokens each; a token that all share is in no prefix."""
    rows = [(f"the of and to in a u{i} v{i} x{i} y{i}", None) for i in range(50)]
    test = spark.createDataFrame([(f"the of and to in a p{i} q{i} r{i} s{i}", None) for i in range(50)] + [rows[7]], "src string, tgt string")
    prefix = near_leakage.prefix_column(spark, near_leakage.frequent_tokens(both_sides(test, {"src": "src"})), 0.8)
    sent = pairs_of(rows).select("pair_id", F.inline(prefix("src")))
    assert sent.count() == 150 and not {r.token for r in sent.collect()} & {"the", "of", "and", "to", "in", "a"}
    met = meetings(pairs_of(rows), both_sides(test, {"src": "src", "tgt": "tgt"}), 0.8)
    assert [r.pair_id for r in met.collect()] == [7]


def test_a_large_test_set_shuffles_hits_and_false_positives_only(spark, pairs_of):
    rows = [(f"source {i}", f"target {i}" if i % 5 else None) for i in range(4000)]
    test = [(f"source {i}", f"unseen {i}") for i in range(0, 4000, 100)] + [(f"other {i}", f"target {i}") for i in range(7, 4000, 200)]
    test = spark.createDataFrame([*test, (None, "x")], "src string, tgt string")
    keys = both_sides(test, {"src": "src", "tgt": "tgt"}).distinct()
    passed = leakage.possible_keys(pairs_of(rows), keys)
    hits = passed.join(keys, ["side", "text"], "left_semi").count()
    assert hits == 40 + sum(i % 5 > 0 for i in range(7, 4000, 200)) and hits <= passed.count() <= hits + 0.02 * 8000
    want = [i for i, (s, t) in enumerate(rows) if i % 100 and (i % 200 != 7 or t is None)]
    assert ids(leakage.drop_leaked(pairs_of(rows), test, limit=0)) == want
    # Too few bits let more texts pass, and lose none.
    crowded = leakage.possible_keys(pairs_of(rows), keys, most_bits=64)
    assert crowded.join(keys, ["side", "text"], "left_semi").count() == hits and crowded.count() > passed.count()
