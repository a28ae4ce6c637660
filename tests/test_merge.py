from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import ids, texts
from pairloom.operators import dedup, leakage
from pairloom.operators.joins import lookup_join
from pairloom.operators.tagging import tag_languages, union_corpora
from pairloom.plans import merge


def brute_force_dedup(rows):
    out = [(i, s, t) for i, (s, t) in enumerate(rows) if s is None or t is None or s != t]
    for key in (lambda r: (r[1], r[2]), lambda r: r[1], lambda r: r[2]):
        seen, kept = set(), []
        for r in out:
            if key(r) not in seen:
                seen.add(key(r))
                kept.append(r)
        out = kept
    return out


def random_rows(n, seed=3, hot=True):
    """A third of the rows share one source: the hot key."""
    rng = random.Random(seed)
    sources = [None, *"abcdefghij"]
    targets = [None, *(a + b for a in "abcd" for b in "012345")]
    return [("hot" if hot and i % 3 == 0 else rng.choice(sources), rng.choice(targets)) for i in range(n)]


def test_identical_keeps_nulls(pairs_of):
    rows = [(None, None), ("x", "x"), (None, "y"), ("y", None), ("a", "b")]
    assert ids(dedup.drop_identical(pairs_of(rows))) == [0, 2, 3, 4]


def test_source_then_target_is_sequential(pairs_of):
    rows = [("a", "p"), ("a", "q"), ("c", "q")]
    assert texts(dedup.deduplicate(pairs_of(rows))) == [("a", "p"), ("c", "q")]


@pytest.mark.parametrize("partitions", [1, 5])
def test_deduplicate_against_brute_force(pairs_of, partitions):
    rows = random_rows(600)
    df = pairs_of(rows).repartition(partitions)
    want = brute_force_dedup(rows)
    got = sorted(((r.pair_id, r.src, r.tgt) for r in dedup.deduplicate(df).collect()))
    assert got == sorted(want)
    counts = {r.step: r.rows for r in dedup.dedup_counts(df).collect()}
    assert counts["input"] == 600 and counts["first_per_target"] == len(want)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_leakage_with_nulls_and_both_join_ways(pairs_of, spark, limit):
    test = spark.createDataFrame([("s1", "t1"), (None, "t2"), ("s3", "t3")], "src string, tgt string")
    rows = [("s1", "x"), ("x", "t1"), ("s3", "t3"), (None, "x"), ("x", None), ("ok", "fine"), ("t1", "s1")]
    assert ids(leakage.drop_leaked(pairs_of(rows), test, limit=limit)) == [4, 5, 6]


def test_leakage_on_a_hot_source(pairs_of, spark):
    rows = random_rows(300)
    test = spark.createDataFrame([("hot", "none"), ("zz", "a0")], "src string, tgt string")
    want = [i for i, (s, t) in enumerate(rows) if s not in ("hot", "zz") and t not in ("none", "a0")]
    for limit in (64 << 20, 0):
        assert ids(leakage.drop_leaked(pairs_of(rows), test, limit=limit)) == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join(pairs_of, spark, how):
    rows = random_rows(200)
    lookup = spark.createDataFrame([("hot", 1), ("a", 2), (None, 3), ("unused", 4)], "k string, v int")
    small = lookup_join(pairs_of(rows), lookup, "src", "k", how)
    large = lookup_join(pairs_of(rows), lookup, "src", "k", how, limit=0)
    assert small.columns == large.columns
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def jaccard(a, b):
    a, b = set(a.split(" ")) - {""}, set(b.split(" ")) - {""}
    return len(a & b) / len(a | b) if a and b else 0.0


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.6, 0.8, 1.0])
def test_near_leakage_against_brute_force(pairs_of, spark, threshold):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(12)] + ["the"] * 6
    sentence = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 7)))
    rows = [(sentence(), sentence()) for _ in range(250)]
    keys = [(sentence(), sentence()) for _ in range(25)]
    test = spark.createDataFrame(keys, "src string, tgt string")
    want = [
        i for i, (s, t) in enumerate(rows)
        if not any(jaccard(s, a) > threshold or jaccard(t, b) > threshold for a, b in keys)
    ]
    assert ids(leakage.drop_near_leaked(pairs_of(rows), test, threshold)) == want
    if threshold == 0.5:
        assert 0 < len(want) < 250
        assert ids(leakage.drop_near_leaked(pairs_of(rows), test, threshold, limit=0)) == want


def test_a_leaked_pair_still_displaces_later_ones(pairs_of, spark):
    test = spark.createDataFrame([("s", "leak")], "src string, tgt string")
    rows = [("a", "leak"), ("a", "fine"), ("b", "fine")]
    assert texts(merge.merge_corpus(pairs_of(rows), test)[1]) == [("b", "fine")]
    assert len(texts(merge.merge_corpus(pairs_of(rows), test, dedup=False)[1])) == 2


def test_excluded_datasets_only_on_request(pairs_of, spark):
    manifest = spark.createDataFrame([("x", False), ("y", True)], "dataset_name string, excluded boolean")
    df = pairs_of([("x", "a", "b"), ("y", "c", "d"), ("z", "e", "f")])
    assert ids(merge.finished_pairs(df, manifest)) == [0]
    assert ids(merge.finished_pairs(df, manifest, include_excluded=True)) == [0, 1]


def test_union_of_corpora_loses_no_column(pairs_of):
    df = pairs_of([("a", "b")])
    both = union_corpora([tag_languages(df, "eng_Latn", "amh_Ethi"), tag_languages(df, "swa_Latn", "eng_Latn")])
    assert set(both.columns) == {"sentence_eng_Latn", "sentence_amh_Ethi", "sentence_swa_Latn", "src_lang", "tgt_lang"}
    rows = {r.src_lang: r for r in both.collect()}
    assert rows["eng_Latn"].sentence_amh_Ethi == "b" and rows["eng_Latn"].sentence_swa_Latn is None
    assert rows["swa_Latn"].sentence_eng_Latn == "b"


def test_counts_of_steps_follow_the_steps(pairs_of):
    rows = [("a", "a"), ("a", "a"), ("a", "b"), ("a", "b"), ("a", None), ("c", "b"), (None, "b"), (None, None), (None, None), ("d", "d"), ("e", None)]
    df = pairs_of(rows)
    kept = df.transform(dedup.drop_identical)
    want = [df.count(), kept.count(), dedup.first_per_pair(kept).count(), dedup.first_per_source(kept).count(), dedup.deduplicate(df).count()]
    assert [r.rows for r in dedup.dedup_counts(df).orderBy("step_no").collect()] == want
    assert [r.rows for r in dedup.dedup_counts(df.where("false")).collect()] == [0] * 5


def test_large_test_sets_leak_nothing_either(pairs_of, spark):
    test = spark.createDataFrame([("s1", "t5"), (None, "t7"), ("unseen", None)], "src string, tgt string")
    rows = [(f"s{i}", f"t{i}") for i in range(9)] + [(None, "x"), ("y", None)]
    small = texts(leakage.drop_leaked(pairs_of(rows), test))
    assert small == texts(leakage.drop_leaked(pairs_of(rows), test, limit=0))
    assert len(small) == 6


def _random_pairs(pairs_of, n=400):
    import random

    rnd = random.Random(11)
    text = lambda: rnd.choice([None, "", "a", "b", "A", "a ", "\x00", "True", "False", *[f"t{i}" for i in range(40)]])
    return pairs_of([(text(), text()) for _ in range(n)])


def _plain_first(rows, key):
    seen, out = set(), []
    for r in rows:
        if key(r) not in seen:
            seen.add(key(r))
            out.append(r)
    return out


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_first_per_key_against_a_plain_loop(spark, pairs_of, limit):
    from pairloom.operators.first import keep_first

    df = _random_pairs(pairs_of)
    rows = sorted(tuple(r) for r in df.collect())
    by_src = _plain_first(rows, lambda r: r[2])
    assert sorted(tuple(r) for r in keep_first(df, [["src"]], limit=limit).collect()) == by_src
    both = keep_first(df, [["src"], ["tgt"]], limit=limit)
    assert sorted(tuple(r) for r in both.collect()) == _plain_first(by_src, lambda r: r[3]) and both.columns == df.columns
    pairs = sorted(tuple(r) for r in dedup.first_per_pair(df).collect())
    assert pairs == _plain_first(rows, lambda r: r[2:])


def test_first_per_key_is_exact_when_hashes_collide(spark, pairs_of, monkeypatch):
    from pairloom.operators import first

    df = _random_pairs(pairs_of)
    want = sorted(tuple(r) for r in dedup.deduplicate(df).collect())
    few = lambda keys: [F.length(F.coalesce(F.col(keys[0]), F.lit("")))] * 2
    monkeypatch.setattr(first, "key_hashes", few)
    assert first.first_ids(df, [["src"]], "pair_id").where("clash").count() > 0
    assert sorted(tuple(r) for r in dedup.deduplicate(df).collect()) == want


def test_no_text_is_sorted_or_shuffled_to_deduplicate(spark, pairs_of):
    from pairloom.operators.first import first_ids, keep_first

    df = _random_pairs(pairs_of)
    ids = first_ids(df, [["src"], ["tgt"]], "pair_id")._jdf.queryExecution().executedPlan().toString()
    assert ids.count("HashAggregate") == 4 and "SortAggregate" not in ids
    rows = keep_first(df, [["src"], ["tgt"]])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in rows and "Aggregate" not in rows
