from __future__ import annotations

import math
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, ids, texts
from checks.views import table
from pairloom.functions import grams
from pairloom.functions.fixed_values import ENCODER_FAMILIES
from pairloom.functions.vectors import cosine
from pairloom.operators import language, quality, semantic
from pairloom.operators.language import LanguageProfile, Side, gram_counts
from pairloom.operators.scoring import attach_score
from pairloom.session import BATCH_SETTING

SAMPLES = ["", "a", "añ", "😀b　x", "hello world", "ß" * 5, "the end\nof it"]


def brute_grams(text, n):
    text = f" {text} "
    return [sum(ord(c) * 31 ** (n - 1 - j) for j, c in enumerate(text[i : i + n])) % 65536 for i in range(len(text) - n + 1)]


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("chunk", [1, 12, 1 << 20])
def test_gram_numbers(monkeypatch, n, chunk):
    import pyarrow as pa

    monkeypatch.setattr(grams, "CHUNK_BYTES", chunk)
    got = []
    for part in grams.text_chunks(pa.array(["skip", *SAMPLES, None]).slice(1)):
        found, counts = grams.gram_ids(part, n)
        ends = counts.cumsum()
        got += [found[e - c : e].tolist() for e, c in zip(ends, counts)]
    assert got == [brute_grams(t, n) for t in [*SAMPLES, ""]]


def test_encoder_and_similarity(pairs_of):
    rows = [("hello world", "hello word"), ("", "abc"), ("abc", None), ("same", "same"), ("ab", "yz")]
    encode, similar = semantic.gram_encoder(dimensions=16), semantic.gram_similarity(dimensions=16)
    scored = pairs_of(rows).select(
        "pair_id", "src", "tgt", encode("src").alias("v"), similar("src", "tgt").alias("direct"),
        cosine(encode("src"), encode("tgt")).alias("by_vectors"),
    ).orderBy("pair_id").collect()
    for row in scored:
        folded = Counter(g % 16 for g in brute_grams(row.src, 3))
        assert row.v == [float(folded[d]) for d in range(16)]
        if row.tgt is None:
            assert row.direct is None and row.by_vectors is None
        else:
            other = Counter(g % 16 for g in brute_grams(row.tgt, 3))
            norm = math.sqrt(sum(v * v for v in folded.values()) * sum(v * v for v in other.values()))
            want = sum(folded[d] * other[d] for d in folded) / norm if norm else 0.0
            assert row.direct == pytest.approx(want) and row.by_vectors == pytest.approx(want)


def test_similarity_must_exceed_the_threshold(spark):
    rows = [(0, [1.0, 0.0], [1.0, 0.0]), (1, [1.0, 0.0], [0.0, 1.0]), (2, [0.0, 0.0], [1.0, 0.0]), (3, [3.0, 4.0], [3.0, 0.0])]
    df = spark.createDataFrame(rows, "pair_id bigint, a array<float>, b array<float>")
    assert ids(semantic.semantic_filter(df, "a", "b", 0.6)) == [0]
    assert ids(semantic.semantic_filter(df, "a", "b", 0.59)) == [0, 3]
    assert ids(semantic.semantic_filter(df, "a", "b", -0.1)) == [0, 1, 2, 3]


@pytest.mark.parametrize("src, tgt, family, status", [
    ("en", "fr", "distiluse-base-multilingual-cased-v1", "ok"),
    ("en", "sv", "paraphrase-multilingual-MiniLM-L12-v2", "ok"),
    ("en", "sw", "microsoft/Multilingual-MiniLM-L12-H384", "ok"),
    ("en", "am", "sentence-transformers/LaBSE", "ok"),
    ("en", "ln", None, "pair_not_supported"),
    ("en", "ceb", None, "code_too_long"),
])
def test_encoder_routing(spark, src, tgt, family, status):
    df = spark.createDataFrame([(src, tgt)], "src_lang string, tgt_lang string")
    row = semantic.route_encoders(df).first()
    assert (row.encoder, row.status) == (family, status)
    if family:
        assert semantic.require_encoders(df).first().encoder == family
    else:
        with pytest.raises(Exception, match=status):
            semantic.require_encoders(df).collect()


@pytest.fixture(scope="module")
def detector(spark):
    docs = table(spark, SF_DIR, "documents")
    return LanguageProfile.train(docs).detector(docs)


def test_language_of_documents(spark, detector):
    docs = table(spark, SF_DIR, "documents").where("n_chars > 200")
    found = docs.select("lang", detector("text").alias("d"))
    right = found.select(F.avg((F.col("lang") == F.col("d.code")).cast("int"))).first()[0]
    assert right > 0.95


def test_detection_does_not_depend_on_batches(spark, detector):
    docs = table(spark, SF_DIR, "documents").select("doc_id", detector("text").alias("d"))
    want = sorted(map(repr, docs.collect()))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(repr, docs.collect())) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_null_and_empty_texts(spark, detector):
    df = spark.createDataFrame([(None,), ("",)], "t string").coalesce(1)
    nothing, empty = [r.d for r in df.select(detector("t").alias("d")).collect()]
    assert nothing.code is None and nothing.score is None
    assert empty.score == pytest.approx(0.25)  # no n-gram: every language alike


def test_language_filter_boundaries(spark):
    rows = [(0, ("en", 0.6), ("am", 0.6)), (1, ("en", 0.5999), ("am", 1.0)), (2, ("fr", 1.0), ("am", 1.0)),
            (3, ("__label__en", 1.0), ("ti", 0.6)), (4, (None, None), ("am", 1.0))]
    kind = "struct<code:string,score:double>"
    df = spark.createDataFrame(rows, f"pair_id bigint, src_lang {kind}, tgt_lang {kind}")
    assert ids(language.filter_detected(df, Side("en", 0.6), Side("am", 0.6))) == [0]
    assert ids(language.filter_detected(df, Side("en", 0.6), Side(["am", "ti"], 0.6))) == [0, 3]


def test_language_filter_returns_texts_without_newlines(pairs_of, detector):
    rows = [("the other\nand of the thing there", "and then the end of that\nwhere it is")]
    kept = language.language_filter(pairs_of(rows), detector, detector, Side(["en", "de", "fr", "es"], 0.0), Side(["en", "de", "fr", "es"], 0.0))
    assert texts(kept) == [(rows[0][0].replace("\n", " "), rows[0][1].replace("\n", " "))]


def test_training_needs_text(spark):
    with pytest.raises(ValueError, match="no labelled text"):
        LanguageProfile.train(spark.createDataFrame([], "lang string, text string"))


def test_quality_filter_and_corpus_quality(spark):
    df = spark.createDataFrame([(0, "a", 0.7), (1, "a", 0.69999), (2, "b", None)], "pair_id bigint, dataset string, quality double")
    assert ids(quality.quality_filter(df)) == [0]
    scores = {r.dataset: r.quality_score for r in quality.corpus_quality(df).collect()}
    assert scores == {"a": 0.7, "b": None}
    assert ids(quality.quality_gate(df, 0.69)) == [0, 1]


def test_trained_quality_prefers_what_the_labels_prefer(spark, pairs_of):
    good = [("one two three four", "five six seven eight")] * 20
    bad = [("one two three four", "x")] * 20
    labelled = pairs_of(good + bad).withColumn("label", (F.col("pair_id") < 20).cast("int"))
    learned = quality.train_quality(labelled)
    scored = quality.score_quality(pairs_of([good[0], bad[0], ("  one two three four", good[0][1]), ("a" * 9000, "b")]), learned)
    got = [round(r.quality, 4) for r in scored.orderBy("pair_id").collect()]
    assert got == [round(21 / 22, 4), round(1 / 22, 4), round(21 / 22, 4), 0.5]


def test_three_ways_to_attach_a_score(spark, pairs_of):
    df = pairs_of([("ab", "abc"), ("x", "y")])
    stored = spark.createDataFrame([(0, 5.0)], "pair_id bigint, score double")

    def lengths(src: pd.Series, tgt: pd.Series) -> pd.Series:
        return (src.str.len() + tgt.str.len()).astype(float)

    both = attach_score(attach_score(df, "stored", stored), "native", F.length("src").cast("double"))
    rows = attach_score(both, "batched", lengths).orderBy("pair_id").collect()
    assert [(r.stored, r.native, r.batched) for r in rows] == [(5.0, 2.0, 5.0), (None, 1.0, 2.0)]


def test_missing_and_repeated_vector_keys(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])], "vector_id bigint, vector array<double>")
    pairs = spark.createDataFrame([(1, 2), (1, 2), (1, 3), (1, 9), (None, 2)], "s bigint, t bigint")
    kept = lambda missing: sorted(
        map(tuple, semantic.semantic_filter_by_table(pairs, vectors, "s", "t", 0.5, missing).collect()), key=repr)
    assert kept("drop") == [(1, 2), (1, 2)]
    assert kept("keep") == [(1, 2), (1, 2), (1, 9), (None, 2)]
    with pytest.raises(Exception, match="no vector for one of: 1, 9|no vector for one of: 2"):
        kept("error")
    assert tuple(semantic.missing_vectors(pairs, vectors, "s", "t").first()) == (5, 1, 1, 2)


def test_rows_are_scored_by_their_own_family(spark):
    rows = spark.createDataFrame([("en", "fr", "ab", "ab"), ("en", "sw", "ab", "ab"), ("en", "qq", "ab", "ab")],
                                 "src_lang string, tgt_lang string, src string, tgt string")
    routed = semantic.route_encoders(rows)
    first, third = (list(ENCODER_FAMILIES)[i] for i in (0, 2))
    seen = lambda n: lambda s, t: (F.length(s) + F.length(t) + n).cast("double")
    scored = routed.withColumn("score", semantic.routed_similarity(routed, {first: seen(10), third: seen(20)}))
    assert [r.score for r in scored.orderBy("tgt_lang").collect()] == [14.0, None, 24.0]
    with pytest.raises(ValueError, match="unknown encoder"):
        semantic.routed_similarity(routed, {"none": seen(1)})


def test_working_memory_does_not_grow_with_a_batch():
    lines = pa.array([f"{i} " + "some words of a line " * 10 for i in range(40_000)])
    tracemalloc.start()
    try:
        grams.cosines(lines, lines, 3, 64)
        for part in grams.text_chunks(lines):
            grams.gram_ids(part, 3)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 64 << 20


def test_texts_are_counted_and_detected_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    texts = spark.range(3000, numPartitions=1).select(F.lit("en").alias("lang"), F.repeat(F.lit("word "), F.lit(2000)).alias("text"))
    weights = np.zeros((1, grams.BUCKETS), np.int32)
    for prepare in (lambda: gram_counts(texts, "lang", "text", 3), lambda: LanguageProfile(3, ("en",), weights).detector(texts)):
        spark.conf.unset(BATCH_SETTING)
        try:
            prepare()
            assert max(r.n for r in texts.mapInArrow(sizes, "n long").collect()) < 8 << 20
        finally:
            spark.conf.unset(BATCH_SETTING)
