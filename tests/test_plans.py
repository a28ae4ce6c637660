from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, ids, texts
from checks.queries_plans import standard_stages
from checks.views import pairs
from pairloom.model import global_id
from pairloom.operators.joins import measured_bytes
from pairloom.operators.quality import train_quality
from pairloom.operators.language import LanguageProfile
from pairloom.plans import corpus, manifest, stages
from pairloom.plans.sampled import Corpus, sample_merge
from pairloom.plans.stages import COUNTS, Stage
from pairloom.sinks import files
from pairloom.sources.catalog import Entry, named_entries
from pairloom.sources.lines import read_aligned_lines


def length_stage(name, limit):
    return Stage(name, lambda df: df.withColumn("n", F.length("src")), F.col("n") > limit)


@pytest.mark.parametrize("names", [("semantic", "language", "quality"), ("language",), ()])
def test_flags_agree_with_filters(pairs_of, names):
    rows = [("x" if i % 4 else "y", "s" * (i % 30) + str(i), "t" * (i % 30) + "?" * 3) for i in range(200)]
    df = pairs_of(rows)
    chain = [length_stage(n, 8 * (k + 1)) for k, n in enumerate(names)]
    flagged = stages.flag_stages(df, chain)
    assert ids(flagged.where(F.col("passed") == len(chain))) == ids(stages.keep_survivors(df, chain))
    for row in stages.stage_funnel(df, flagged, chain).collect():
        counts = [row[c] for c in COUNTS]
        assert counts == sorted(counts, reverse=True)
        if not names:
            assert len(set(counts[1:])) == 1


def test_flags_agree_on_real_stages(spark):
    df, chain = pairs(spark, SF_DIR), standard_stages(spark, SF_DIR)
    survivors = stages.keep_survivors(df, chain)
    flagged = stages.flag_stages(df, chain).where("passed = 3")
    assert texts(flagged) == texts(survivors)
    total = stages.with_total(stages.stage_funnel(df, stages.flag_stages(df, chain), chain)).where("dataset = 'TOTAL'").first()
    assert total.original == df.count() and total.after_quality == survivors.count() and total.quality_score is None


def test_dataset_emptied_by_the_rules_counts_zero(pairs_of):
    df = pairs_of([("gone", "a", "b"), ("kept", "some text", "other text")])
    rows = {r.dataset: tuple(r[c] for c in COUNTS) for r in stages.stage_funnel(df, stages.flag_stages(df, []), []).collect()}
    assert rows == {"gone": (1, 0, 0, 0, 0), "kept": (1, 1, 1, 1, 1)}


def test_zero_counts_in_metadata(spark):
    summary = spark.createDataFrame(
        [("hf", "d", 10, 0, 0, 0, 0, None), ("hf", "e", 10, 5, 0, 2, 0, 0.5)],
        "source string, dataset string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", quality_score double",
    )
    at = F.lit("2025-01-01").cast("timestamp")
    true = {r.dataset_name: tuple(r[c] for c in COUNTS) for r in manifest.dataset_metadata(summary, "en-am", at).collect()}
    assert true == {"d": (10, 0, 0, 0, 0), "e": (10, 5, 0, 2, 0)}
    old = {r.dataset_name: tuple(r[c] for c in COUNTS) for r in manifest.dataset_metadata(summary, "en-am", at, True).collect()}
    assert old == {"d": (10, 10, 10, 10, 10), "e": (10, 5, 5, 2, 2)}


def test_aligned_text_round_trip(spark, pairs_of, tmp_path):
    rows = [("x" if i % 3 else "y", f"s{i}\nmore", f"t{i}" if i % 5 else "") for i in range(300)]
    root = str(tmp_path / "text")
    files.write_aligned_text(pairs_of(rows), root, "en", "am")
    for dataset in "xy":
        back = read_aligned_lines(spark, *[f"{root}/lang_pair=en-am/lang={c}/dataset={dataset}" for c in ("en", "am")])
        got = [(r.src, r.tgt) for r in back.orderBy("position").collect()]
        assert got == [(s.replace("\n", " "), t) for d, s, t in rows if d == dataset]
    with pytest.raises(Exception, match="line break"):
        files.write_aligned_text(pairs_of(rows), root, "en", "am", reject=True)


def test_pairs_round_trip_replaces_only_its_datasets(spark, pairs_of, tmp_path):
    root = str(tmp_path / "pairs")
    files.write_pairs(pairs_of([("007", "a", "b"), ("y", "c", None)]), root, "en", "am")
    files.write_pairs(pairs_of([("y", "new", "row")]), root, "en", "am")
    files.write_pairs(pairs_of([("z", "other", "pair")]), root, "en", "fr")
    assert [(r.dataset, r.src, r.tgt) for r in files.read_pairs(spark, root, "en", "fr").collect()] == [("z", "other", "pair")]
    back = files.read_pairs(spark, root, "en", "am")
    assert sorted((r.dataset, r.src, r.tgt) for r in back.collect()) == [("007", "a", "b"), ("y", "new", "row")]


def test_unknown_output_format():
    with pytest.raises(ValueError, match="unknown output format"):
        files.check_format("xml")


def test_whole_run_with_cache_and_merge(spark, pairs_of, tmp_path):
    def stage_table(name, rows):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, "src string, tgt string").coalesce(1).write.parquet(path)
        return Entry(name, path)

    first = stage_table("first", [("hello there", "good day now"), ("hello there", "good day then"), ("a", "b"), ("test line", "some text")])
    second = stage_table("second", [("hello there", "other words"), ("new sentence", "good day now"), ("last one here", "fine text")])
    out = corpus.Output(str(tmp_path / "out"), "en", "am")
    learned = train_quality(pairs_of([("aa bb", "cc dd")]).withColumn("label", F.lit(1)))
    chain = [length_stage("semantic", 4)]

    corpus.process_datasets(spark, [first], out, chain, quality_table=learned)
    summary = {r.dataset: r for r in corpus.process_datasets(spark, [first, second], out, chain, quality_table=learned).collect()}
    assert [summary["first"][c] for c in COUNTS] == [4, 3, 3, 3, 3]
    assert [summary["TOTAL"][c] for c in COUNTS] == [7, 6, 6, 6, 6]
    assert summary["second"].quality_score is not None and summary["TOTAL"].quality_score is None
    # The first dataset was not processed again: it has one metadata row.
    assert corpus.read_manifest(spark, out).groupBy("dataset_name").count().where("count > 1").count() == 0

    test_set = spark.createDataFrame([("test line", "unseen")], "src string, tgt string")
    meta = corpus.merge_datasets(spark, out, test_set).first()
    assert meta.total_rows_before_dedup == 6
    merged = spark.read.parquet(f"{out.root}/merged_en-am").select(F.col("en").alias("src"), F.col("am").alias("tgt"))
    assert texts(merged) == [("hello there", "good day now"), ("last one here", "fine text")]
    assert (meta.total_rows_after_dedup, meta.rows_after_leakage) == (3, 2)
    assert {r.dataset_name for r in meta.included_datasets} == {"first", "second"}
    only_second = corpus.merge_datasets(spark, out, excluded=["first"]).first()
    assert only_second.total_rows_before_dedup == 3


@pytest.mark.parametrize("save_format", ["parquet", "text"])
def test_runs_over_time(spark, tmp_path, save_format):
    def table(name, rows):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, "src string, tgt string").coalesce(1).write.mode("overwrite").parquet(path)
        return Entry(name, path)

    def kept(out):
        rows = sorted((r.dataset, r.src) for r in corpus.read_output(spark, out).collect())
        if save_format == "text":
            lines = corpus.read_output_lines(spark, out).where(F.col("lang") == out.src_lang)
            assert sorted((r.dataset, r.value) for r in lines.collect()) == rows
        return rows

    out = corpus.Output(str(tmp_path / "out"), "en", "am", save_format)
    first, second = table("a", [("one two", "xx yyy"), ("three", "zzzz")]), table("b", [("four five", "uuu vvv")])
    corpus.process_datasets(spark, [first], out, [])
    assert kept(out) == [("a", "one two"), ("a", "three")]
    corpus.process_datasets(spark, [first, second], out, [])
    assert kept(out) == [("a", "one two"), ("a", "three"), ("b", "four five")]
    # A second language pair under the same root changes nothing for the first.
    other = corpus.Output(out.root, "en", "fr", save_format)
    corpus.process_datasets(spark, [second], other, [])
    assert kept(other) == [("b", "four five")] and len(kept(out)) == 3
    assert corpus.merge_datasets(spark, out).first().total_rows_before_dedup == 3
    # Processed again, the first dataset keeps nothing: neither rows nor counts stay behind.
    nothing = table("a", [("same", "same")])
    summary = {r.dataset: r for r in corpus.process_datasets(spark, [nothing, second], out, [], from_cache=False).collect()}
    assert kept(out) == [("b", "four five")] and summary["a"].after_rule == 0
    assert corpus.merge_datasets(spark, out).first().total_rows_before_dedup == 1
    # Files of the runs that nothing is read from any more go, and only they.
    assert len(corpus.clean_output(spark, out)) == 2 and not corpus.clean_output(spark, out)
    assert kept(out) == [("b", "four five")] and kept(other) == [("b", "four five")]


def test_a_run_that_fails_leaves_the_old_state_whole(spark, tmp_path, monkeypatch):
    def table(name, rows):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, "src string, tgt string").coalesce(1).write.mode("overwrite").parquet(path)
        return Entry(name, path)

    out = corpus.Output(str(tmp_path / "out"), "en", "am", "text")
    state = lambda: (sorted((r.dataset, r.src, r.tgt) for r in corpus.read_output(spark, out).collect()),
                     sorted((r.lang, r.value) for r in corpus.read_output_lines(spark, out).collect()),
                     sorted((r.dataset_name, r.original, r.run) for r in corpus.read_manifest(spark, out).collect()))
    assert state() == ([], [], [])
    entries = [table("007", [("one two", "xx yyy")]), table("b", [("four five", "uuu vvv")])]
    corpus.process_datasets(spark, entries, out, [])
    before = state()
    assert [r[0] for r in before[0]] == ["007", "b"]

    def fail(*_):
        raise RuntimeError("lost")

    table("007", [("quite new", "other text"), ("more new", "more text")]), table("b", [("same", "same")])
    with monkeypatch.context() as m:
        m.setattr(corpus.files, "write_metadata", fail)  # everything is written but the manifest
        with pytest.raises(RuntimeError, match="lost"):
            corpus.process_datasets(spark, entries, out, [], from_cache=False)
    assert state() == before
    assert corpus.merge_datasets(spark, out).first().total_rows_before_dedup == 2
    assert len(corpus.clean_output(spark, out)) == 1
    assert state() == before
    corpus.process_datasets(spark, entries, out, [], from_cache=False)
    assert [r[1] for r in state()[0]] == ["more new", "quite new"]


def test_names_never_collide():
    named = [name for _, name, _ in named_entries([Entry("x-2"), Entry("x"), Entry("x"), Entry("x")])]
    assert named == ["x-2", "x", "x-2-2", "x-3"]


def test_ids_that_overflow_are_errors(spark):
    at = lambda p: spark.range(1).select(global_id(3, F.lit(p)).alias("i")).first().i
    assert at((1 << 40) - 1) == (4 << 40) - 1 and at((1 << 34) + 5) == (3 << 40) + (1 << 34) + 5
    with pytest.raises(Exception, match="too many rows"):
        at(1 << 40)
    with pytest.raises(ValueError, match="datasets"):
        global_id(1 << 23, F.lit(0))


def test_maps_are_measured(spark):
    df = spark.createDataFrame([({"k": "v" * 100_000},)] * 10, "m map<string, string>")
    assert measured_bytes(df) > 1_000_000


def test_options_of_a_run(spark, tmp_path):
    def table(name, rows):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, "src string, tgt string").coalesce(1).write.parquet(path)
        return Entry(name, path)

    entries = [
        table("a", [("one two three four five", "first text here"), ("other words", "second text here")]),
        table("b", [("third line", "third text here"), ("fourth line", "fourth text here")]),
        table("c", [("fifth line", "fifth text here")]),
    ]
    detector = LanguageProfile.train(
        spark.createDataFrame([("en", "one two three line words"), ("am", "text here first second")], "lang string, text string")
    ).detector(spark.range(1))
    out = corpus.Output(str(tmp_path / "out"), "en", "am")
    summary = {r.dataset: r for r in corpus.process_datasets(spark, entries, out, [], cap=3, report=(detector, detector)).collect()}
    # The cap is met inside the second dataset and does not reach the third: neither is finished.
    assert [summary[d].original for d in ("a", "b", "c", "TOTAL")] == [2, 1, 0, 3] and not summary["a"].cached
    assert [summary[d].complete for d in ("a", "b", "c")] == [True, False, False]
    assert {r.dataset_name for r in corpus.read_manifest(spark, out).collect()} == {"a", "b"}
    report = spark.read.json(f"{out.root}/languages/en-am").collect()
    assert {(r.side, r.dataset) for r in report} == {(s, d) for s in ("src", "tgt") for d in "ab"}
    assert corpus.merge_datasets(spark, out).first().total_rows_before_dedup == 3
    again = {r.dataset: r for r in corpus.process_datasets(spark, entries, out, []).collect()}
    assert {d: r.cached for d, r in again.items()} == {"a": True, "b": False, "c": False, "TOTAL": None}
    assert [again[d].original for d in ("a", "b", "c", "TOTAL")] == [2, 2, 1, 5] and again["c"].complete
    whole = {r.dataset: r.cached for r in corpus.process_datasets(spark, entries, out, [], cap=1).collect()}
    assert whole == {"a": True, "b": True, "c": True, "TOTAL": None}

    test_set = spark.createDataFrame([("one two three four six", "unseen")], "src string, tgt string")
    assert corpus.merge_datasets(spark, out, test_set).first().rows_after_leakage == 5
    near = corpus.merge_datasets(spark, out, test_set, near=0.6).first()
    assert near.rows_after_leakage == 4 and near.processed_at is not None
    assert corpus.merge_datasets(spark, out, excluded=["a"], include_excluded=True).first().total_rows_before_dedup == 5
    # No quality was stored, so a bound on it sets all datasets aside.
    assert corpus.merge_datasets(spark, out, least_quality=0.1).first().total_rows_before_dedup == 0


def test_sample_merge(spark, tmp_path):
    def table(name, n):
        path = str(tmp_path / name)
        spark.createDataFrame([(f"{name} s{i}", f"{name} t{i}") for i in range(n)], "src string, tgt string").write.parquet(path)
        return Entry(name, path)

    entries = [table("x", 20), table("y", 30), table("z", 5)]
    corpora = {"x": Corpus("en", "am", 0.5), "y": Corpus("am", "fr", 7)}
    rows = sample_merge(spark, entries, corpora, "seed", str(tmp_path / "out")).collect()
    assert len(rows) == 17 and len({r.pair_id for r in rows}) == 17
    for r in rows:
        if r.src_lang == "en":
            assert r.sentence_en.startswith("x s") and r.sentence_am.startswith("x t") and r.sentence_fr is None
        else:
            assert r.sentence_am.startswith("y s") and r.sentence_fr.startswith("y t") and r.sentence_en is None
    with pytest.raises(ValueError, match="no catalog entry"):
        sample_merge(spark, entries, {"q": Corpus("en", "am")}, "seed", str(tmp_path / "out"))
