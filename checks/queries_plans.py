"""Stage chain, reports, merge, leakage and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import sql
from checks.queries_rules import COLS, complete
from checks.queries_scores import _text_cosine, profile
from checks.registry import query
from checks.views import labelled_pairs, pairs, pairs_wide, table, test_keys
from pairloom.operators import dedup, leakage, quality, sampling, semantic
from pairloom.operators.language import Side
from pairloom.operators.rules import rule_filter
from pairloom.operators.tagging import tag_languages
from pairloom.plans import corpus, merge, stages
from pairloom.plans import manifest as manifests
from pairloom.plans.sampled import Corpus, sample_and_tag
from pairloom.session import staging_folder
from pairloom.sources.catalog import Entry

# --- stage chain --------------------------------------------------------------

STAGED = f"""{sql.PAIRS},{sql.ruled('dataset,')},{_text_cosine('ruled')},
alike AS (SELECT r.pair_id, dataset, replace(src, chr(10), ' ') AS src, replace(tgt, chr(10), ' ') AS tgt
            FROM ruled r JOIN text_sim USING (pair_id) WHERE cos > 0.7),
{sql.profile('p3', 3)},
{sql.detect('dsrc', 'alike', 'pair_id', 'src', 'p3', 3)},
{sql.detect('dtgt', 'alike', 'pair_id', 'tgt', 'p3', 3)},
spoken AS (SELECT p.* FROM alike p JOIN dsrc s ON s.k = pair_id JOIN dtgt t ON t.k = pair_id
           WHERE s.code IN ('en', 'fr') AND s.score >= 0.6 AND t.code IN ('en', 'fr') AND t.score >= 0.6),
{sql.QUALITY_TABLE},
binned AS ({sql.bins('spoken', 'pair_id, dataset, src, tgt')}),
good AS (SELECT b.* FROM binned b JOIN quality_table USING (ratio_bin, size_bin) WHERE q >= 0.8)"""

FUNNEL = f"""{STAGED},
funnel AS (
  SELECT dataset, original, coalesce(r, 0) AS after_rule, coalesce(s, 0) AS after_semantic,
         coalesce(l, 0) AS after_language, coalesce(g, 0) AS after_quality
  FROM (SELECT dataset, count(*) AS original FROM pw GROUP BY dataset)
  LEFT JOIN (SELECT dataset, count(*) AS r FROM ruled GROUP BY dataset) USING (dataset)
  LEFT JOIN (SELECT dataset, count(*) AS s FROM alike GROUP BY dataset) USING (dataset)
  LEFT JOIN (SELECT dataset, count(*) AS l FROM spoken GROUP BY dataset) USING (dataset)
  LEFT JOIN (SELECT dataset, count(*) AS g FROM good GROUP BY dataset) USING (dataset))"""


def standard_stages(spark: SparkSession, sf_dir: str) -> list[stages.Stage]:
    detector = profile(spark, sf_dir).detector(table(spark, sf_dir, "documents"))
    learned = quality.train_quality(labelled_pairs(spark, sf_dir), "quality")
    side = Side(["en", "fr"], 0.6)
    return [
        stages.semantic_stage(semantic.gram_similarity(), 0.7),
        stages.language_stage((detector, detector), side, side),
        stages.quality_stage(learned, 0.8),
    ]


@query("stages_end_to_end", f"WITH {STAGED} SELECT {COLS} FROM good")
def stages_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.keep_survivors(pairs(spark, sf_dir), standard_stages(spark, sf_dir))


def _funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = standard_stages(spark, sf_dir)
    all_pairs = pairs(spark, sf_dir)
    return stages.stage_funnel(all_pairs, stages.flag_stages(all_pairs, chain), chain)


@query("funnel_by_dataset", f"WITH {FUNNEL} SELECT * FROM funnel")
def funnel_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _funnel(spark, sf_dir)


@query("funnel_rollup", f"""
WITH {FUNNEL},
scores AS (SELECT dataset, round(avg(quality::DOUBLE), 4) AS quality_score
           FROM full_pairs JOIN labels USING (doc_id) GROUP BY dataset)
SELECT f.*, quality_score FROM funnel f LEFT JOIN scores USING (dataset)
UNION ALL SELECT 'TOTAL', sum(original)::BIGINT, sum(after_rule)::BIGINT, sum(after_semantic)::BIGINT,
                 sum(after_language)::BIGINT, sum(after_quality)::BIGINT, NULL FROM funnel""")
def funnel_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.corpus_quality(labelled_pairs(spark, sf_dir))
    return stages.with_total(_funnel(spark, sf_dir), scores)


@query("dataset_metadata", f"""
WITH {sql.PAIRS},
steps AS (SELECT doc_id::VARCHAR AS dataset_name, count(*) AS original, count(tgt) AS after_rule,
                 count(CASE WHEN NOT {sql.RATIO} THEN 1 END) AS after_semantic,
                 count(CASE WHEN NOT {sql.RATIO} AND length(src) > 200 THEN 1 END) AS after_language,
                 count(CASE WHEN NOT {sql.RATIO} AND length(src) > 400 THEN 1 END) AS after_quality
          FROM pw GROUP BY doc_id)
SELECT 'hf' AS source, dataset_name, 'en-am' AS lang_pair, original, after_rule, after_semantic, after_language,
       after_quality, NULL::DOUBLE AS quality_score, TIMESTAMP '2025-01-01 00:00:00' AS processed_at, false AS legacy FROM steps
UNION ALL
SELECT 'hf', dataset_name, 'en-am', original, coalesce(nullif(after_rule, 0), original),
       coalesce(nullif(after_semantic, 0), nullif(after_rule, 0), original),
       coalesce(nullif(after_language, 0), nullif(after_semantic, 0), nullif(after_rule, 0), original),
       coalesce(nullif(after_quality, 0), nullif(after_language, 0), nullif(after_semantic, 0), nullif(after_rule, 0), original),
       NULL, TIMESTAMP '2025-01-01 00:00:00', true FROM steps""")
def dataset_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a dataset, so that many counts are zero; length steps stand in for
    the scored stages."""
    from pairloom.operators.rules import breaks_token_ratio

    even = ~breaks_token_ratio()
    counted = pairs_wide(spark, sf_dir).groupBy(F.col("doc_id").cast("string").alias("dataset")).agg(
        F.count(F.lit(1)).alias("original"),
        F.count("tgt").alias("after_rule"),
        F.count(F.when(even, 1)).alias("after_semantic"),
        F.count(F.when(even & (F.length("src") > 200), 1)).alias("after_language"),
        F.count(F.when(even & (F.length("src") > 400), 1)).alias("after_quality"),
    )
    summary = counted.withColumns({"source": F.lit("hf"), "quality_score": F.lit(None).cast("double")})
    at = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    parts = [
        manifests.dataset_metadata(summary, "en-am", at, legacy).withColumn("legacy", F.lit(legacy))
        for legacy in (False, True)
    ]
    return parts[0].unionByName(parts[1])


FINISHED = """
finished AS (SELECT source AS dataset_name, avg(quality::DOUBLE) < 0.85 AS excluded,
                    round(avg(quality::DOUBLE), 4) AS quality_score
             FROM documents JOIN labels USING (doc_id) GROUP BY source HAVING count(*) % 2 = 0)"""


def finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest: sources with an even number of labels count as finished, those of low
    quality as set aside."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("dataset_name"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("q"))
    stats = docs.join(labels, "doc_id").groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("n"), F.avg("q").alias("mean")
    )
    return stats.where("n % 2 = 0").select(
        "dataset_name", (F.col("mean") < 0.85).alias("excluded"), F.round("mean", 4).alias("quality_score")
    )


@query("incremental_skip", f"""
WITH {sql.PAIRS},{sql.ruled('dataset,')},{FINISHED}
SELECT dataset_name, -1::BIGINT AS rows, true AS cached FROM finished
UNION ALL
SELECT d.source, count(r.pair_id), false FROM (SELECT DISTINCT source FROM documents) d
LEFT JOIN ruled r ON r.dataset = d.source WHERE d.source NOT IN (SELECT dataset_name FROM finished) GROUP BY d.source""")
def incremental_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only datasets without metadata are processed; the others show their stored count."""
    catalog = table(spark, sf_dir, "documents").select(F.col("source").alias("dataset")).distinct()
    stored = finished(spark, sf_dir).select("dataset_name", F.lit(-1).cast("bigint").alias("rows"))
    todo = manifests.still_to_do(catalog, stored)
    work = pairs(spark, sf_dir).join(todo, "dataset", "left_semi")
    counts = rule_filter(work).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))
    new = todo.join(counts, "dataset", "left").select(
        F.col("dataset").alias("dataset_name"), F.coalesce("n", F.lit(0).cast("bigint")).alias("rows")
    )
    return manifests.merged_summary(stored, new)


# --- merge --------------------------------------------------------------------


@query("merge_union", f"""
WITH {sql.PAIRS},{FINISHED}
SELECT {COLS} FROM pw WHERE dataset IN (SELECT dataset_name FROM finished WHERE NOT excluded)""")
def merge_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.finished_pairs(pairs(spark, sf_dir), finished(spark, sf_dir))


@query("dedup_identical", f"WITH {sql.PAIRS} SELECT {COLS} FROM pw WHERE src IS DISTINCT FROM tgt")
def dedup_identical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.drop_identical(pairs(spark, sf_dir))


def _first(keys: str) -> str:
    return f"""
WITH {sql.PAIRS} SELECT {COLS} FROM pw WHERE src IS DISTINCT FROM tgt
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY pair_id) = 1"""


@query("dedup_pair", _first("src, tgt"))
def dedup_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_per_pair(dedup.drop_identical(pairs(spark, sf_dir)))


@query("dedup_source", _first("src"))
def dedup_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_per_source(dedup.drop_identical(pairs(spark, sf_dir)))


@query("dedup_target", _first("tgt"))
def dedup_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_per_target(dedup.drop_identical(pairs(spark, sf_dir)))


@query("dedup_all", f"WITH {sql.MERGED} SELECT {COLS} FROM by_tgt")
def dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate(complete(spark, sf_dir))


@query("dedup_counts", f"""
WITH {sql.MERGED}
SELECT 0 AS step_no, 'input' AS step, (SELECT count(*) FROM full_pairs) AS rows
UNION ALL SELECT 1, 'drop_identical', (SELECT count(*) FROM ds)
UNION ALL SELECT 2, 'first_per_pair', (SELECT count(*) FROM (SELECT DISTINCT src, tgt FROM ds))
UNION ALL SELECT 3, 'first_per_source', (SELECT count(*) FROM by_src)
UNION ALL SELECT 4, 'first_per_target', (SELECT count(*) FROM by_tgt)""")
def dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_counts(complete(spark, sf_dir))


@query("leakage_filter", f"""
WITH {sql.PAIRS},{sql.TEST_KEYS}
SELECT {COLS} FROM pw WHERE src NOT IN (SELECT k FROM test_keys) AND (tgt IS NULL OR tgt NOT IN (SELECT k FROM test_keys))""")
def leakage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.drop_leaked(pairs(spark, sf_dir), test_keys(spark, sf_dir))


def _near(side: str) -> str:
    return f"""
{side}_w AS (SELECT pair_id, list_distinct([x for x in string_split({side}, ' ') if x <> '']) AS ws FROM full_pairs),
{side}_hit AS (SELECT DISTINCT pair_id FROM (
   SELECT pair_id, k, n, tn, count(*) AS shared FROM
     (SELECT pair_id, len(ws) AS n, unnest(ws) AS w FROM {side}_w) JOIN
     (SELECT k, len(ws) AS tn, unnest(ws) AS w FROM test_w) USING (w) GROUP BY ALL)
   WHERE shared / (n + tn - shared)::DOUBLE > 0.5)"""


@query("leakage_fuzzy", f"""
WITH {sql.PAIRS},{sql.TEST_KEYS},
test_w AS (SELECT k, list_distinct([x for x in string_split(k, ' ') if x <> '']) AS ws FROM test_keys),{_near('src')},{_near('tgt')}
SELECT {COLS} FROM full_pairs WHERE pair_id NOT IN (SELECT pair_id FROM src_hit)
  AND pair_id NOT IN (SELECT pair_id FROM tgt_hit)""")
def leakage_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.drop_near_leaked(complete(spark, sf_dir), test_keys(spark, sf_dir), threshold=0.5).select(
        "pair_id", "dataset", "src", "tgt"
    )


@query("merged_corpus", f"""
WITH {sql.MERGED},{sql.TEST_KEYS}
SELECT {COLS} FROM by_tgt WHERE src NOT IN (SELECT k FROM test_keys) AND tgt NOT IN (SELECT k FROM test_keys)""")
def merged_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_corpus(complete(spark, sf_dir), test_keys(spark, sf_dir))[1]


@query("merge_metadata", f"""
WITH {sql.PAIRS},{sql.TEST_KEYS},{FINISHED},
listed AS (SELECT * FROM full_pairs WHERE dataset IN (SELECT dataset_name FROM finished WHERE NOT excluded)),
{sql.deduplicated('listed')},
inc AS (SELECT dataset AS dataset_name, count(*) AS rows FROM listed GROUP BY dataset)
SELECT inc.dataset_name, rows, quality_score, (SELECT count(*) FROM listed) AS total_rows_before_dedup,
       (SELECT count(*) FROM by_tgt) AS total_rows_after_dedup,
       (SELECT count(*) FROM by_tgt WHERE src NOT IN (SELECT k FROM test_keys) AND tgt NOT IN (SELECT k FROM test_keys)) AS rows_after_leakage,
       TIMESTAMP '2025-01-01 00:00:00' AS processed_at
FROM inc LEFT JOIN finished USING (dataset_name)""")
def merge_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the finished datasets that are not set aside, as the merge takes them."""
    manifest = finished(spark, sf_dir)
    listed = merge.finished_pairs(complete(spark, sf_dir), manifest)
    deduplicated, final = merge.merge_corpus(listed, test_keys(spark, sf_dir))
    at = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    one = merge.merge_metadata(merge.included_datasets(listed, manifest), "en-am", deduplicated, final, at)
    totals = [c for c in one.columns if "rows" in c]
    return one.select(F.inline("included_datasets"), *totals, "processed_at")


# --- whole runs ---------------------------------------------------------------

RUN_PAIRS = f"""{sql.PAIRS},{sql.ruled('dataset,')},{sql.TEST_KEYS}"""


def _sources(spark: SparkSession, sf_dir: str, save_format: str = "parquet") -> tuple[list[Entry], corpus.Output]:
    """Every source as a dataset of its own, and a place for the output."""
    root = staging_folder(spark)
    # Ranges of (dataset, pair_id): the files of a dataset follow the order of its rows.
    placed = pairs(spark, sf_dir).repartitionByRange("dataset", "pair_id").sortWithinPartitions("dataset", "pair_id")
    placed.write.partitionBy("dataset").parquet(f"{root}/sources")
    names = [r.source for r in table(spark, sf_dir, "documents").select("source").distinct().orderBy("source").collect()]
    entries = [Entry(name, f"{root}/sources/dataset={name}") for name in names]
    return entries, corpus.Output(f"{root}/out", "en", "am", save_format)


def _two_runs(spark: SparkSession, sf_dir: str, save_format: str) -> corpus.Output:
    """The first half of the sources processed, then all."""
    entries, output = _sources(spark, sf_dir, save_format)
    for known in (entries[: len(entries) // 2], entries):
        if known:
            corpus.process_datasets(spark, known, output, [])
    return output


@query("run_incremental_parquet", f"""
WITH {RUN_PAIRS},
ds AS (SELECT dataset, pair_id, src, tgt FROM ruled WHERE src <> tgt),
by_src AS (SELECT * FROM ds QUALIFY row_number() OVER (PARTITION BY src ORDER BY dataset, pair_id) = 1),
by_tgt AS (SELECT * FROM by_src QUALIFY row_number() OVER (PARTITION BY tgt ORDER BY dataset, pair_id) = 1)
SELECT dataset, src AS en, tgt AS am FROM by_tgt
WHERE src NOT IN (SELECT k FROM test_keys) AND tgt NOT IN (SELECT k FROM test_keys)""")
def run_incremental_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a growing catalog, then the merge of what both left."""
    output = _two_runs(spark, sf_dir, "parquet")
    corpus.merge_datasets(spark, output, test_keys(spark, sf_dir))
    return spark.read.parquet(f"{output.root}/merged_en-am").select("dataset", "en", "am")


@query("run_incremental_text", f"""
WITH {RUN_PAIRS}
SELECT 'en' AS lang, dataset, replace(replace(src, chr(13), ' '), chr(10), ' ') AS line FROM ruled
UNION ALL SELECT 'am', dataset, replace(replace(tgt, chr(13), ' '), chr(10), ' ') FROM ruled""")
def run_incremental_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text files that two runs over a growing catalog leave."""
    output = _two_runs(spark, sf_dir, "text")
    return corpus.read_output_lines(spark, output).withColumnRenamed("value", "line")


@query("run_capped_then_lifted", f"""
WITH {RUN_PAIRS},
placed AS (SELECT dataset, row_number() OVER (ORDER BY dataset, pair_id) AS n FROM pw),
capped AS (SELECT dataset, count(*) FILTER (WHERE n <= 5000) AS first_rows, count(*) AS all_rows FROM placed GROUP BY dataset),
kept AS (SELECT dataset, count(*) AS n FROM ruled GROUP BY dataset)
SELECT dataset, first_rows, first_rows = all_rows AS first_complete, all_rows, coalesce(n, 0) AS kept_rows,
       true AS complete, first_rows = all_rows AS cached
FROM capped LEFT JOIN kept USING (dataset)""")
def run_capped_then_lifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run with a cap, then one without: what the cap cut short or did not reach is processed whole."""
    entries, output = _sources(spark, sf_dir)
    first = corpus.process_datasets(spark, entries, output, [], cap=5000)
    first = first.select("dataset", F.col("original").alias("first_rows"), F.col("complete").alias("first_complete"))
    first = spark.createDataFrame(first.collect(), first.schema)  # a row per source, before the next run changes them
    then = corpus.process_datasets(spark, entries, output, []).where("source IS NOT NULL")
    stored = corpus.read_output(spark, output).groupBy("dataset").agg(F.count(F.lit(1)).alias("kept_rows"))
    joined = then.join(first, "dataset").join(stored, "dataset", "left").na.fill(0, ["kept_rows"])
    return joined.select("dataset", "first_rows", "first_complete", F.col("original").alias("all_rows"), "kept_rows", "complete", "cached")


# --- sampling and tagging -----------------------------------------------------


@query("sample_fraction", f"""
WITH {sql.PAIRS} SELECT {COLS} FROM pw
QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY md5('seed:' || pair_id::VARCHAR), pair_id)
        <= floor(0.3::DOUBLE * count(*) OVER (PARTITION BY dataset))""")
def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample(pairs(spark, sf_dir), 0.3, "seed")


@query("sample_count", f"""
WITH {sql.PAIRS} SELECT {COLS} FROM pw
QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY md5('seed:' || pair_id::VARCHAR), pair_id)
        <= CASE WHEN dataset = 'src1' THEN 5 WHEN dataset = 'src2' THEN 1000000 WHEN dataset = 'src3' THEN 0
                WHEN dataset = 'src4' THEN floor(0.5::DOUBLE * count(*) OVER (PARTITION BY dataset))
                ELSE count(*) OVER (PARTITION BY dataset) END""")
def sample_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = {"src1": 5, "src2": 1_000_000, "src3": 0, "src4": 0.5, "src5": None}
    return sampling.sample(pairs(spark, sf_dir), sizes, "seed")


@query("row_cap", f"WITH {sql.PAIRS} SELECT {COLS} FROM pw QUALIFY row_number() OVER (ORDER BY pair_id) <= 5000")
def row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.row_cap(pairs(spark, sf_dir), 5000)


@query("tag_languages", f"""
WITH {sql.PAIRS} SELECT pair_id, src AS "sentence_eng_Latn", tgt AS "sentence_amh_Ethi",
'eng_Latn' AS src_lang, 'amh_Ethi' AS tgt_lang FROM pw""")
def tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_languages(pairs(spark, sf_dir), "eng_Latn", "amh_Ethi", keep=["pair_id"])


@query("merge_sample_union", f"""
WITH {sql.PAIRS},
picked AS (SELECT * FROM pw QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('seed:' || pair_id::VARCHAR), pair_id)
           <= CASE lang WHEN 'en' THEN count(*) OVER (PARTITION BY lang)
                        WHEN 'fr' THEN floor(0.5::DOUBLE * count(*) OVER (PARTITION BY lang)) ELSE 40 END)
SELECT pair_id, CASE WHEN lang IN ('en', 'fr') THEN src WHEN lang = 'de' THEN tgt END AS "sentence_eng_Latn",
       CASE WHEN lang = 'en' THEN tgt WHEN lang = 'de' THEN src END AS "sentence_amh_Ethi",
       CASE WHEN lang = 'fr' THEN tgt WHEN lang = 'es' THEN tgt END AS "sentence_swa_Latn",
       CASE WHEN lang = 'es' THEN src END AS "sentence_som_Latn",
       CASE lang WHEN 'en' THEN 'eng_Latn' WHEN 'fr' THEN 'eng_Latn' WHEN 'de' THEN 'amh_Ethi' ELSE 'som_Latn' END AS src_lang,
       CASE lang WHEN 'en' THEN 'amh_Ethi' WHEN 'fr' THEN 'swa_Latn' WHEN 'de' THEN 'eng_Latn' ELSE 'swa_Latn' END AS tgt_lang
FROM picked""")
def merge_sample_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four corpora, one per language of the documents, each with its own tags and size."""
    corpora = {
        "en": Corpus("eng_Latn", "amh_Ethi", 1.0),
        "fr": Corpus("eng_Latn", "swa_Latn", 0.5),
        "de": Corpus("amh_Ethi", "eng_Latn", 40),
        "es": Corpus("som_Latn", "swa_Latn", 40),
    }
    wide = pairs_wide(spark, sf_dir)
    return sample_and_tag(wide.select("pair_id", F.col("lang").alias("dataset"), "src", "tgt"), corpora, "seed")
