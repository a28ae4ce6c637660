"""Scores, scored filters and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import sql
from checks.queries_rules import complete
from checks.registry import query
from checks.views import documents, labelled_pairs, pairs, pairs_wide, quality_by_document, table, vector_pairs
from pairloom.functions.fixed_values import ENCODER_FAMILIES
from pairloom.functions.vectors import cosine
from pairloom.operators import language, quality, semantic
from pairloom.operators.joins import lookup_join
from pairloom.operators.language import LanguageProfile, Side
from pairloom.operators.scoring import attach_score


def profile(spark: SparkSession, sf_dir: str, n: int = 3) -> LanguageProfile:
    return LanguageProfile.train(documents(spark, sf_dir), n=n)


def vector_text(name: str) -> F.Column:
    whole = F.transform(name, lambda x: x.cast("int").cast("string"))
    return F.array_join(whole, ",").alias(name)


def _vector_sql(side: str) -> str:
    return f"""
(SELECT k, string_agg(v::INT::VARCHAR, ',' ORDER BY d) AS vec FROM (
   SELECT p.pair_id AS k, r.d, coalesce(e.v, 0) AS v FROM full_pairs p CROSS JOIN (SELECT unnest(range(64)) AS d) r
   LEFT JOIN {side} e ON e.k = p.pair_id AND e.d = r.d) GROUP BY k)"""


@query("score_embed", f"""
WITH {sql.PAIRS},{sql.embed('es', 'full_pairs', 'pair_id', 'src')},{sql.embed('et', 'full_pairs', 'pair_id', 'tgt')}
SELECT s.k AS pair_id, s.vec AS src_vector, t.vec AS tgt_vector
FROM {_vector_sql('es')} s JOIN {_vector_sql('et')} t USING (k)""")
def score_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    encode = semantic.gram_encoder()
    vectors = complete(spark, sf_dir).select("pair_id", encode("src").alias("src_vector"), encode("tgt").alias("tgt_vector"))
    return vectors.select("pair_id", vector_text("src_vector"), vector_text("tgt_vector"))


COSINE = """
sim AS (SELECT a.vec_id AS src_id, b.vec_id AS tgt_id,
  list_sum([x[1]::DOUBLE * x[2]::DOUBLE for x in list_zip(a.embedding, b.embedding)]) /
  sqrt(list_sum([x::DOUBLE * x::DOUBLE for x in a.embedding]) * list_sum([x::DOUBLE * x::DOUBLE for x in b.embedding])) AS cos
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


@query("score_cosine", f"WITH {COSINE} SELECT src_id, tgt_id, round(cos, 6) AS similarity FROM sim")
def score_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, vectors = vector_pairs(spark, sf_dir)
    a = vectors.select(F.col("vector_id").alias("src_id"), F.col("vector").alias("a"))
    b = vectors.select(F.col("vector_id").alias("tgt_id"), F.col("vector").alias("b"))
    both = ids.join(a, "src_id").join(b, "tgt_id")
    return both.select("src_id", "tgt_id", F.round(cosine("a", "b"), 6).alias("similarity"))


@query("semantic_filter", f"WITH {COSINE} SELECT src_id, tgt_id FROM sim WHERE cos > 0.2")
def semantic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, vectors = vector_pairs(spark, sf_dir)
    return semantic.semantic_filter_by_table(ids, vectors, "src_id", "tgt_id", threshold=0.2)


def _text_cosine(rel: str) -> str:
    return f"""{sql.embed('es', rel, 'pair_id', 'src')},{sql.embed('et', rel, 'pair_id', 'tgt')},
dots AS (SELECT k, sum(es.v * et.v) AS dot FROM es JOIN et USING (k, d) GROUP BY k),
ns AS (SELECT k, sum(v * v) AS n FROM es GROUP BY k), nt AS (SELECT k, sum(v * v) AS n FROM et GROUP BY k),
text_sim AS (SELECT p.pair_id, CASE WHEN ns.n IS NULL OR nt.n IS NULL THEN 0
                    ELSE coalesce(dot, 0) / sqrt(ns.n * nt.n) END AS cos
             FROM {rel} p LEFT JOIN dots ON dots.k = pair_id LEFT JOIN ns ON ns.k = pair_id LEFT JOIN nt ON nt.k = pair_id)"""


@query("semantic_filter_text", f"""
WITH {sql.PAIRS},{_text_cosine('full_pairs')}
SELECT p.pair_id, dataset, src, tgt FROM full_pairs p JOIN text_sim USING (pair_id) WHERE cos > 0.7""")
def semantic_filter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts encoded on the way by the built-in encoder."""
    encode = semantic.gram_encoder()
    encoded = complete(spark, sf_dir).withColumns({"a": encode("src"), "b": encode("tgt")})
    return semantic.semantic_filter(encoded, "a", "b").drop("a", "b")


ROUTES = """
coded AS (SELECT p.pair_id, p.src, p.tgt, p.lang AS src_lang, coalesce(d.lang, p.lang) AS tgt_lang
          FROM full_pairs p LEFT JOIN documents d ON d.doc_id = p.doc_id + 1)"""


@query("semantic_routed", f"""
WITH {sql.PAIRS},{ROUTES},
routed AS (SELECT pair_id, src, tgt, {sql.encoder_case()} AS encoder FROM coded),{_text_cosine('routed')}
SELECT pair_id, encoder, round(CASE WHEN encoder IS NOT NULL THEN cos END, 6) AS similarity
FROM routed JOIN text_sim USING (pair_id)""")
def semantic_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs tagged with the languages of a document and the next, scored by their own family."""
    langs = table(spark, sf_dir, "documents").select((F.col("doc_id") - 1).alias("doc_id"), F.col("lang").alias("next"))
    wide = pairs_wide(spark, sf_dir).where("tgt is not null")
    coded = lookup_join(wide, langs.withColumnRenamed("doc_id", "of"), "doc_id", "of", "left").withColumns(
        {"src_lang": F.col("lang"), "tgt_lang": F.coalesce("next", "lang")}
    )
    routed = semantic.route_encoders(coded)
    scorers = {family: semantic.gram_similarity() for family in ENCODER_FAMILIES}
    score = F.round(semantic.routed_similarity(routed, scorers), 6)
    return routed.select("pair_id", "encoder", score.alias("similarity"))


@query("encoder_route", f"""
WITH coded AS (SELECT a.doc_id AS pair_id, a.lang AS src_lang, coalesce(b.lang, a.source) AS tgt_lang
               FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 1),
routed AS (SELECT *, {sql.encoder_case()} AS encoder FROM coded)
SELECT *, CASE WHEN length(src_lang) > 2 OR length(tgt_lang) > 2 THEN 'code_too_long'
               WHEN encoder IS NULL THEN 'pair_not_supported' ELSE 'ok' END AS status FROM routed""")
def encoder_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A document with the next one; the last has none, and its source is no language code.
    docs = table(spark, sf_dir, "documents")
    following = docs.select((F.col("doc_id") - 1).alias("pair_id"), F.col("lang").alias("next_lang"))
    coded = docs.withColumnRenamed("doc_id", "pair_id").join(following, "pair_id", "left").select(
        "pair_id", F.col("lang").alias("src_lang"), F.coalesce("next_lang", "source").alias("tgt_lang")
    )
    return semantic.route_encoders(coded)


@query("lang_detect", f"""
WITH {sql.PAIRS},{sql.profile('p3', 3)},{sql.detect('det', 'pw', 'pair_id', 'src', 'p3', 3)}
SELECT k AS pair_id, code, round(score, 6) AS score FROM det""")
def lang_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    detector = profile(spark, sf_dir).detector(table(spark, sf_dir, "documents"))
    found = pairs(spark, sf_dir).select("pair_id", detector("src").alias("d"))
    return found.select("pair_id", "d.code", F.round("d.score", 6).alias("score"))


@query("lang_newline_clean", f"""
SELECT doc_id AS pair_id, replace(text, chr(10), ' ') AS src, source AS tgt FROM documents""")
def lang_newline_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pair_id"), F.col("text").alias("src"), F.col("source").alias("tgt")
    )
    return language.clean_newlines(docs)


def _lang_filter_sql(tgt_n: int, tgt_codes: str) -> str:
    second = "" if tgt_n == 3 else "," + sql.profile("p2", tgt_n)
    weights = "p3" if tgt_n == 3 else "p2"
    return f"""
WITH {sql.PAIRS},{sql.profile('p3', 3)}{second},
{sql.detect('dsrc', 'full_pairs', 'pair_id', 'src', 'p3', 3)},
{sql.detect('dtgt', 'full_pairs', 'pair_id', 'tgt', weights, tgt_n)}
SELECT p.pair_id, dataset, src, tgt FROM full_pairs p
JOIN dsrc s ON s.k = p.pair_id JOIN dtgt t ON t.k = p.pair_id
WHERE s.code = 'en' AND s.score >= 0.6 AND t.code IN ({tgt_codes}) AND t.score >= 0.9"""


@query("lang_filter", _lang_filter_sql(3, "'en', 'fr'"))
def lang_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    detector = profile(spark, sf_dir).detector(table(spark, sf_dir, "documents"))
    return language.language_filter(
        complete(spark, sf_dir), detector, detector, Side("en", 0.6), Side(["en", "fr"], 0.9)
    )


@query("lang_filter_two_models", _lang_filter_sql(2, "'en'"))
def lang_filter_two_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.language_filter(
        complete(spark, sf_dir), profile(spark, sf_dir, 3).detector(docs), profile(spark, sf_dir, 2).detector(docs),
        Side("en", 0.6), Side("en", 0.9),
    )


@query("language_report", f"""
WITH {sql.PAIRS},{sql.profile('p3', 3)},{sql.detect('det', 'pw', 'pair_id', 'src', 'p3', 3)},
counts AS (SELECT dataset, code, count(*) AS rows FROM pw JOIN det ON k = pair_id GROUP BY dataset, code)
SELECT dataset, code, rows, round(rows / (sum(rows) OVER (PARTITION BY dataset))::DOUBLE, 6) AS share FROM counts""")
def language_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    detector = profile(spark, sf_dir).detector(table(spark, sf_dir, "documents"))
    detected = pairs(spark, sf_dir).select("dataset", detector("src").alias("d")).select("dataset", "d.code")
    return language.language_report(detected, "code")


@query("score_quality", f"""
WITH {sql.PAIRS},{sql.QUALITY_TABLE},
binned AS ({sql.bins('full_pairs', 'pair_id')})
SELECT pair_id, round(coalesce(q, 0.5), 6) AS quality FROM binned LEFT JOIN quality_table USING (ratio_bin, size_bin)""")
def score_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = quality.train_quality(labelled_pairs(spark, sf_dir), "quality")
    scored = quality.score_quality(complete(spark, sf_dir).select("pair_id", "src", "tgt"), learned)
    return scored.select("pair_id", F.round("quality", 6).alias("quality"))


def scored_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with the label of their document as score; null where there is no label."""
    complete_pairs = pairs_wide(spark, sf_dir).where("tgt is not null").select("pair_id", "dataset", "doc_id", "src", "tgt")
    return attach_score(complete_pairs, "quality", quality_by_document(spark, sf_dir), on="doc_id")


@query("quality_filter", f"WITH {sql.PAIRS},{sql.LABELLED} SELECT pair_id, dataset, src, tgt FROM labelled WHERE quality >= 0.7")
def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = scored_by_label(spark, sf_dir).transform(quality.quality_filter)
    return kept.select("pair_id", "dataset", "src", "tgt")


@query("corpus_quality", f"""
WITH {sql.PAIRS} SELECT dataset, round(avg(quality::DOUBLE), 4) AS quality_score
FROM full_pairs LEFT JOIN labels USING (doc_id) GROUP BY dataset""")
def corpus_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.corpus_quality(scored_by_label(spark, sf_dir))


@query("dataset_quality_gate", f"""
WITH {sql.PAIRS}, good AS (SELECT dataset FROM full_pairs LEFT JOIN labels USING (doc_id)
                           GROUP BY dataset HAVING avg(quality::DOUBLE) >= 0.85)
SELECT pair_id, dataset, src, tgt FROM full_pairs SEMI JOIN good USING (dataset)""")
def dataset_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quality.quality_gate(scored_by_label(spark, sf_dir), 0.85)
    return kept.select("pair_id", "dataset", "src", "tgt")
