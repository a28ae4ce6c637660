"""One query per operator over the given tables, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import (
    bpe, decontaminate, fingerprints, hard_negatives, language_model, line_runs, near_duplicates, quality, repeats, secrets,
    token_alignment, url_filter, warc,
)
from pairloom.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, "url", rules).select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
ORACLES["op1_url_filter"] = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
tails AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages),
hosts AS (SELECT page_id, tail, regexp_extract(tail, '^[^/?#]*') AS raw FROM tails),
parts AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(tail, length(raw) + 1), '^[^?#]*') AS path FROM hosts)
SELECT page_id, host, path,
       max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       coalesce(max_by(verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM parts LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""


@query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates.near_duplicates(docs).select("doc_id", "class_id", "n_links", "n_copies", "representative")


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = secrets.find_secrets(docs, "doc_id", "text", F.concat_ws("/", "source", "lang"), F.col("source"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    state = lambda name: F.size(F.filter("spans", lambda s: s["state"] == name)).cast("bigint").alias(f"n_{name}")
    base = F.filter("spans", lambda s: s["kind"] != "bare")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.joined_spans(base), 256).alias("base_sha256"), secrets.joined_spans(F.col("spans")).alias("spans"),
        count("bare"), state("live"), state("example"))


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_following(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.decode_ids(bpe.encode_texts(docs, "text", path), "ids", path)
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    files = warc.write_archives(pages, "page_id", "url", "html")
    return warc.read_archives(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op9_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM g
"""


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, "text", spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("found.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "found.n_words", n_hit.alias("n_hit"), F.size("found.items").cast("bigint").alias("n_items"),
        decontaminate.ids_digest(F.col("found.items")).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query
def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return language_model.score_documents(docs).select(
        "doc_id", "n_words", "n_backed_off", F.round("log10_score", 4).alias("log10_score"))


@query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = token_alignment.align_tokens(
        docs, "doc_id", "text", public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = line_runs.file_batches(spark, f"{sf_dir}/documents.parquet")
    settled = line_runs.repeated_lines([b.select("doc_id", "text") for b in batches], "doc_id", "text")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.drop_lines(docs, "doc_id", "text", settled).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLES["op12_line_dedup"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
judged AS (
  SELECT k.*, coalesce(k.doc_id < o.keeper, o.keeper IS NOT NULL) AS gone FROM keyed k LEFT JOIN often o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.select("vec_id", noisy.alias("label"), "embedding")
    return hard_negatives.mine_hard_negatives(vectors, "vec_id", "label", "embedding", F.col("vec_id") % 50 == 0)


ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS codes
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_dot_product(a.codes, b.codes)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.codes) = len(b.codes)),
positives AS (
  SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n
  ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
