"""Rule filter steps, the composite, and its funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import sql
from checks.registry import query
from checks.views import pairs, table
from pairloom.functions.text import clean_markup, collapse_spaces
from pairloom.operators import rules

COLS = "pair_id, dataset, src, tgt"


def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.drop_null(pairs(spark, sf_dir))


def kept_where_not(condition: str) -> str:
    return f"WITH {sql.PAIRS} SELECT {COLS} FROM full_pairs WHERE NOT {condition}"


@query("rule_drop_null", f"WITH {sql.PAIRS} SELECT {COLS} FROM full_pairs")
def rule_drop_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete(spark, sf_dir)


@query("rule_distinct_pairs", f"""
WITH {sql.PAIRS} SELECT {COLS} FROM full_pairs
QUALIFY row_number() OVER (PARTITION BY src, tgt ORDER BY pair_id) = 1""")
def rule_distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete(spark, sf_dir).transform(rules.distinct_pairs)


@query("rule_drop_identical", kept_where_not(f"({sql.IDENTICAL})"))
def rule_drop_identical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete(spark, sf_dir).transform(rules.drop_identical)


@query("rule_token_ratio", kept_where_not(sql.RATIO))
def rule_token_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete(spark, sf_dir).transform(rules.drop_token_ratio)


@query("rule_max_tokens", kept_where_not(sql.MAX_TOKENS))
def rule_max_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete(spark, sf_dir).transform(rules.drop_max_tokens)


@query("rule_min_chars", kept_where_not(sql.MIN_CHARS))
def rule_min_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete(spark, sf_dir).transform(rules.drop_min_chars)


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("src"), F.col("url").alias("tgt"))


@query("rule_clean_markup", f"""
SELECT page_id, regexp_replace(html, '{sql.MARKUP}', ' ', 'g') AS src,
       regexp_replace(url, '{sql.MARKUP}', ' ', 'g') AS tgt FROM pages""")
def rule_clean_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(spark, sf_dir).transform(rules.clean_markup)


@query("rule_collapse_spaces", f"SELECT page_id, {sql.clean('html')} AS src, {sql.clean('url')} AS tgt FROM pages")
def rule_collapse_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(spark, sf_dir).transform(rules.clean_markup).transform(rules.collapse_spaces)


@query("rule_lowercase", f"WITH {sql.PAIRS} SELECT pair_id, dataset, lower(src) AS src, lower(tgt) AS tgt FROM pw")
def rule_lowercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).transform(rules.lowercase)


@query("rule_drop_blank", f"""
WITH {sql.PAIRS} SELECT {COLS} FROM full_pairs WHERE NOT {sql.blank('src', 'tgt')}
UNION ALL SELECT page_id, 'pages', {sql.clean('html')}, url FROM pages WHERE NOT {sql.blank(sql.clean('html'), 'url')}""")
def rule_drop_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = page_texts(spark, sf_dir).select(
        F.col("page_id").alias("pair_id"), F.lit("pages").alias("dataset"),
        collapse_spaces(clean_markup("src")).alias("src"), "tgt",
    )
    return complete(spark, sf_dir).unionByName(pages).transform(rules.drop_blank)


@query("rule_shuffle", f"WITH {sql.PAIRS} SELECT {COLS}, md5('s1:' || pair_id::VARCHAR) AS shuffle_key FROM full_pairs")
def rule_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete(spark, sf_dir).transform(rules.shuffle_rows, "s1")


@query("rule_filter", f"WITH {sql.PAIRS},{sql.ruled()} SELECT {COLS} FROM ruled")
def rule_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list of pairs, as a single call on everything: no per-dataset scope."""
    return rules.rule_filter(pairs(spark, sf_dir), scope=())


@query("funnel_by_rule", f"""
WITH {sql.PAIRS},
s1 AS (SELECT * FROM full_pairs),
s2 AS (SELECT * FROM s1 QUALIFY row_number() OVER (PARTITION BY src, tgt ORDER BY pair_id) = 1),
s3 AS (SELECT * FROM s2 WHERE NOT ({sql.IDENTICAL})),
s4 AS (SELECT * FROM s3 WHERE NOT {sql.RATIO}),
s5 AS (SELECT * FROM s4 WHERE NOT {sql.MAX_TOKENS}),
s6 AS (SELECT * FROM s5 WHERE NOT {sql.MIN_CHARS}),
s9 AS (SELECT {sql.clean('src')} AS src, {sql.clean('tgt')} AS tgt FROM s6)
SELECT 0 AS step_no, 'input' AS step, (SELECT count(*) FROM pw) AS rows
UNION ALL SELECT 1, 'drop_null', (SELECT count(*) FROM s1)
UNION ALL SELECT 2, 'distinct_pairs', (SELECT count(*) FROM s2)
UNION ALL SELECT 3, 'drop_identical', (SELECT count(*) FROM s3)
UNION ALL SELECT 4, 'token_ratio', (SELECT count(*) FROM s4)
UNION ALL SELECT 5, 'max_tokens', (SELECT count(*) FROM s5)
UNION ALL SELECT 6, 'min_chars', (SELECT count(*) FROM s6)
UNION ALL SELECT 7, 'clean_markup', (SELECT count(*) FROM s9)
UNION ALL SELECT 8, 'letter_case', (SELECT count(*) FROM s9)
UNION ALL SELECT 9, 'drop_blank', (SELECT count(*) FROM s9 WHERE NOT {sql.blank('src', 'tgt')})""")
def funnel_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_funnel(pairs(spark, sf_dir))
