"""The chain of scored stages behind the rule filter, and the count of rows after each.

A stage adds its scores, says which rows it keeps and may rewrite the texts of the rows it
keeps.  ``keep_survivors`` applies stages as plain filters.  ``flag_stages`` keeps every
row, with the number of stages it passed; rows already lost are offered to later scorers
as null, so no model runs on them, and one table serves output, counts and quality.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators import language, quality
from pairloom.operators.language import LanguageDetector, Side
from pairloom.operators.rules import RuleOptions, rule_filter

STAGES = ("semantic", "language", "quality")


@dataclass(frozen=True)
class Stage:
    name: str
    score: Callable[[DataFrame], DataFrame]
    keep: Column
    rewrite: Callable[[DataFrame], DataFrame] | None = None


def semantic_stage(similarity: Callable[[str, str], Column], threshold: float) -> Stage:
    """``similarity`` is any scorer of two texts, e.g. ``semantic.gram_similarity()``."""

    def score(df: DataFrame) -> DataFrame:
        return df.withColumn("similarity", similarity("src", "tgt"))

    return Stage("semantic", score, F.col("similarity") > F.lit(threshold))


def language_stage(detectors: tuple[LanguageDetector, LanguageDetector], src: Side, tgt: Side) -> Stage:
    def score(df: DataFrame) -> DataFrame:
        return language.detect_languages(language.clean_newlines(df), *detectors)

    keep = src.accepts(F.col("src_lang.code"), F.col("src_lang.score")) & tgt.accepts(
        F.col("tgt_lang.code"), F.col("tgt_lang.score")
    )
    return Stage("language", score, keep, language.clean_newlines)


def quality_stage(table: DataFrame, threshold: float) -> Stage:
    return Stage(
        "quality", lambda df: quality.score_quality(df, table), F.col("quality") >= F.lit(threshold)
    )


def keep_survivors(
    pairs: DataFrame,
    stages: Sequence[Stage],
    rules: RuleOptions | None = RuleOptions(),
    scope: Sequence[str] = ("dataset",),
) -> DataFrame:
    """Rows that pass everything; a stage not listed (or rules=None) is passed through."""
    df = pairs if rules is None else rule_filter(pairs, rules, scope)
    for stage in stages:
        df = stage.score(df).where(stage.keep).select(pairs.columns)
        if stage.rewrite:
            df = stage.rewrite(df)
    return df


def flag_stages(
    pairs: DataFrame,
    stages: Sequence[Stage],
    rules: RuleOptions | None = RuleOptions(),
    scope: Sequence[str] = ("dataset",),
) -> DataFrame:
    """Rows after the rules with ``passed``: how many of the stages they passed in a row."""
    base = pairs if rules is None else rule_filter(pairs, rules, scope)
    columns = base.columns
    df = base.withColumn("passed", F.lit(0))
    for number, stage in enumerate(stages):
        alive = F.col("passed") == number
        # Scorers see null texts for lost rows and skip them.
        offered = df.withColumns({f"_{c}": F.col(c) for c in ("src", "tgt")}).withColumns(
            {c: F.when(alive, F.col(c)) for c in ("src", "tgt")}
        )
        scored = stage.score(offered)
        kept = F.coalesce(stage.keep, F.lit(False)) & alive
        df = scored.withColumn("passed", F.col("passed") + kept.cast("int"))
        now_alive = F.col("passed") == number + 1
        rewritten = stage.rewrite(df) if stage.rewrite else df
        df = rewritten.withColumns(
            {c: F.when(now_alive, F.col(c)).otherwise(F.col(f"_{c}")) for c in ("src", "tgt")}
        ).select(*columns, "passed")
    return df


def stage_funnel(pairs: DataFrame, flagged: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    """Rows per dataset: read, and left after the rules and each of the three scored stages.
    A stage that did not run carries the count before it.

    ``pairs`` is counted by dataset name alone, ``flagged`` is read once.
    """
    original = pairs.groupBy("dataset").agg(F.count(F.lit(1)).alias("original"))
    ran = [s.name for s in stages]
    counts = [F.count(F.lit(1)).alias("after_rule")]
    passed = 0
    for name in STAGES:
        passed = ran.index(name) + 1 if name in ran else passed
        counts.append(F.sum((F.col("passed") >= passed).cast("bigint")).alias(f"after_{name}"))
    after = flagged.groupBy("dataset").agg(*counts)
    joined = original.join(after, "dataset", "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in after.columns if c != "dataset"}
    return joined.withColumns(zero)


COUNTS = ("original", "after_rule", "after_semantic", "after_language", "after_quality")


def with_total(funnel: DataFrame, quality_scores: DataFrame | None = None) -> DataFrame:
    """The funnel plus a TOTAL row, whose quality is null."""
    if quality_scores is None:
        funnel = funnel.withColumn("quality_score", F.lit(None).cast("double"))
    else:
        funnel = funnel.join(quality_scores, "dataset", "left")
    rolled = funnel.rollup("dataset").agg(
        F.grouping("dataset").alias("is_total"),
        *[F.sum(c).alias(c) for c in COUNTS],
        F.max("quality_score").alias("quality_score"),
    )
    total = F.col("is_total") == 1
    return rolled.select(
        F.when(total, "TOTAL").otherwise(F.col("dataset")).alias("dataset"),
        *COUNTS,
        F.when(~total, F.col("quality_score")).alias("quality_score"),
    )
