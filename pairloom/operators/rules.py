"""The rule filter: null, duplicate, copy, length and markup rules on sentence pairs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions import text
from pairloom.functions.fixed_values import MAX_LENGTH, MAX_LENGTH_RATIO, MIN_LENGTH
from pairloom.operators.first import first_per_key

# Order of the steps; the funnel reports them in this order.
STEPS = (
    "drop_null", "distinct_pairs", "drop_identical", "token_ratio", "max_tokens",
    "min_chars", "clean_markup", "letter_case", "drop_blank",
)


@dataclass(frozen=True)
class RuleOptions:
    min_length: int = MIN_LENGTH
    max_length: int = MAX_LENGTH
    max_length_ratio: float = MAX_LENGTH_RATIO
    lowercase: bool = False


def drop_null(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["src", "tgt"])


def distinct_pairs(df: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """First row of each (src, tgt), inside each ``scope`` value (e.g. per dataset)."""
    return first_per_key(df, [*scope, "src", "tgt"])


def is_identical() -> Column:
    return F.col("src") == F.col("tgt")


def breaks_token_ratio(ratio: float = MAX_LENGTH_RATIO) -> Column:
    a, b = text.token_count("src"), text.token_count("tgt")
    return (a > b * F.lit(float(ratio))) | (b > a * F.lit(float(ratio)))


def exceeds_max_tokens(limit: int = MAX_LENGTH) -> Column:
    return (text.token_count("src") > limit) | (text.token_count("tgt") > limit)


def below_min_chars(limit: int = MIN_LENGTH) -> Column:
    return (F.length("src") <= limit) | (F.length("tgt") <= limit)


def drop_identical(df: DataFrame) -> DataFrame:
    return df.where(~is_identical())


def drop_token_ratio(df: DataFrame, ratio: float = MAX_LENGTH_RATIO) -> DataFrame:
    return df.where(~breaks_token_ratio(ratio))


def drop_max_tokens(df: DataFrame, limit: int = MAX_LENGTH) -> DataFrame:
    return df.where(~exceeds_max_tokens(limit))


def drop_min_chars(df: DataFrame, limit: int = MIN_LENGTH) -> DataFrame:
    return df.where(~below_min_chars(limit))


def clean_markup(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.clean_markup(c) for c in ("src", "tgt")})


def collapse_spaces(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.collapse_spaces(c) for c in ("src", "tgt")})


def lowercase(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lower(c) for c in ("src", "tgt")})


def drop_blank(df: DataFrame) -> DataFrame:
    return df.where(~(text.is_blank("src") | text.is_blank("tgt")))


def shuffle_key(seed: str, *ids: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), *[F.col(i).cast("string") for i in ids]).cast("binary"))


def shuffle_rows(df: DataFrame, seed: str) -> DataFrame:
    """A reproducible random order (range-partitioned sort).  A table keeps no order, so
    this is only of use directly before an ordered sink."""
    return df.withColumn("shuffle_key", shuffle_key(seed, "pair_id")).orderBy("shuffle_key", "pair_id")


def pairwise_rules(df: DataFrame, options: RuleOptions = RuleOptions()) -> DataFrame:
    """The tests that look only at the texts of one pair as they came in."""
    return (
        df.transform(drop_null)
        .transform(drop_identical)
        .transform(drop_token_ratio, options.max_length_ratio)
        .transform(drop_max_tokens, options.max_length)
        .transform(drop_min_chars, options.min_length)
    )


def normalise(df: DataFrame, options: RuleOptions = RuleOptions()) -> DataFrame:
    """Markup, spaces and, if wanted, letter case."""
    df = df.transform(clean_markup).transform(collapse_spaces)
    return df.transform(lowercase) if options.lowercase else df


def rule_filter(
    df: DataFrame, options: RuleOptions = RuleOptions(), scope: Sequence[str] = ("dataset",)
) -> DataFrame:
    """All rules.  The pairwise tests run before the shuffle of the distinct step:
    duplicates share the verdict, so the result is the same and the shuffle carries
    survivors only.  There is no second distinct after cleaning."""
    return (
        df.transform(pairwise_rules, options)
        .transform(distinct_pairs, scope)
        .transform(normalise, options)
        .transform(drop_blank)
    )


def first_broken_rule(options: RuleOptions = RuleOptions()) -> Column:
    """Name of the first rule after the distinct step that a non-null pair breaks, else null."""
    a, b = text.collapse_spaces(text.clean_markup("src")), text.collapse_spaces(text.clean_markup("tgt"))
    return (
        F.when(is_identical(), "drop_identical")
        .when(breaks_token_ratio(options.max_length_ratio), "token_ratio")
        .when(exceeds_max_tokens(options.max_length), "max_tokens")
        .when(below_min_chars(options.min_length), "min_chars")
        .when(text.is_blank(a) | text.is_blank(b), "drop_blank")
    )


def rule_funnel(
    df: DataFrame, options: RuleOptions = RuleOptions(), scope: Sequence[str] = ()
) -> DataFrame:
    """Rows left after each rule step, from one aggregation over the distinct pairs.

    Every row is charged to the first step that drops it; the second and later copies of
    a pair to ``distinct_pairs``.
    """
    groups = df.groupBy(*scope, "src", "tgt").agg(F.count(F.lit(1)).alias("n"))
    is_null = F.col("src").isNull() | F.col("tgt").isNull()
    broken = groups.select("n", is_null.alias("is_null"), first_broken_rule(options).alias("rule"))

    def lost(step: str) -> Column:
        if step == "drop_null":
            value = F.when(F.col("is_null"), F.col("n"))
        elif step == "distinct_pairs":
            value = F.when(~F.col("is_null"), F.col("n") - 1)
        else:
            value = F.when(~F.col("is_null") & (F.col("rule") == step), 1)
        return F.coalesce(F.sum(value), F.lit(0)).alias(step)

    totals = broken.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("input"), *[lost(s) for s in STEPS])
    left = F.col("input")
    rows = [F.struct(F.lit(0).alias("step_no"), F.lit("input").alias("step"), left.alias("rows"))]
    for number, step in enumerate(STEPS, start=1):
        left = left - F.col(step)
        rows.append(F.struct(F.lit(number).alias("step_no"), F.lit(step).alias("step"), left.alias("rows")))
    return totals.select(F.inline(F.array(*rows)))
