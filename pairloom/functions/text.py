"""String expressions, all evaluated by Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pairloom.functions.fixed_values import LABEL_PREFIX, MARKUP, WHITESPACE


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def token_count(x: Column | str) -> Column:
    """Number of U+0020 plus one; a space is one byte, so byte lengths do."""
    x = _col(x)
    return F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit(""))) + 1


def clean_markup(x: Column | str) -> Column:
    """Every alternative of the pattern needs "<", ";" or "{}", so most rows skip the regex."""
    x = _col(x)
    suspicious = x.contains("<") | x.contains(";") | x.contains("{}")
    return F.when(suspicious, F.regexp_replace(x, F.lit(MARKUP), F.lit(" "))).otherwise(x)


def collapse_spaces(x: Column | str) -> Column:
    """One pass of two spaces -> one: four become two."""
    return F.replace(_col(x), F.lit("  "), F.lit(" "))


def is_blank(x: Column | str) -> Column:
    return F.ltrim(_col(x), F.lit(WHITESPACE)) == ""


def strip(x: Column | str) -> Column:
    """White space off both ends; texts that start and end with a letter are not copied."""
    x = _col(x)
    ends = F.left(x, F.lit(1)).isin(list(WHITESPACE)) | F.right(x, F.lit(1)).isin(list(WHITESPACE))
    return F.when(ends, F.btrim(x, F.lit(WHITESPACE))).otherwise(x)


def newline_to_space(x: Column | str) -> Column:
    return F.replace(_col(x), F.lit("\n"), F.lit(" "))


def strip_label_prefix(x: Column | str) -> Column:
    return F.replace(_col(x), F.lit(LABEL_PREFIX), F.lit(""))


def word_set(x: Column | str) -> Column:
    """Distinct space-separated tokens, empty ones left out."""
    return F.array_distinct(F.array_remove(F.split(_col(x), " "), ""))
