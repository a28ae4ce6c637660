from __future__ import annotations

import random
import re

import pytest

from conftest import ids, texts
from pairloom.functions import text
from pairloom.operators import rules
from pairloom.operators.rules import RuleOptions

LONG = "word other thing"


def one_value(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression.alias("y")).first().y


@pytest.mark.parametrize("value, count", [("", 1), ("a", 1), ("a b", 2), ("a  b", 3), (" ", 2), ("a\tb", 1)])
def test_token_count(spark, value, count):
    assert one_value(spark, text.token_count("x"), value) == count


@pytest.mark.parametrize("value", [
    "a<b>c", "a<b\nc>d", "a<b\rc>d", "a<b\x85c>d", "a<b\u2028c>d", "&lt;i&gt;t", "R&amp;D", "amp;z", "{}q", "&&quot;",
    "plain", "a;b", "{x}", "a < b > c", "<<a>>", "nbsp;nbsp;", "&lt; &gt", "",
])
def test_clean_markup_like_a_regex(spark, value):
    expected = re.sub(r"<.*?>|&lt;.*?&gt;|&?(amp|nbsp|quot);|{}", " ", value)
    assert one_value(spark, text.clean_markup("x"), value) == expected


@pytest.mark.parametrize("value", ["a    b", "a   b", "a b", "  ", ""])
def test_collapse_is_one_pass(spark, value):
    assert one_value(spark, text.collapse_spaces("x"), value) == value.replace("  ", " ")


@pytest.mark.parametrize("value", [
    " ", "\t", "\xa0", "\u3000", "\u2003", "\u2028\u3000", "\u205fx\u1680", "\x1c", "\x85", "\u200b", "", "\n\n", " a ", "a", "\u2029 \u205f",
])
def test_blank_and_strip_like_python(spark, value):
    assert one_value(spark, text.is_blank("x"), value) == bool(re.match(r"^\s*$", value))
    assert one_value(spark, text.strip("x"), value) == value.strip()


def test_min_chars_counts_code_points(pairs_of):
    rows = [("abc", LONG), ("abcd", LONG), ("😀ab", LONG), ("😀abc", LONG), (LONG, "abc")]
    assert ids(rules.drop_min_chars(pairs_of(rows))) == [1, 3]


def test_token_ratio_and_length_boundaries(pairs_of):
    rows = [("a b", "a"), ("a b c", "a"), ("a", "a b c"), ("a  b", "a"), (" ".join("x" * 200), " ".join("y" * 200)),
            (" ".join("x" * 201), " ".join("y" * 200))]
    df = pairs_of(rows)
    assert ids(rules.drop_token_ratio(df)) == [0, 4, 5]
    assert ids(rules.drop_max_tokens(df)) == [0, 1, 2, 3, 4]


def brute_force_filter(rows, options):
    """The rules, one row after the other."""
    seen, out = set(), []
    for pair_id, src, tgt in rows:
        if src is None or tgt is None or (src, tgt) in seen:
            continue
        seen.add((src, tgt))
        a, b = src.count(" ") + 1, tgt.count(" ") + 1
        if src == tgt or a > b * options.max_length_ratio or b > a * options.max_length_ratio:
            continue
        if max(a, b) > options.max_length or min(len(src), len(tgt)) <= options.min_length:
            continue
        cleaned = [re.sub(r"<.*?>|&lt;.*?&gt;|&?(amp|nbsp|quot);|{}", " ", t).replace("  ", " ") for t in (src, tgt)]
        if options.lowercase:
            cleaned = [t.lower() for t in cleaned]
        if all(t.strip() for t in cleaned):
            out.append((pair_id, *cleaned))
    return out


@pytest.mark.parametrize("options", [
    RuleOptions(), RuleOptions(lowercase=True), RuleOptions(min_length=1, max_length=4, max_length_ratio=1.5),
])
def test_rule_filter_against_brute_force(pairs_of, options):
    rng = random.Random(7)
    words = ["Ab", "c", "<b>", "&amp;", "{}", "\u3000", "ÄÖ", " ", "lang", None]
    def sentence():
        picked = [rng.choice(words) for _ in range(rng.randint(0, 5))]
        return None if None in picked else " ".join(picked)
    rows = [(sentence(), sentence()) for _ in range(1500)]
    got = [(r.pair_id, r.src, r.tgt) for r in rules.rule_filter(pairs_of(rows), options, scope=()).collect()]
    want = brute_force_filter([(i, *r) for i, r in enumerate(rows)], options)
    assert len(want) > 20
    assert sorted(got) == sorted(want)

    funnel = {r.step: r.rows for r in rules.rule_funnel(pairs_of(rows), options).collect()}
    counts = [funnel[s] for s in ("input", *rules.STEPS)]
    assert counts[0] == len(rows) and counts[-1] == len(want)
    assert counts == sorted(counts, reverse=True)


def test_duplicates_are_judged_per_dataset(pairs_of):
    rows = [("x", "same text", "other text"), ("y", "same text", "other text"), ("x", "same text", "other text")]
    assert ids(rules.rule_filter(pairs_of(rows))) == [0, 1]
    assert ids(rules.rule_filter(pairs_of(rows), scope=())) == [0]


def test_no_second_distinct_after_cleaning(pairs_of):
    rows = [("text <b>", "other one"), ("text <i>", "other one")]
    assert texts(rules.rule_filter(pairs_of(rows))) == [("text ", "other one")] * 2


def test_filters_are_idempotent(pairs_of):
    rows = [("a b c", "d e f"), ("a", "b"), ("abcd", "abcd"), ("abcd", "efgh")]
    for step in (rules.drop_identical, rules.drop_token_ratio, rules.drop_max_tokens, rules.drop_min_chars, rules.drop_blank):
        once = step(pairs_of(rows))
        assert texts(step(once)) == texts(once)


def test_shuffle_is_a_permutation_and_reproducible(pairs_of):
    df = pairs_of([(str(i), "t") for i in range(50)])
    order = [r.pair_id for r in rules.shuffle_rows(df, "s").collect()]
    assert sorted(order) == list(range(50)) and order != sorted(order)
    assert order == [r.pair_id for r in rules.shuffle_rows(df.repartition(7), "s").collect()]
    assert order != [r.pair_id for r in rules.shuffle_rows(df, "t").collect()]
