"""Allow and block lists for URLs: a trie over reversed host labels and path segments.

A rule is (host, path, verdict).  It fits a URL whose host is the rule's host or one of its
subdomains and whose path starts with the rule's path, character by character.  Of all rules
that fit, the longest (characters of host and path, then of host) gives the verdict; a rule
given twice with different verdicts blocks if one of them does, and has the smaller one otherwise.
Without a rule the verdict is ``DEFAULT``.

Null URLs, URLs without ``://`` and those with nothing behind it have an empty host and fit no rule,
and rules with an empty host fit no URL; an empty rule list leaves every URL at the default;
repeated rows are judged each on its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.shared import ascii_lower
from pairloom.operators.joins import measured_bytes

DEFAULT = "allow"
# A trie takes about ten times its rules; beyond this the rules are joined, not broadcast.
MAX_RULE_BYTES = 8 << 20

Rule = tuple[str, str, str]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty without ``://``."""
    mark = F.instr(url, "://")
    tail = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    raw_host = F.regexp_extract(tail, r"^[^/?#]*", 0)
    after = F.substring(tail, F.length(raw_host) + 1, F.length(tail))
    return ascii_lower(raw_host), F.regexp_extract(after, r"^[^?#]*", 0)


class RuleTrie:
    """Nested dictionaries: host labels from the right, then whole path segments."""

    def __init__(self, rules: Iterable[Rule]) -> None:
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault("/", {})
            *segments, last = path.split("/")
            for segment in segments:
                node = node.setdefault(("segment", segment), {})
            ends = node.setdefault("ends", {})
            both = (verdict, ends.get(last, (verdict,))[0])
            ends[last] = ("block" if "block" in both else min(both), host + path)
            node.setdefault("lengths", {})[len(last)] = None

    def judge(self, host: str, path: str) -> tuple[str, str | None]:
        best, found = (-1, -1), (DEFAULT, None)
        node, length = self.root, -1
        for label in reversed(host.split(".")) if host else ():
            node, length = node.get(label), length + 1 + len(label)
            if node is None:
                break
            at = node.get("/")
            for segment in path.split("/") if at else ():
                for n in at.get("lengths", ()):
                    verdict, rule = at["ends"].get(segment[:n], found) if n <= len(segment) else found
                    if rule is not None and (len(rule), length) > best:
                        best, found = (len(rule), length), (verdict, rule)
                at = at.get(("segment", segment))
                if at is None:
                    break
        return found


def judge_urls(urls: DataFrame, url: str, rules: DataFrame, limit: int = MAX_RULE_BYTES) -> DataFrame:
    """``urls`` with host, path, rule and verdict added (own columns of these names give way).

    ``rules`` has the columns host, path, verdict; rules with a null or without a host are void.
    """
    rules = rules.select("host", "path", "verdict").dropna().where("host <> ''").distinct()
    host, path = url_parts(F.col(f"`{url}`"))
    parted = urls.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    if measured_bytes(rules) > limit:
        return _judge_by_join(parted, rules)
    trie = urls.sparkSession.sparkContext.broadcast(RuleTrie(tuple(r) for r in rules.collect()))

    @F.pandas_udf("verdict string, rule string")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in parts:
            yield pd.DataFrame(
                [trie.value.judge(h, p) for h, p in zip(hosts, paths, strict=True)], columns=["verdict", "rule"]
            )

    judged = parted.withColumn("__llm_judged", judge("host", "path"))
    return judged.withColumns({"rule": F.col("__llm_judged.rule"), "verdict": F.col("__llm_judged.verdict")}).drop("__llm_judged")


def _judge_by_join(parted: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for rule lists of any size: the trie's steps become join keys.

    A rule is filed under its host and the path up to its last slash; a URL looks under every
    suffix of its host and every such part of its path.
    """
    rules = rules.groupBy("host", "path").agg(F.min(F.when(F.col("verdict") == "block", "block").otherwise(
        F.col("verdict"))).alias("__llm_low"), F.max(F.col("verdict") == "block").alias("__llm_block"))
    rules = rules.select(
        F.col("host").alias("__llm_host"), F.col("path").alias("__llm_path"),
        F.regexp_extract("path", r"(?s)^(.*/)?", 0).alias("__llm_dir"),
        F.when(F.col("__llm_block"), "block").otherwise(F.col("__llm_low")).alias("__llm_verdict"),
    )
    numbered = parted.withColumn("__llm_row", F.monotonically_increasing_id())
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    keys = numbered.select("__llm_row", F.col("path").alias("__llm_url_path"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("__llm_host"),
        segments.alias("__llm_segments"))
    keys = keys.select("__llm_row", "__llm_url_path", "__llm_host", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("__llm_segments") - 1),
        lambda i: F.when(i == 0, "").otherwise(F.concat(F.array_join(F.slice("__llm_segments", 1, i), "/"), F.lit("/"))),
    )).alias("__llm_dir"))
    rank = F.struct(F.length("__llm_host") + F.length("__llm_path"), F.length("__llm_host"))
    best = (
        keys.join(rules, ["__llm_host", "__llm_dir"]).where(F.col("__llm_url_path").startswith(F.col("__llm_path")))
        .groupBy("__llm_row").agg(F.max_by(F.struct("__llm_verdict", F.concat("__llm_host", "__llm_path").alias("__llm_rule")), rank).alias("__llm_best"))
    )
    return numbered.join(best, "__llm_row", "left").withColumns({
        "rule": F.col("__llm_best.__llm_rule"), "verdict": F.coalesce("__llm_best.__llm_verdict", F.lit(DEFAULT)),
    }).drop("__llm_row", "__llm_best")
