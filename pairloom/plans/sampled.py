"""Sampling several corpora, tagging their languages and uniting them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.operators.sampling import sample
from pairloom.sources.catalog import Entry, read_catalog


@dataclass(frozen=True)
class Corpus:
    """Languages of the two sides, and how much to take: a share, a number of rows, or all."""

    src_lang: str
    tgt_lang: str
    size: float | int | None = None


def sample_and_tag(pairs: DataFrame, corpora: Mapping[str, Corpus], seed: str) -> DataFrame:
    """(pair_id, sentence_<language>..., src_lang, tgt_lang) of the sampled rows of each dataset
    in ``corpora``; a language a row lacks is null, a dataset not listed is left out.

    One plan serves all corpora: languages come from constant maps, nothing is read per corpus.
    """
    named = pairs.where(F.col("dataset").isin(*corpora))
    taken = sample(named, {name: c.size for name, c in corpora.items()}, seed)

    def tag(side: str) -> F.Column:
        entries = chain.from_iterable((F.lit(name), F.lit(getattr(c, side))) for name, c in corpora.items())
        return F.element_at(F.create_map(*entries), F.col("dataset"))

    tagged = taken.withColumns({side: tag(side) for side in ("src_lang", "tgt_lang")})
    languages = dict.fromkeys(chain.from_iterable((c.src_lang, c.tgt_lang) for c in corpora.values()))
    sentences = [
        F.when(F.col("src_lang") == lang, F.col("src")).when(F.col("tgt_lang") == lang, F.col("tgt")).alias(f"sentence_{lang}")
        for lang in languages
    ]
    return tagged.select("pair_id", *sentences, "src_lang", "tgt_lang")


def sample_merge(
    spark: SparkSession, entries: Sequence[Entry], corpora: Mapping[str, Corpus], seed: str, path: str
) -> DataFrame:
    """Read the entries, sample and tag them, write their union to ``path`` and return it."""
    absent = set(corpora) - {e.name for e in entries}
    if absent:
        raise ValueError(f"no catalog entry for {sorted(absent)}")
    united = sample_and_tag(read_catalog(spark, entries), corpora, seed)
    united.hint("rebalance").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
