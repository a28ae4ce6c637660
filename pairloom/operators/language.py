"""Language identification per text, and the filter on both sides of a pair."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions import grams
from pairloom.functions.text import newline_to_space, strip_label_prefix
from pairloom.session import small_batches

WEIGHT_SCALE = 1000
DETECTION = "code string, score double"


def gram_counts(labelled: DataFrame, lang: str, text: str, n: int) -> DataFrame:
    """(lang, bucket, n_grams): counted inside each task, then summed.

    A task holds one array of 65536 counts per language, whatever the size of its input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang")
            for code in langs.unique().to_pylist():
                texts = batch.column("text").filter(pa.compute.equal(langs, code))
                total = counts.setdefault(code, np.zeros(grams.BUCKETS, dtype=np.int64))
                for part in grams.text_chunks(texts):
                    total += np.bincount(grams.gram_ids(part, n)[0], minlength=grams.BUCKETS)
        for code, total in counts.items():
            used = np.flatnonzero(total)
            columns = [pa.array([code] * len(used)), pa.array(used), pa.array(total[used])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n_grams"])

    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    partial = rows.mapInArrow(count, "lang string, bucket bigint, n_grams bigint")
    return partial.groupBy("lang", "bucket").agg(F.sum("n_grams").alias("n_grams"))


def _weights(buckets: Sequence[int], n_grams: Sequence[int]) -> np.ndarray:
    counts = np.zeros(grams.BUCKETS, dtype=np.int64)
    counts[buckets] = n_grams
    smoothed = (counts + 1) / (counts.sum() + grams.BUCKETS)
    return np.rint(WEIGHT_SCALE * np.log(smoothed)).astype(np.int32)


@dataclass(frozen=True)
class LanguageProfile:
    """Naive Bayes weights: for language i and bucket b, round(1000 * ln p(b | i)).

    Whole-number weights make every sum exact, so a verdict does not depend on how rows
    are batched or partitioned.
    """

    n: int
    languages: tuple[str, ...]
    weights: np.ndarray

    @classmethod
    def train(cls, labelled: DataFrame, lang: str = "lang", text: str = "text", n: int = 3) -> LanguageProfile:
        """Learn from labelled texts.  The driver receives the finished profile only: at
        most 65536 numbers per language, however large the corpus."""
        counts = gram_counts(labelled, lang, text, n)
        # One row per language, of at most 65536 buckets; they come one partition after another.
        rows = counts.groupBy("lang").agg(
            F.collect_list("bucket").alias("buckets"), F.collect_list("n_grams").alias("n_grams")
        )
        learned = {r.lang: _weights(r.buckets, r.n_grams) for r in rows.toLocalIterator()}
        if not learned:
            raise ValueError("no labelled text to learn from")
        languages = sorted(learned)
        return cls(n, tuple(languages), np.stack([learned[lang] for lang in languages]))

    def detector(self, df: DataFrame) -> LanguageDetector:
        return LanguageDetector(self, df)


class LanguageDetector:
    """Text column -> struct(code, score), for the session that ``df`` belongs to."""

    def __init__(self, profile: LanguageProfile, df: DataFrame):
        small_batches(df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast(profile.weights)
        languages = np.array(profile.languages, dtype=object)
        n, scale = profile.n, WEIGHT_SCALE

        def detect(texts: pa.Array) -> pa.Array:
            weights = shared.value
            codes, scores = [], []
            for part in grams.text_chunks(texts):
                ids, counts = grams.gram_ids(part, n)
                sums = np.stack([grams.text_sums(row[ids], counts) for row in weights])
                gap = (sums - sums.max(axis=0)) / scale
                absent = np.asarray(part.is_null())
                codes.append(pa.array(np.where(absent, None, languages[sums.argmax(axis=0)]), pa.string()))
                scores.append(pa.array(1.0 / np.exp(gap).sum(axis=0), pa.float64(), mask=absent))
            if not codes:
                codes, scores = [pa.array([], pa.string())], [pa.array([], pa.float64())]
            return pa.StructArray.from_arrays([pa.concat_arrays(codes), pa.concat_arrays(scores)], ["code", "score"])

        self._udf = F.arrow_udf(detect, DETECTION)

    def __call__(self, text: Column | str) -> Column:
        return self._udf(text)


@dataclass(frozen=True)
class Side:
    """What one side of a pair must be: a code or several, and the least score."""

    codes: str | Sequence[str]
    min_score: float

    def accepts(self, code: Column, score: Column) -> Column:
        wanted = [self.codes] if isinstance(self.codes, str) else list(self.codes)
        return strip_label_prefix(code).isin(wanted) & (score >= F.lit(self.min_score))


def clean_newlines(df: DataFrame) -> DataFrame:
    return df.withColumns({c: newline_to_space(c) for c in ("src", "tgt")})


def detect_languages(df: DataFrame, src_detector: LanguageDetector, tgt_detector: LanguageDetector) -> DataFrame:
    """Each side by its own detector; the two may be of different kinds."""
    return df.withColumns({"src_lang": src_detector("src"), "tgt_lang": tgt_detector("tgt")})


def language_filter(
    df: DataFrame,
    src_detector: LanguageDetector,
    tgt_detector: LanguageDetector,
    src: Side,
    tgt: Side,
) -> DataFrame:
    """Keep pairs whose sides both are in a wanted language with enough certainty.  The
    texts returned have newlines replaced by spaces."""
    detected = detect_languages(clean_newlines(df), src_detector, tgt_detector)
    return detected.transform(filter_detected, src, tgt).select(df.columns)


def filter_detected(df: DataFrame, src: Side, tgt: Side) -> DataFrame:
    """The filter alone, over detections already in src_lang and tgt_lang."""
    return df.where(
        src.accepts(F.col("src_lang.code"), F.col("src_lang.score"))
        & tgt.accepts(F.col("tgt_lang.code"), F.col("tgt_lang.score"))
    )


def language_report(df: DataFrame, code: str, by: str = "dataset") -> DataFrame:
    """Rows and share of each detected language per dataset; nothing is windowed, the
    totals come from the already small counts."""
    counts = df.groupBy(by, F.col(code).alias("code")).agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.groupBy(by).agg(F.sum("rows").alias("total"))
    share = F.round(F.col("rows") / F.col("total"), 6).alias("share")
    return counts.join(totals, by).select(by, "code", "rows", share)
