"""A quality classifier learned from trusted positives and unlabelled text.

A text becomes a few numbers about its characters, words and lines.  A small network is fitted
by minimising the non-negative unbiased risk: with class prior p, positives P and unlabelled U,

    p * loss(P, +1) + max(0, loss(U, -1) - p * loss(P, -1)),

with the logistic loss, so that its output is the probability of the positive class.  When a
batch drives the second term below zero, the step goes the other way, as the method asks.

The prior is estimated from positives and unlabelled text alone (``estimate_prior``); labels of
bad documents are never read.

Only the fit is bounded: at most ``MAX_POSITIVES`` positives and ``MAX_UNLABELLED`` unlabelled
documents, those with the smallest hash of their id.  Every document is scored.  Null texts count
as empty; empty texts get the score of their (all zero) numbers.  Repeated rows score alike.
Without any positive the prior is 0.5 and every score is the prior.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

MAX_POSITIVES, MAX_UNLABELLED = 8_000, 12_000
HIDDEN, STEPS, BATCH, RATE, DECAY = 16, 800, 1000, 0.01, 1e-4
LEAST_ROWS, FOLDS, CONFIDENCE = 20, 4, 0.1  # of the estimate of the prior
HELD_OUT = 1  # remainder of crc32(id) mod 3 whose labels are never learned from

_GROUPS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:", b"!?", b"|", b"#$%&*@^~", b"<>{}[]()/\\=_",
           b"\"'`-+", bytes(range(128, 256)))
GROUP_OF = np.zeros((256, len(_GROUPS)))
for _i, _g in enumerate(_GROUPS):
    GROUP_OF[list(_g), _i] = 1
NAMES = ("log_bytes", "upper", "digit", "space", "line_end", "stop", "exclaim", "bar", "symbol", "bracket", "quote",
         "beyond_ascii", "entropy", "word_length", "distinct_words", "top_word", "stops_after_words", "line_length",
         "repeated_lines", "longest_word", "repeated_words")


def features(data: bytes) -> list[float]:
    if not data:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = len(data)
    shares = counts @ GROUP_OF / n
    p = counts[counts > 0] / n
    words = data.split()
    n_words = max(1, len(words))
    seen = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    stops = int(counts[ord(".")] + counts[ord("!")] + counts[ord("?")])
    return [
        np.log1p(n), *shares, float(-(p * np.log2(p)).sum()), n / n_words, len(seen) ** 0.5 / n_words ** 0.5,
        max(seen.values(), default=0) / n_words, stops / n_words, np.log1p(n / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)), np.log1p(max(map(len, seen), default=0)),
        sum(map(operator.eq, words, words[1:])) / n_words,
    ]


class Network:
    """One hidden layer; ``fit`` minimises the non-negative risk."""

    def __init__(self, prior: float) -> None:
        self.prior = prior
        self.weights: list[np.ndarray] | None = None

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b, v, c = self.weights
        hidden = np.tanh(x @ w + b)
        return hidden, hidden @ v + c

    def _gradient(self, x: np.ndarray, dz: np.ndarray) -> list[np.ndarray]:
        _, _, v, _ = self.weights
        hidden, _ = self._forward(x)
        dh = np.outer(dz, v) * (1 - hidden ** 2)
        return [x.T @ dh, dh.sum(0), hidden.T @ dz, dz.sum(keepdims=True)]

    def risk(self, p: np.ndarray, u: np.ndarray) -> tuple[float, float]:
        """Both terms of the risk, the second one as it is, even below zero."""
        zp, zu = self._forward(p)[1], self._forward(u)[1]
        return (float(self.prior * np.logaddexp(0, -zp).mean()),
                float(np.logaddexp(0, zu).mean() - self.prior * np.logaddexp(0, zp).mean()))

    def direction(self, p: np.ndarray, u: np.ndarray) -> list[np.ndarray]:
        """Gradient of the risk, or of minus its second term where that is below zero."""
        sp, su = (1 / (1 + np.exp(-self._forward(x)[1])) for x in (p, u))
        minus = self._gradient(u, su / len(u)), self._gradient(p, -self.prior * sp / len(p))
        down = [a + b for a, b in zip(*minus, strict=True)]
        if self.risk(p, u)[1] < 0:
            return [-g for g in down]
        up = self._gradient(p, self.prior * (sp - 1) / len(p))
        return [a + b for a, b in zip(up, down, strict=True)]

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, seed: int = 7) -> Network:
        if not len(positive) or not len(unlabelled):
            return self
        both = np.concatenate([positive, unlabelled])
        self.centre, self.scale = both.mean(0), both.std(0) + 1e-6
        positive, unlabelled = self._scaled(positive), self._scaled(unlabelled)
        rng = np.random.default_rng(seed)
        d = both.shape[1]
        self.weights = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN),
                        np.zeros(1)]
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        for step in range(1, STEPS + 1):
            u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
            p = positive[rng.integers(0, len(positive), BATCH)]
            grads = self.direction(p, u)
            rate = RATE * (1 - step / (STEPS + 1))
            for i, g in enumerate(grads):
                g = g + DECAY * self.weights[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                self.weights[i] = self.weights[i] - rate * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-self._forward(self._scaled(x))[1]))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, fold_p: np.ndarray, fold_u: np.ndarray) -> float:
    """The share of positives among unlabelled rows, by the best bin of a classifier's scores.

    Each fold is scored by a network fitted on the others; a document that is in both lists must
    have one fold.  Above any score the share of unlabelled rows divided by that of positives bounds
    the prior from above; the least such bound, with an allowance for the few rows of a small bin,
    is the estimate.  Fewer than ``LEAST_ROWS`` rows on either side say nothing: 0.5.
    """
    if min(len(positive), len(unlabelled)) < LEAST_ROWS:
        return 0.5
    p, u = [], []
    for k in range(FOLDS):
        model = Network(0.5).fit(positive[fold_p != k], unlabelled[fold_u != k])
        p.append(model.score(positive[fold_p == k]))
        u.append(model.score(unlabelled[fold_u == k]))
    p, u = np.sort(np.concatenate(p)), np.sort(np.concatenate(u))
    slack = sum(np.sqrt(np.log(4 / CONFIDENCE) / (2 * n)) for n in (len(p), len(u)))
    above_p, above_u = (1 - np.searchsorted(x, p) / len(x) for x in (p, u))
    best = np.argmin((above_u + (1 + CONFIDENCE / 10) * slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def feature_column(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array([features(t.as_py() or b"") for t in batch.cast(pa.binary())], pa.list_(pa.float64()))


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id) == HELD_OUT, F.lit(False))


def _smallest(ids: DataFrame, bound: int) -> DataFrame:
    return ids.dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def fit_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                label: str = "quality") -> Network:
    """A network from the labels of rows that are not held out; ``label`` 1 is positive."""
    given = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").alias("y"))
    given = given.where(~held_out(F.col("doc_id")))
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    trainable = own.select("doc_id").where(~held_out(F.col("doc_id")))
    positives = _smallest(given.where("y = 1").select("doc_id"), MAX_POSITIVES)
    unlabelled = _smallest(trainable, MAX_UNLABELLED)
    # Both lists have a fixed bound, so they may be broadcast.
    wanted = positives.withColumn("p", F.lit(1)).join(unlabelled.withColumn("u", F.lit(1)), "doc_id", "full")
    rows = own.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"]).select(
        "doc_id", "p", "u", feature_column("_text").alias("x")).collect()
    rows.sort(key=lambda r: str(r["doc_id"]))
    width = len(NAMES)
    positive = np.array([r["x"] for r in rows if r["p"]]).reshape(-1, width)
    free = np.array([r["x"] for r in rows if r["u"]]).reshape(-1, width)
    folds = np.array([zlib.crc32(str(r["doc_id"]).encode()) // 3 % FOLDS for r in rows], np.int64)
    fold_p, fold_u = (folds[np.array([bool(r[name]) for r in rows], bool)] for name in ("p", "u"))
    return Network(estimate_prior(positive, free, fold_p, fold_u)).fit(positive, free)


def score_quality(docs: DataFrame, model: Network, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that each text is good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            x = np.array([features(t.as_py() or b"") for t in batch.cast(pa.binary())]).reshape(-1, len(NAMES))
            yield pa.array(shared.value.score(x), pa.float64())

    return docs.withColumn(out, score(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
