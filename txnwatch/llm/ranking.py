"""Quality scores learned from preferences: a Bradley-Terry model over text features.

A document marked good is preferred to one marked bad. The model gives each document a score,
linear in its features, such that the chance of a preference is the logistic function of the
difference of scores; fitting it is a logistic regression on feature differences. The threshold
is the score quantile at the share of bad documents, taken exactly over all labelled documents
that may be learned from. Features are computed once for every whole text and written; only a
bounded sample of labelled rows (``Fit.per_label``) fits the weights.

Defined results: a null text counts as empty; an empty text has the features zero and a score
like any other; with only one label, or none, to learn from every score is 0.5; rows that repeat are scored
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch.llm.common import byte_list, held_out, written
from txnwatch.llm.quality_rules import CONTINUATION, SYMBOLS, measure_text
from txnwatch.operators.prefix import order_statistics

UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"
MARKS = b".,;:?"
FEATURES = 13
SCALE = 1_000_000
"""Scores are ordered as whole numbers of this fineness."""


@dataclass(frozen=True)
class Fit:
    per_label: int = 3000
    max_bytes: int = 50_000
    pairs_per_row: int = 4
    ridge: float = 1e-2
    steps: int = 25
    parts: int = 3
    held_part: int = 1


def text_features(text: bytes) -> list[float]:
    words, chars, symbols, lines, dup_lines, repeats = measure_text(text)
    if not words:
        return [0.0] * FEATURES
    count = lambda marks: len(text) - len(text.translate(None, marks))
    return [
        np.log1p(words),
        chars / words,
        symbols / words,
        dup_lines / lines,
        repeats / words,
        len(set(text.split())) / words,
        count(UPPER) / chars,
        count(DIGITS) / chars,
        text.count(b"!") / words,
        text.count(b"|") / words,
        count(MARKS) / words,
        np.log1p(words / lines),
        count(CONTINUATION) / chars,
    ]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def features(texts: pa.Array) -> pa.Array:
    return pa.array([text_features(t) for t in byte_list(texts)], pa.list_(pa.float64()))


class Ranker:
    """Weights over standardised features and their squares."""

    def __init__(self, good: np.ndarray, bad: np.ndarray, fit: Fit):
        both = np.vstack([good, bad])
        self.mean, self.std = both.mean(0), both.std(0) + 1e-6
        rng = np.random.default_rng(0)
        rows = fit.pairs_per_row * max(len(good), len(bad))
        pairs = self.expand(good)[rng.integers(len(good), size=rows)] - self.expand(bad)[rng.integers(len(bad), size=rows)]
        self.weights = np.zeros(pairs.shape[1])
        for _ in range(fit.steps):
            p = 1 / (1 + np.exp(-pairs @ self.weights))
            gradient = pairs.T @ (1 - p) / rows - fit.ridge * self.weights
            curvature = (pairs * (p * (1 - p))[:, None]).T @ pairs / rows + fit.ridge * np.eye(len(self.weights))
            self.weights += np.linalg.solve(curvature, gradient)

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -8, 8)
        return np.hstack([z, z * z / 8])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights


def score(docs: DataFrame, labels: DataFrame, fit: Fit | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document. ``labels``: ``doc_id, quality``."""
    fit = fit or Fit()
    rows = written(
        docs.select(
            "doc_id", "text",
        ).select("doc_id", F.octet_length("text").alias("bytes"), features("text").alias("x"),
                 F.xxhash64("text").alias("text")),
        "features",
    )
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label")).filter("_label IN (0, 1)")
    known = known.filter(~held_out(F.col("_id"), fit.parts, fit.held_part))
    marked = written(rows.join(known, F.col("doc_id") == F.col("_id")).select("doc_id", "bytes", "text", "x", "_label"), "marked")
    sample = _sample(marked, fit)
    result = rows.select("doc_id", held_out(F.col("doc_id"), fit.parts, fit.held_part).alias("held_out"), "x")
    if any(len(part) == 0 for part in sample.values()):
        return result.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    ranker = Ranker(sample[1], sample[0], fit)

    @F.arrow_udf("double")
    def ranked(x: pa.Array) -> pa.Array:
        return pa.array(ranker.scores(x.flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)))

    threshold = _threshold(marked.select("_label", ranked("x").alias("s")))
    margin = F.col("s") - F.lit(threshold)
    return (
        result.select("doc_id", "held_out", ranked("x").alias("s"))
        .select("doc_id", "held_out", (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), margin))))).alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def _sample(marked: DataFrame, fit: Fit) -> dict[int, np.ndarray]:
    found = {}
    for label in (0, 1):
        some = marked.filter((F.col("_label") == label) & (F.coalesce("bytes", F.lit(0)) <= fit.max_bytes))
        taken = some.orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(fit.per_label).select("x").collect()
        found[label] = np.array([r["x"] for r in taken]).reshape(-1, FEATURES)
    return found


def _threshold(scored: DataFrame) -> float:
    """Between the two scores around the quantile at the share of bad documents."""
    scored = scored.select("_label", F.round(F.col("s") * SCALE).cast("long").alias("v"))
    n, bad = scored.agg(F.count("*"), F.count_if(F.col("_label") == 0)).first()
    near = order_statistics(scored, "v", {"below": (bad - 0.5) / n, "above": (bad + 0.5) / n}, cell=SCALE // 100).first()
    return (near["below"] + near["above"]) / 2 / SCALE
