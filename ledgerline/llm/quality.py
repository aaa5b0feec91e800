"""Quality classifier: a regularised quadratic discriminant over statistics of whole texts.

Each class has a mean and a covariance of the transformed statistics (`text_stats.NAMES`), the covariance shrunk towards
the pooled variances. A score is the difference of the two Mahalanobis log densities and priors, from Cholesky factors
cached in the model, put on a 0..1 scale by a logistic curve fitted to the same labelled rows.

Defined results: NULL text counts as empty, and empty texts are scored like all others. Labels that are NULL or neither
0 nor 1 are not learned from; a document labelled twice is learned from once per label; labels without a document and
documents without an id teach nothing. Without rows of both classes every score is the share of label 1 (0.5 if none).
Rows repeat and tie freely: a score depends on the text alone. Columns of any name pass through.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.frames import free_name, sampled, whole_text
from ledgerline.llm.text_stats import NAMES, statistics

SAMPLE = 20_000  # labelled rows that the model is fitted to, at most
SHRINKAGE = 0.2
RIDGE = 1e-4


class Model(NamedTuple):
    means: list[np.ndarray]
    factors: list[np.ndarray]  # inverse Cholesky factors, one for each class
    constants: list[float]  # log prior less half the log determinant
    slope: float
    shift: float

    def difference(self, rows: np.ndarray) -> np.ndarray:
        """Log density and prior of class 1 less those of class 0."""
        if not self.means:
            return np.zeros(len(rows))
        parts = [
            constant - 0.5 * (((rows - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, constant in zip(self.means, self.factors, self.constants)
        ]
        return parts[1] - parts[0]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.difference(rows) + self.shift, -700, 700)))


def logistic(x: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, with smoothed targets and a small ridge."""
    good, bad = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = np.abs(x).mean() or 1.0
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    weights = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (p - target) + 1e-3 * weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        weights = weights - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(weights[0] / scale), float(weights[1])


def logistic_over(rows: DataFrame, x: str, label: str) -> tuple[float, float]:
    """The same of the columns `x` and `label` (0 or 1) of all rows: each step is one aggregate over them."""
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("good"), F.avg(F.abs(x)).alias("scale")).first()
    good, bad, scale = whole.good, whole.n - whole.good, whole.scale or 1.0
    weights = np.array([1.0, 0.0])
    for _ in range(50):
        at = F.col(x) / scale
        reach = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), at * float(weights[0]) + float(weights[1])))
        parts = rows.select(at.alias("at"), (1 / (1 + F.exp(-reach))).alias("p"), F.when(
            F.col(label) == 1, (good + 1) / (good + 2)).otherwise(1 / (bad + 2)).alias("target"))
        miss, slack = F.col("p") - F.col("target"), F.col("p") * (1 - F.col("p"))
        sums = parts.agg(*(F.sum(part) for part in (
            miss * F.col("at"), miss, slack * F.col("at") * F.col("at"), slack * F.col("at"), slack))).first()
        gradient = np.array(sums[:2]) + 1e-3 * weights
        hessian = np.array([[sums[2], sums[3]], [sums[3], sums[4]]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        weights = weights - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(weights[0] / scale), float(weights[1])


def fit_rows(rows: np.ndarray, labels: np.ndarray, shrinkage: float = SHRINKAGE) -> Model:
    """The model of labelled statistics."""
    counts = [int((labels == kind).sum()) for kind in (0, 1)]
    if min(counts) == 0:
        share = min(max((counts[1] + 0.5) / (sum(counts) + 1), 0.01), 0.99)
        return Model([], [], [], 0.0, float(np.log(share / (1 - share))))
    held = [rows[labels == kind] for kind in (0, 1)]
    means = [part.mean(axis=0) for part in held]
    scatter = [(part - mean).T @ (part - mean) for part, mean in zip(held, means)]
    pooled = np.diag(sum(scatter) / len(rows)) + RIDGE
    factors, constants = [], []
    for kind in (0, 1):
        weight = max(shrinkage, len(pooled) / (len(pooled) + counts[kind]))  # few rows: mostly the pooled variances
        covariance = (1 - weight) * scatter[kind] / counts[kind] + weight * np.diag(pooled) + RIDGE * np.eye(len(pooled))
        lower = np.linalg.cholesky(covariance)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(counts[kind] / len(rows)) - np.log(np.diag(lower)).sum()))
    raw = Model(means, factors, constants, 1.0, 0.0)
    slope, shift = logistic(raw.difference(rows), labels)
    return raw._replace(slope=slope, shift=shift)


def remainder(column: str = "doc_id") -> Column:
    """crc32 of an id as text, modulo 3."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3


def learnable(column: str = "doc_id") -> Column:
    return F.coalesce(remainder(column) != 1, F.lit(False))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _measure(texts: pd.Series) -> pd.Series:
    return pd.Series(list(statistics(texts.tolist())))


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", key: str = "doc_id", text: str = "text",
        sample: int = SAMPLE) -> Model:
    """The model of at most `sample` labelled rows: those whose ids have the smallest hashes, held-out ids left out."""
    known = labels.where(learnable(key) & F.col(label).isin(0, 1)).select(
        F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    chosen = sampled(known, sample, "_key", "_label")
    taught = docs.select(F.col(key).alias("_key"), whole_text(text).alias("_text")).join(F.broadcast(chosen), "_key")
    rows = taught.select("_key", "_label", _measure(F.col("_text")).alias("_rows"), F.xxhash64("_text").alias("_tie"))
    bounded = rows.orderBy("_key", "_label", "_tie").limit(sample).select("_label", "_rows").toPandas()
    table = np.array(bounded["_rows"].tolist(), dtype=float).reshape(len(bounded), len(NAMES))
    return fit_rows(table, bounded["_label"].to_numpy(dtype=int))


def score(docs: DataFrame, model: Model, *, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with one more column: how likely label 1 is, from the whole text."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(statistics(texts.tolist())))

    return docs.withColumn(name, scored(whole_text(text)))


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns."""
    name = free_name(docs, "quality_score")
    return score(docs, fit(docs, labels), name=name).where(F.col(name) >= threshold).drop(name)
