"""Labelled texts for learning, written once."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .idfilter import likely
from .storage import written


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, train: Column, most: int) -> DataFrame:
    """(doc_id, text, label, weight) of labelled documents for which ``train``,
    a condition on doc_id, holds; label is 0 or 1, other labels take no part.

    Of a label with more than ``most`` documents about that many are picked by
    a hash of the id; ``weight`` is how many each stands for.  Several labels of
    a document: the largest."""
    y = labels.where(train).where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    y = written(y, "labels")
    n = {r["label"]: r["count"] for r in y.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, min(1.0, most / max(1, n.get(1, 0)))).otherwise(min(1.0, most / max(1, n.get(0, 0))))
    y = y.withColumn("weight", 1 / share).where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    rows = likely(docs.where(train).select("doc_id", "text"), "doc_id", y, "doc_id")
    return written(rows.join(y, "doc_id").select("doc_id", "text", "label", "weight"), "labelled")


def fit_sigmoid(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic regression of y on x (weights of sum
    1), by Newton steps; a small ridge keeps separable data finite."""
    feats, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)

    def loss(b):
        z = feats @ b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5e-5 * (b ** 2).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(feats @ beta, -500, 500)))
        grad = feats.T @ (weight * (p - y)) + 1e-5 * beta
        hess = (feats * (weight * p * (1 - p))[:, None]).T @ feats + 1e-5 * np.eye(2)
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])
