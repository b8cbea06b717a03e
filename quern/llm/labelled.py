"""Bounded samples of labelled documents, to fit models on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import held_out, pick


def sample_of(labels: DataFrame, label: str, most: int, folds: int, fold: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) outside the held-out fold: for each of the labels 0 and 1, the most documents whose hashed ids are smallest; and how many there are of each.

    Null ids and labels are left out, as are documents whose labels disagree.
    """
    one = pick(labels, "doc_id", label).toDF("doc_id", "label").where("doc_id is not null and label in (0, 1)").where(~held_out(F.col("doc_id"), folds, fold))
    one = one.groupBy("doc_id").agg(F.min("label").cast("int").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    counts = {r.label: r.n for r in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    by_hash = [one.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for k in (0, 1)]
    return by_hash[0].unionByName(by_hash[1]), {k: counts.get(k, 0) for k in (0, 1)}


def texts_of(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of a sample. The sample has a bounded number of rows, so it's broadcast."""
    wanted = sample.select(F.col("doc_id").alias("wanted"), "label")
    return pick(docs, "doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("wanted")).drop("wanted")


def calibrated(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Logistic regression of y on x, by Newton's steps, with a little pull to the origin."""
    a = np.array([1.0, 0.0])
    z = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ a, -30, 30)))
        g = z.T @ (w * (p - y)) + 1e-3 * a
        h = (z * (w * p * (1 - p) + 1e-9)[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        a = a - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(a[0]), float(a[1])
