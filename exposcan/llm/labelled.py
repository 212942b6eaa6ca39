"""Bounded samples of labelled documents, and what both classifiers share."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_class: int, most_bytes: int) -> list[tuple[int, bytes]]:
    """Up to ``per_class`` training texts of each class as (0 or 1, bytes), in a fixed random order.

    Label rows are drawn by a hash of their id; only these documents are read, and texts of over
    ``most_bytes`` are left out of training. So at most ``2 * per_class * most_bytes`` reach the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").filter(~held_out).distinct()
    drawn = None
    for value in (0, 1):
        some = known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        drawn = some if drawn is None else drawn.union(some)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = texts.filter(F.col("text").isNotNull() & (F.octet_length("text") <= most_bytes))
    rows = texts.join(F.broadcast(drawn), "doc_id").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", "text", "label").collect()
    return [(r["label"], bytes(r["text"])) for r in rows]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights (the first is the intercept) of a logistic regression with equally weighted classes."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) / len(y) + ridge * np.r_[0, w[1:]]
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return mean, scale, w


def shift_to(scores: np.ndarray, y: np.ndarray, threshold: float, usual: int) -> float:
    """What to add to logits so that their best cut in balanced accuracy comes to lie at ``threshold``.

    If no cut is better than none, all texts come to lie on the side of the ``usual`` class.
    """
    goal = math.log(threshold / (1 - threshold))
    if len(set(y.tolist())) < 2:
        return 0.0
    order = np.argsort(scores, kind="stable")
    s, t = scores[order], y[order]
    below_1, below_0 = np.cumsum(t) / t.sum(), np.cumsum(1 - t) / (1 - t).sum()
    gain = np.where(np.r_[s[1:] > s[:-1], False], below_0 - below_1, -1)
    if gain.max() <= 0:
        return goal + (1 - float(s[0]) if usual else -1 - float(s[-1]))
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return goal - float(np.mean([(s[b] + s[b + 1]) / 2 for b in best if b + 1 < len(s)]))


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-min(max(x, -30.0), 30.0)))
