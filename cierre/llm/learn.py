"""Labels and small linear models for the classifiers. Scoring covers every document."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, mod ``mod``; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("long").cast("string").cast("binary")), F.lit(mod))


def not_held_out(id_col: Column, mod: int) -> Column:
    return crc_mod(id_col, mod) != 0


def known_labels(labels: DataFrame, label: str, mod: int) -> DataFrame:
    """(doc_id, label) of all rows to learn from: those that are not held out. Of rows
    with one id the greatest label counts; rows without id or label don't."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isNotNull() & not_held_out(F.col("doc_id"), mod))
    return known.groupBy("doc_id").agg(F.max("label").alias("label"))


def labelled_ids(labels: DataFrame, label: str, mod: int, bound: int) -> DataFrame:
    """At most ``bound`` of ``known_labels``, by the order of a hash of the id."""
    return known_labels(labels, label, mod).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def one_text(texts: DataFrame) -> DataFrame:
    """(doc_id, label, text) with one text for each id: of several the shortest, then
    the one with the least hash."""
    return texts.groupBy("doc_id", "label").agg(
        F.min(F.struct(F.length("text"), F.xxhash64("text"), F.col("text").alias("text")))["text"].alias("text"))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 50, times: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; ``ridge`` holds them small.
    ``times``: how often each row counts."""
    w = np.zeros(x.shape[1])
    share = np.full(len(y), 1 / len(y)) if times is None else times / times.sum()
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ ((p - y) * share) + ridge * w
        curve = (x * (p * (1 - p) * share)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w
