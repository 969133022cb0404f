"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

#: Documents of each class that a model learns from at most (documented bound).
PER_CLASS = 2000
FOLDS = 5


def held_out() -> Column:
    """Documents whose labels are never learned from; a NULL id counts as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(True))


def sample(
    documents: DataFrame,
    labels: DataFrame,
    target: str,
    extract: Callable[[Sequence[str | None]], list[bytes]],
    per_class: int = PER_CLASS,
) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """What ``extract`` makes of the texts, their labels, and weights that restore the classes' shares.

    Ids are picked by hash, ``per_class`` of each label at most; one row an id and one
    label an id (the greater of several).
    """
    known = labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(target).cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picked = [
        (row["doc_id"], label)
        for label in sorted(sizes)
        for row in known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
    ]
    if not picked:
        return [], np.zeros(0), np.zeros(0)
    ids = documents.sparkSession.createDataFrame(picked, "doc_id long, label int")

    def features(text: pd.Series) -> pd.Series:
        return pd.Series(extract(list(text)), dtype=object)

    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    rows = found.select("doc_id", "label", F.pandas_udf(features, BinaryType())("text").alias("features"))
    once = rows.groupBy("doc_id", "label").agg(F.min("features").alias("features"))
    got = sorted(once.collect(), key=lambda r: r["doc_id"])
    y = np.array([r["label"] for r in got], float)
    share = {label: n / sum(sizes.values()) for label, n in sizes.items()}
    in_sample = {label: max(1, int((y == label).sum())) / max(1, len(y)) for label in sizes}
    weights = np.array([share[int(v)] / in_sample[int(v)] for v in y])
    return [bytes(r["features"]) for r in got], y, weights


class Adam:
    """The usual moment estimates over a dict of arrays."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float):
        self.parameters, self.rate, self.step = parameters, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.second = {k: np.zeros_like(v) for k, v in parameters.items()}

    def update(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        for name, g in gradients.items():
            self.first[name] = 0.9 * self.first[name] + 0.1 * g
            self.second[name] = 0.999 * self.second[name] + 0.001 * g * g
            mean = self.first[name] / (1 - 0.9**self.step)
            spread = np.sqrt(self.second[name] / (1 - 0.999**self.step))
            self.parameters[name] -= self.rate * mean / (spread + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))
