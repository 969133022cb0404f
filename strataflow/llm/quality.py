"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words, all of them. A passage is
encoded from the shape of its words (length, case, digits, symbols, repetition) and a
small signed hash of the words. A gated attention learned from document labels weighs
the passages; the weighted representation is scored. So a document with one bad part
among many good ones is judged by where the attention goes, without passage labels.

Learned from at most ``PER_CLASS`` documents of each label (see ``training``); scored on
all. Defined cases: NULL and empty texts are one passage without words and get its
score; very long texts are passages like others; repeated rows are rows; without
labels, or with one label alone, every score is the smoothed share of label 1; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from strataflow.llm.textstats import repeated_words, slices, words_of
from strataflow.llm.training import PER_CLASS, Adam, held_out, sample, sigmoid

PASSAGE_WORDS = 64
HASHED, HIDDEN, GATE = 16, 16, 8
STEPS, RATE, DECAY, SEED = 300, 0.02, 1e-3, 7
KEEP_AT = 0.3


def passages(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the first passage of each text (one more at the end)."""
    words = words_of(texts)
    n = words.first[1:] - words.first[:-1]
    bags = np.maximum(1, -(-n // PASSAGE_WORDS))
    first = np.concatenate(([0], np.cumsum(bags)))
    place = np.arange(len(words.doc)) - words.first[words.doc]
    owner = first[words.doc] + place // PASSAGE_WORDS
    total = lambda v: np.bincount(owner, v, first[-1])
    c = words.counts
    count = total(np.ones(len(owner)))
    size, one = np.maximum(1, count), np.maximum(1, total(c["chars"]))
    shape = [
        np.log1p(count) / np.log1p(PASSAGE_WORDS),
        total(c["chars"]) / size / 8,
        total(c["symbols"]) / size,
        total(c["symbols"] > 0) / size,
        total(c["upper"]) / one,
        total(c["upper"] > 1) / size,
        total(c["digits"]) / one,
        total(c["bangs"]) / size,
        total(c["pipes"]) / size,
        total(repeated_words(words)) / size,
        total(c["chars"] <= 3) / size,
        total(c["wide"]) / one,
    ]
    low = words.hash & np.uint64(0xFFFF)
    sign = np.where(low & np.uint64(1), 1.0, -1.0)
    bucket = (low >> np.uint64(1)).astype(np.int64) % HASHED
    lexical = np.bincount(owner * HASHED + bucket, sign, first[-1] * HASHED).reshape(-1, HASHED)
    return np.column_stack([*shape, lexical / np.sqrt(size)[:, None] / 4]).astype(np.float32), first


WIDTH = 12 + HASHED


class Attention:
    """The network; ``forward`` keeps what ``backward`` needs."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @classmethod
    def fresh(cls, width: int, seed: int = SEED) -> "Attention":
        r = np.random.default_rng(seed)
        init = lambda *shape: r.normal(0, 1 / np.sqrt(shape[0]), shape)
        return cls(
            {"w": init(width, HIDDEN), "b": np.zeros(HIDDEN), "v": init(HIDDEN, GATE), "u": init(HIDDEN, GATE)}
            | {"a": init(GATE), "c": init(HIDDEN), "d": np.zeros(1), "mean": np.zeros(width), "scale": np.ones(width)}
        )

    def forward(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        p = self.p
        self.x = (x - p["mean"]) * p["scale"]
        self.h = np.tanh(self.x @ p["w"] + p["b"])
        self.t, self.s = np.tanh(self.h @ p["v"]), sigmoid(self.h @ p["u"])
        raw = (self.t * self.s) @ p["a"]
        starts, sizes = first[:-1], np.diff(first)
        self.bag = np.repeat(np.arange(len(starts)), sizes)
        grown = np.exp(raw - np.maximum.reduceat(raw, starts)[self.bag])
        self.weight = grown / np.add.reduceat(grown, starts)[self.bag]
        self.z = np.add.reduceat(self.weight[:, None] * self.h, starts)
        return self.z @ p["c"] + p["d"][0]

    def backward(self, g: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, gb = self.p, g[self.bag]
        gz = gb[:, None] * p["c"]
        gw = (gz * self.h).sum(1)
        mean = np.add.reduceat(self.weight * gw, first[:-1])[self.bag]
        graw = self.weight * (gw - mean)
        gate = graw[:, None] * p["a"]
        gt, gs = gate * self.s * (1 - self.t**2), gate * self.t * self.s * (1 - self.s)
        gh = (self.weight[:, None] * gz + gt @ p["v"].T + gs @ p["u"].T) * (1 - self.h**2)
        return {
            "w": self.x.T @ gh,
            "b": gh.sum(0),
            "v": self.h.T @ gt,
            "u": self.h.T @ gs,
            "a": (self.t * self.s).T @ graw,
            "c": self.z.T @ g,
            "d": np.array([g.sum()]),
        }


def train(x: np.ndarray, first: np.ndarray, y: np.ndarray, weights: np.ndarray, steps: int = STEPS) -> Attention:
    model = Attention.fresh(x.shape[1])
    model.p["mean"], model.p["scale"] = x.mean(0), 1 / (x.std(0) + 0.05)
    learned = {k: v for k, v in model.p.items() if k not in ("mean", "scale")}
    adam = Adam(learned, RATE)
    for _ in range(steps):
        g = weights * (sigmoid(model.forward(x, first)) - y) / len(y)
        found = model.backward(g, first)
        adam.update({k: v + DECAY * learned[k] * (k not in ("b", "d")) for k, v in found.items()})
    return model


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Attention | float:
    """The trained network; where there are no two labels to tell apart, a constant score."""

    def extract(texts: Sequence[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for some in slices(texts):
            x, first = passages(some)
            out += [x[a:b].tobytes() for a, b in zip(first, first[1:])]
        return out

    bags, y, weights = sample(documents, labels, "quality", extract, per_class)
    if len(set(y)) < 2:
        return float((y.sum() + 1) / (len(y) + 2))
    parts = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in bags]
    first = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return train(np.concatenate(parts).astype(np.float64), first, y, weights)


def quality_score(model: Attention | float, spark: SparkSession) -> Column:
    shipped = spark.sparkContext.broadcast(model if isinstance(model, float) else model.p)

    def score(text: pd.Series) -> pd.Series:
        if isinstance(shipped.value, float):
            return pd.Series(shipped.value, index=text.index, dtype="float64")
        out = [np.zeros(0)]
        for some in slices(list(text)):
            x, first = passages(some)
            out.append(sigmoid(Attention(shipped.value).forward(x.astype(np.float64), first)))
        return pd.Series(np.concatenate(out))

    return F.pandas_udf(score, DoubleType())(F.col("text"))


def score_quality(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    score = quality_score(fit(documents, labels, per_class), documents.sparkSession)
    scored = documents.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= KEEP_AT).cast("int"))


def keep_quality(documents: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT, per_class: int = PER_CLASS) -> DataFrame:
    """Documents that the classifier accepts, all columns as they were."""
    return documents.where(quality_score(fit(documents, labels, per_class), documents.sparkSession) >= keep_at)
