"""Quality rules: gradient-boosted trees over document statistics.

The statistics are exact counts over the whole text. Trees are grown on a bounded
labelled sample (see ``training``) by Newton steps on binned statistics, with the score
held monotonic in the statistics named in ``MONOTONIC``: more symbols, duplicate lines or
repetition never help a document. A model is five flat numpy arrays of nodes; scoring
moves all rows one level down at a time.

A document that fails the base rule is out whatever the trees say. Defined cases: NULL
and empty texts have all counts zero and fail the base rule; very long texts are counted
whole; repeated rows are rows; without labels, or with one label alone, every score is
the smoothed share of label 1; an empty table gives no rows; other columns are not
looked at. Words and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from strataflow.llm.textstats import duplicate_lines, repeated_words, slices, words_of
from strataflow.llm.training import PER_CLASS, sample, sigmoid

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "bangs", "pipes", "lines", "distinct",
)
#: -1: the score may only fall as the statistic grows.
MONOTONIC = {"symbols": -1, "dup_lines": -1, "repeats": -1, "upper": -1, "bangs": -1, "pipes": -1}
TREES, DEPTH, BINS, RATE, L2, LEAST_WEIGHT = 60, 4, 64, 0.2, 1.0, 1.0
KEEP_AT = 0.3
#: Fixed values of the base rule.
LEAST_WORDS, MOST_REPEAT_PERCENT = 10, 20


def statistics(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(counts in the order of COUNTS, features in the order of FEATURES), a row a text."""
    words = words_of(texts)
    n = words.first[1:] - words.first[:-1]
    total = {name: words.per_text(values) for name, values in words.counts.items()}
    lines = np.array([duplicate_lines(t) for t in texts], np.int64).reshape(-1, 2)
    repeats = words.per_text(repeated_words(words))
    order = np.lexsort((words.hash, words.doc))
    fresh = np.ones(len(order), np.int64)
    fresh[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (words.doc[order][1:] != words.doc[order][:-1])
    distinct = words.per_text(fresh)
    size, chars = np.maximum(1, n), np.maximum(1, total["chars"])
    features = np.column_stack(
        [
            np.log1p(n), total["chars"] / size, total["symbols"] / size, lines[:, 1] / np.maximum(1, lines[:, 0]), repeats / size,
            total["upper"] / chars, total["digits"] / chars, total["bangs"] / size, total["pipes"] / size, lines[:, 0] / size, distinct / size,
        ]
    )
    return np.column_stack([n, total["chars"], total["symbols"], lines[:, 1], repeats]), features


class Trees:
    """Nodes of all trees end to end. A leaf points to itself, so rows may rest there."""

    def __init__(self, feature, threshold, left, right, value, roots, base: float):
        self.feature, self.threshold = np.array(feature, np.int32), np.array(threshold, float)
        self.left, self.right = np.array(left, np.int32), np.array(right, np.int32)
        self.value, self.roots, self.base = np.array(value, float), np.array(roots, np.int32), base

    def score(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root, np.int32)
            for _ in range(DEPTH):
                below = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(below, self.left[at], self.right[at])
            out += self.value[at]
        return sigmoid(out)


def train(x: np.ndarray, y: np.ndarray, weights: np.ndarray, trees: int = TREES) -> Trees:
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    signs = np.array([MONOTONIC.get(name, 0) for name in FEATURES])
    share = np.average(y, weights=weights)
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots, logit = [], np.full(len(y), base)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, low: float, high: float) -> int:
        at = len(nodes)
        own = float(np.clip(-g[rows].sum() / (h[rows].sum() + L2), low, high))
        nodes.append([0, np.inf, at, at, RATE * own])
        if depth == DEPTH:
            logit[rows] += RATE * own
            return at
        best = None
        for j, e in enumerate(edges):
            gs = np.cumsum(np.bincount(binned[rows, j], g[rows], len(e) + 1))
            hs = np.cumsum(np.bincount(binned[rows, j], h[rows], len(e) + 1))
            gl, hl, gr, hr = gs[:-1], hs[:-1], gs[-1] - gs[:-1], hs[-1] - hs[:-1]
            vl, vr = np.clip(-gl / (hl + L2), low, high), np.clip(-gr / (hr + L2), low, high)
            allowed = (hl >= LEAST_WEIGHT * 1e-3) & (hr >= LEAST_WEIGHT * 1e-3) & (signs[j] * (vr - vl) >= 0)
            gain = np.where(allowed, -(gl * vl + (hl + L2) * vl**2 / 2) - (gr * vr + (hr + L2) * vr**2 / 2), -np.inf)
            if len(gain) and (k := int(gain.argmax())) is not None and (best is None or gain[k] > best[0]):
                best = (gain[k], j, k, vl[k], vr[k])
        stay = -(g[rows].sum() * own + (h[rows].sum() + L2) * own**2 / 2)
        if best is None or best[0] <= stay + 1e-6:
            logit[rows] += RATE * own
            return at
        _, j, k, vl, vr = best
        middle = (vl + vr) / 2
        bounds = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}[int(signs[j])]
        under = binned[rows, j] <= k
        left = grow(rows[under], g, h, depth + 1, *bounds[0])
        right = grow(rows[~under], g, h, depth + 1, *bounds[1])
        nodes[at] = [j, float(edges[j][k]), left, right, 0.0]
        return at

    for _ in range(trees):
        p = sigmoid(logit)
        g, h = weights * (p - y), weights * p * (1 - p)
        roots.append(grow(np.arange(len(y)), g, h, 0, -np.inf, np.inf))
    return Trees(*zip(*nodes), roots, base)


def _sampled(texts: Sequence[str | None]) -> list[bytes]:
    return [row.tobytes() for some in slices(texts) for row in statistics(some)[1]]


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Trees | float:
    found, y, weights = sample(documents, labels, "quality", _sampled, per_class)
    if len(set(y)) < 2:
        return float((y.sum() + 1) / (len(y) + 2))
    return train(np.array([np.frombuffer(b) for b in found]), y, weights)


_RESULT = StructType([StructField(name, LongType()) for name in COUNTS] + [StructField("score", DoubleType())])


def rule_statistics(model: Trees | float, spark: SparkSession) -> Column:
    """Struct of the counts and the trees' score of each text."""
    shipped = spark.sparkContext.broadcast(model)

    def judge(text: pd.Series) -> pd.DataFrame:
        model, parts = shipped.value, [pd.DataFrame(columns=[*COUNTS, "score"]).astype({"score": float})]
        for some in slices(list(text)):
            counts, features = statistics(some)
            part = pd.DataFrame(counts, columns=list(COUNTS))
            part["score"] = model if isinstance(model, float) else model.score(features)
            parts.append(part)
        return pd.concat(parts[1:], ignore_index=True) if len(parts) > 1 else parts[0]

    return F.pandas_udf(judge, _RESULT)(F.col("text"))


def judge_quality(documents: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT, per_class: int = PER_CLASS) -> DataFrame:
    """One row a document: doc_id, counts, score, whether the base rule failed, and whether it is kept."""
    model = fit(documents, labels, per_class)
    read = documents.select("doc_id", rule_statistics(model, documents.sparkSession).alias("s")).select("doc_id", "s.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    judged = read.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= keep_at))
