"""Toxicity: a factorization machine over hashed terms.

Terms are the distinct plain words of a text and their beginnings of three to five
characters (so that inflected forms share a term), hashed. Besides a weight each term
has a vector of ``FACTORS``, and the product of two terms' vectors is the weight of their
meeting in one text, as an insult and a group name do; added weights alone miss it.

Learned from at most ``PER_CLASS`` documents of each label (see ``training``), on every term
that these hold; scored on every whole text with all of them. A term enters with a value between 0 and 1
by what it tells of the classes in the sample, z / (z + ``EVIDENCE``) for its chi-square z, or by
how many documents hold it, whichever is more: words met once or twice, most of any vocabulary,
can't be learned by heart, and terms that tell nothing alone can still tell together. A toxic
document missed costs ``MISS_COST`` times a clean one flagged.

Defined cases: NULL and empty texts have no terms and get the score of none; very long
texts are scored whole; repeated rows are rows; a term that the sample lacks tells nothing; without labels, or with one label alone,
every score is the smoothed share of label 1; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from strataflow.llm.plain import plain
from strataflow.llm.training import PER_CLASS, Adam, held_out, sample, sigmoid

BUCKETS, FACTORS = 1 << 18, 8
PREFIXES = (3, 4, 5)
STEPS, RATE, DECAY, SEED = 80, 0.05, 5e-4, 11
TOXIC_AT = 0.5
#: Words whose terms a worker keeps: the frequent ones, in a few MB.
CACHE_WORDS = 50_000
#: Chi-square of a term at which its value is a half; most that a term has by its frequency, and documents for half of that.
EVIDENCE, COMMON, HALF_COMMON = 25, 0.1, 50
MISS_COST = 3
#: Entries of the sample's matrix gathered at once.
GATHERED = 1 << 19


def terms_of(word: str) -> list[int]:
    parts = ["=" + word] + ["<" + word[:k] for k in PREFIXES if len(word) >= k]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


def term_sets(texts: Sequence[str | None]) -> list[bytes]:
    return [np.unique(np.array([t for w in set(plain(x).split()) for t in terms_of(w)], np.int32)).tobytes() for x in texts]


def term_values(sets: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The value of each hash: 0 for one that no document of the sample holds."""
    held = [np.concatenate([s for s, v in zip(sets, y) if v == k] or [np.zeros(0, int)]) for k in (0, 1)]
    clean, toxic = (np.bincount(h.astype(int), minlength=BUCKETS) for h in held)
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    both = clean + toxic
    spread = np.maximum(both * n0 * n1 / (n0 + n1) ** 2 * (1 - both / (n0 + n1 + 1)), 1e-9)
    z = (toxic - both * n1 / (n0 + n1)) ** 2 / spread
    return np.where(both > 0, np.maximum(z / (z + EVIDENCE), COMMON * both / (both + HALF_COMMON)), 0)


def segment_sums(values: np.ndarray, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[index]`` over the stretches between the starts (one more at the end), a part at a time."""
    out = np.zeros((len(starts) - 1, *values.shape[1:]), values.dtype)
    filled = np.flatnonzero(np.diff(starts))
    at = 0
    while at < len(filled):
        first = starts[filled[at]]
        until = max(at + 1, np.searchsorted(starts[filled + 1], first + GATHERED, side="right"))
        some = filled[at:until]
        out[some] = np.add.reduceat(values[index[first : starts[some[-1] + 1]]], starts[some] - first)
        at = until
    return out


class Machine:
    """``weights`` and ``factors`` have a row for each hash, those of unknown terms are 0."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors
        self.squares = (factors**2).sum(1)
        self.kept: dict[str, array] = {}

    def _terms(self, word: str) -> array:
        found = self.kept.get(word)
        if found is None:
            found = array("i", terms_of(word))
            if len(self.kept) >= CACHE_WORDS:
                self.kept.clear()
            if len(word) <= 64:
                self.kept[word] = found
        return found

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        out = []
        for text in texts:
            some = np.unique(np.frombuffer(b"".join([self._terms(w) for w in set(plain(text).split())]), np.intc))
            met = self.factors[some].sum(0)
            out.append(self.bias + self.weights[some].sum() + 0.5 * ((met**2).sum() - self.squares[some].sum()))
        return sigmoid(np.array(out, float))


def train(sets: list[np.ndarray], y: np.ndarray, weights: np.ndarray, steps: int = STEPS) -> Machine:
    """Full-batch descent on the weighted logistic loss, over the terms that each document holds."""
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    terms, index = np.unique(np.concatenate(sets), return_inverse=True)
    by_term = np.argsort(index, kind="stable")
    of_term = np.concatenate((np.searchsorted(index[by_term], np.arange(len(terms))), [len(index)]))
    row = np.repeat(np.arange(len(sets)), np.diff(starts))[by_term]
    value = term_values(sets, y)[terms].astype(np.float32)
    weights = weights * np.where(y == 1, MISS_COST, 1)
    share = np.average(y, weights=weights)
    p = {
        "bias": np.array([np.log(share / (1 - share))], np.float32),
        "weights": np.zeros(len(terms), np.float32),
        "factors": np.random.default_rng(SEED).normal(0, 0.01, (len(terms), FACTORS)).astype(np.float32),
    }
    adam = Adam(p, RATE)
    for _ in range(steps):
        factors = p["factors"] * value[:, None]
        alone = p["weights"] * value - 0.5 * (factors**2).sum(1)
        met = segment_sums(np.column_stack([factors, alone]), index, starts)
        logit = p["bias"][0] + met[:, -1] + 0.5 * (met[:, :-1] ** 2).sum(1)
        g = (weights * (sigmoid(logit) - y) / len(y)).astype(np.float32)
        back = segment_sums(np.column_stack([g[:, None] * met[:, :-1], g]), row, of_term) * value[:, None]
        adam.update(
            {
                "bias": np.array([g.sum()]),
                "weights": back[:, -1] + DECAY * p["weights"],
                "factors": back[:, :-1] - back[:, -1:] * factors + DECAY * p["factors"],
            }
        )
    all_weights, all_factors = np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32)
    all_weights[terms], all_factors[terms] = p["weights"] * value, p["factors"] * value[:, None]
    return Machine(float(p["bias"][0]), all_weights, all_factors)


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Machine | float:
    found, y, weights = sample(documents, labels, "toxic", term_sets, per_class)
    if len(set(y)) < 2:
        return float((y.sum() + 1) / (len(y) + 2))
    return train([np.frombuffer(b, np.int32) for b in found], y, weights)


def toxicity_score(model: Machine | float, spark: SparkSession) -> Column:
    shipped = spark.sparkContext.broadcast(model)

    def score(text: pd.Series) -> pd.Series:
        if isinstance(shipped.value, float):
            return pd.Series(shipped.value, index=text.index, dtype="float64")
        return pd.Series(shipped.value.score(text))

    return F.pandas_udf(score, DoubleType())(F.col("text"))


def score_toxicity(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    score = toxicity_score(fit(documents, labels, per_class), documents.sparkSession)
    scored = documents.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_AT).cast("int"))
