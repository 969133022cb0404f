"""Filter interaction audit: what each of five filters removes, in every order of them.

A document's failures are a set of filters, so a corpus is a histogram over 32 masks. Let M
hold 0 where a mask has a filter and infinity elsewhere, and let P hold each filter's
position in each order (the inverse permutations). The min-plus product of M and P is the
step at which a document of that mask is removed under that order: its earliest failing
filter. Scattering the mask counts by that step gives all tallies at once.

Filters fail a text (NULL is empty) that has: A under 200 words; B 100 * distinct words <
50 * words; C 100 * ``[A-Z]`` characters > 3 * code points; D any of ``#$%&*|``; E the very
text of a row with a smaller doc_id, anywhere in the table. Words are
``[^\\x20\\x09-\\x0D]+``.

E needs no join of rows: copies of a text share A to D, so per text (its SHA-256) partial
sums by part and label are enough, and of a text copied into a third of the rows a
map task sends a handful of sums. A part has 32 rows at most when its tallies are made, in a
task of its own, so nothing is gathered on the driver.

Defined cases: a NULL lang is the part of the empty name; a NULL doc_id is neither smaller
nor greater than another and has no label; rows that repeat a doc_id and its text are
not smaller than each other; of several labels of a doc_id any 1 counts; an empty text fails A alone; a very long
text is read whole by one task, whose memory follows its number of words; an empty table
has no parts; further columns are not looked at.
"""

from __future__ import annotations

import re
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataflow.llm.rows import join_hot

FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
_SYMBOL = re.compile(rb"[#$%&*|]")
_UPPER = bytes(range(65, 91))
#: UTF-8 bytes that begin no code point.
_INNER = bytes(range(0x80, 0xC0))

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)


def text_mask(data: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = data.split()  # bytes split at exactly \x20 and \x09-\x0D
    n = len(words)
    few = n < LEAST_WORDS
    same = 100 * len(set(words)) < DISTINCT_PERCENT * n
    upper = len(data) - len(data.translate(None, _UPPER))
    loud = 100 * upper > UPPER_PERCENT * len(data.translate(None, _INNER))
    return few | same << 1 | loud << 2 | (_SYMBOL.search(data) is not None) << 3


def mask_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows, good and toxic ones of each (part, mask)."""

    @F.pandas_udf("int")
    def text_masks(texts: pd.Series) -> pd.Series:
        return texts.map(text_mask)

    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = documents.select(
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.col("doc_id").alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text_masks(text.cast("binary")).alias("own"),
    )
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    labelled = join_hot(narrow, marked, "id", "left").select(
        "part", "id", "digest", "own", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    )
    kind = ["digest", "part", "own", "good", "toxic"]
    per_id = labelled.groupBy(*kind, "id").agg(F.count(F.lit(1)).alias("n"))
    per_kind = per_id.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.min("id").alias("least"),
        F.min_by("n", "id").alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("without"),
    )
    # Few rows a text: one for each part and label it comes with.
    first = F.min("least").over(Window.partitionBy("digest"))
    told = per_kind.withColumn("first", first).select(
        "part", "own", "good", "toxic", "n",
        (F.col("n") - F.col("without") - F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)).alias("later"),
    )
    repeat = 1 << FILTERS.index("E")
    either = F.array(
        F.struct(F.col("own").alias("mask"), (F.col("n") - F.coalesce("later", F.lit(0))).alias("n")),
        F.struct(F.col("own").bitwiseOR(F.lit(repeat)).alias("mask"), F.coalesce("later", F.lit(0)).alias("n")),
    )
    masks = told.select("part", "good", "toxic", F.inline(either))
    return masks.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
    )


ORDERS = np.array(list(permutations(range(len(FILTERS)))))
#: Position of filter f in order o, from 0.
POSITIONS = np.argsort(ORDERS, axis=1)


def removal_steps(masks: np.ndarray) -> np.ndarray:
    """Min-plus product: for each mask and order the position of the filter that removes it, or 5 for none."""
    never = len(FILTERS)
    has = (masks[:, None] >> np.arange(never)) & 1
    return np.where(has[:, None, :] == 1, POSITIONS[None, :, :], never).min(axis=2)


def tally(masks: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> pd.DataFrame:
    """All measures of one part, a row for each order and step."""
    size, orders = len(FILTERS), len(ORDERS)
    steps = removal_steps(masks)
    row = np.broadcast_to(np.arange(orders), steps.shape)

    def scatter(weights: np.ndarray) -> np.ndarray:
        out = np.zeros((orders, size + 1), np.int64)
        np.add.at(out, (row, steps), weights[:, None])
        return out[:, :size]

    removed = scatter(n)
    redundant = np.zeros((orders, size), np.int64)
    unique = np.zeros(size, np.int64)
    shapley = np.zeros(size, np.int64)
    every = np.arange(orders)
    for f in range(size):
        fails = (masks >> f) & 1 == 1
        at = POSITIONS[:, f]
        redundant[every, at] = ((steps[fails] < at[None, :]) * n[fails, None]).sum(axis=0)
        unique[f] = n[masks == 1 << f].sum()
        shapley[f] = removed[every, at].sum()
    columns = {
        "filter_order": np.repeat(["".join(FILTERS[f] for f in order) for order in ORDERS], size),
        "step": np.tile(np.arange(1, size + 1, dtype=np.int32), orders),
        "kept": (n.sum() - removed.cumsum(axis=1)).ravel(),
        "removed": removed.ravel(),
        "redundant": redundant.ravel(),
        "unique_fails": unique[ORDERS].ravel(),
        "good_lost": scatter(good).ravel(),
        "toxic_lost": scatter(toxic).ravel(),
        "shapley": shapley[ORDERS].ravel(),
    }
    return pd.DataFrame(columns)


def audit_filters(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step, with the measures named in ``RESULT``."""

    def one_part(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = tally(*[rows[c].to_numpy(np.int64) for c in ("mask", "n", "good", "toxic")])
        out.insert(0, "part", key[0])
        return out

    return mask_counts(documents, labels).groupBy("part").applyInPandas(one_part, RESULT)
