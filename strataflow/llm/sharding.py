"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Each row gets its number in a fixed order. The permutation sends the number n of N
to a place in 0..N-1; shard and slot are the remainder and quotient of that place,
so both can be computed for any row number without data, the counts of two shards
differ by one at most, and the slots of a shard have no gap.

Defined cases: a NULL text has size 1 and a NULL checksum; an empty text size 1 and
checksum 0; very long texts are carried whole; NULL ids sort first, and ties go by the whole row; repeated
rows get numbers of their own; an empty table gives no rows. Input columns with the name of an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.rows import number_rows

ROUNDS = 6
SEED = 20240101
_MASK = np.uint64(0xFFFFFFFF)


def domain(n: int) -> tuple[int, int]:
    """Two moduli whose product is the least near-square that holds n."""
    a = max(2, isqrt(max(n - 1, 0)) + 1)
    return a, max(2, -(-n // a))


def _mix(half: np.ndarray, key: int) -> np.ndarray:
    z = (half * np.uint64(0x9E3779B1) + np.uint64(key)) & _MASK
    z ^= z >> np.uint64(15)
    z = (z * np.uint64(0x85EBCA77)) & _MASK
    z ^= z >> np.uint64(13)
    return z


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    return [(seed * (2 * r + 1) * 2654435761 + r) % 2**32 for r in range(rounds)]


def permute(numbers: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """Places of row numbers under the permutation of 0..n-1."""
    if n >= 2**62:
        raise ValueError("row numbers take 62 bits at most")
    a, b = map(np.uint64, domain(n))
    keys = round_keys(seed)

    def once(x):
        left, right = x % a, x // a
        for r, key in enumerate(keys):
            if r % 2:
                right = (right + _mix(left, key)) % b
            else:
                left = (left + _mix(right, key)) % a
        return right * a + left

    out = once(np.asarray(numbers, dtype=np.uint64))
    while (walking := out >= n).any():
        out[walking] = once(out[walking])
    return out.astype(np.int64)


def shard_rows(df: DataFrame, order: Sequence[Column | str], shards: int, seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` and ``slot``; rows are numbered in the given order."""
    packed = df.select(F.struct("*").alias("row"), *[c.alias(f"o{i}") for i, c in enumerate(_columns(order))])
    numbered, total = number_rows(packed, [F.col(f"o{i}").asc_nulls_first() for i in range(len(order))], "number")

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), total, seed))

    placed = numbered.select("row", place("number").alias("place"))
    names = [name for name in df.columns if name not in ("shard", "slot")]
    return placed.select(
        *[F.col("row")[name].alias(name) for name in names],
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )


def _columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def text_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_documents(documents: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """Documents with shard and slot; numbered by doc_id, then checksum and size of the text."""
    return shard_rows(documents, ["doc_id", F.crc32("text"), text_size()], shards, seed)


def shard_digest(documents: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """The shard table: no text goes through the shuffle."""
    narrow = documents.select("doc_id", text_size().alias("size"), F.crc32("text").alias("text_crc32"))
    placed = shard_rows(narrow, ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})
