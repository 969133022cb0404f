"""Duplicate removal and latest-value picks.

``row_number() <= n`` is planned as a group limit on both sides of the shuffle:
each map task sends at most n rows per key, so a hot key never gathers whole in
one task. Ties are broken on every remaining column to make reruns agree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from strataflow.functions.hashing import struct_json


def holds_map(kind: DataType) -> bool:
    """Whether a type has a map or a variant at any depth, which can't be ordered or hashed."""
    if isinstance(kind, ArrayType):
        return holds_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (MapType, VariantType))


def comparable(df: DataFrame, exclude: Sequence[str] = ()) -> list[Column]:
    """All columns but the excluded ones; those with maps as canonical text."""
    kept = [f for f in df.schema.fields if f.name not in exclude]
    return [struct_json(f.name) if holds_map(f.dataType) else F.col(f.name) for f in kept]


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = (), n: int = 1, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each key in the given order; ``rank`` keeps the position."""
    named = [o for o in order if isinstance(o, str)]
    ties = comparable(df, [*keys, *named])
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    position = rank or "_position"
    ranked = df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= n)
    return ranked if rank else ranked.drop(position)


#: Above this many rows a key the planner doesn't limit a window's groups before the shuffle.
GROUP_LIMIT = 1000
#: Parts of a key that are ranked apart then.
SALTS = 64


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Mapping[str, bool], n: int, rank: str | None = None, salts: int = SALTS
) -> DataFrame:
    """The first ``n`` rows of each key where rows are wide or n is large; ``df`` is read twice.

    ``order`` names columns and whether they descend; NULL comes last. Ranked are narrow rows of
    keys, order and a 128-bit hash of the whole row, which breaks ties. The other columns of
    the winners are fetched after, through a join that moves the winners alone
    where they are few. Equal rows are ranked as one with a count. Above ``GROUP_LIMIT`` a key is ranked in
    ``salts`` parts first, each of which keeps its first n, so that of a hot key no
    task sorts more than a part, and n of each part after that.
    """
    keys, ties, whole = list(keys), ["_mark", "_mark2"], comparable(df)
    marks = [F.xxhash64(*whole).alias("_mark"), F.xxhash64(F.lit("another"), *whole).alias("_mark2")]
    sort = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order.items()] + ties
    narrow = df.select(*dict.fromkeys([*keys, *order]), *marks)
    rows = narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("_copies"))
    if n > GROUP_LIMIT:
        part = Window.partitionBy(*keys, F.pmod("_mark", F.lit(salts))).orderBy(*sort)
        rows = rows.withColumn("_at", F.row_number().over(part)).where(F.col("_at") <= n)
    window = Window.partitionBy(*keys).orderBy(*sort)
    rows = rows.withColumn("_at", F.row_number().over(window)).where(F.col("_at") <= n)
    before = F.coalesce(F.sum("_copies").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_before", before).where(F.col("_before") < n)
    winners = rows.select(*ties, "_before", F.least("_copies", n - F.col("_before")).alias("_taken"))
    fetched = df.select(F.struct("*").alias("_row"), *marks).join(winners, ties)
    once = fetched.groupBy(*ties).agg(*[F.first(c).alias(c) for c in ("_row", "_before", "_taken")])
    position = F.explode(F.sequence(F.col("_before") + 1, F.col("_before") + F.col("_taken")))
    out = once.select("_row", position.alias("_position")).select("_row.*", F.col("_position").cast("int").alias(rank or "_position"))
    return out if rank else out.drop("_position")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that sorts last."""
    return first_per_key(df, keys, [F.col(name).desc_nulls_last() for name in order])


def latest_value(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], **values: Column | str) -> DataFrame:
    """Per key the values of the row latest in ``order``, by partial aggregation."""
    columns = [(F.col(v) if isinstance(v, str) else v).alias(name) for name, v in values.items()]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_latest"))
    return picked.select(*keys, "_latest.*")


def distinct_years(df: DataFrame, year: str = "year") -> DataFrame:
    return df.select(year).where(F.col(year).isNotNull()).distinct().orderBy(year)
