"""Joins: lookups that withstand hot keys, override merge, fact join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.parsing import blank_to_null
from strataflow.functions.text import name_key
from strataflow.operators.dedup import comparable, first_per_key
from strataflow.operators.project import require_columns

#: Pieces that rows without a key are spread over; they match nothing, wherever they are.
KEYLESS_PIECES = 64


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    hot: Sequence[tuple] = (),
    pieces: int = 16,
) -> DataFrame:
    """Join a large left side, hot keys and all, to a right side unique on ``on``.

    Nothing runs while the frame is built. Whether the right side is broadcast is left to
    the planner, and with adaptive execution to the sizes met at run time, under their own
    bounds. Otherwise both sides are shuffled, in a way that lets adaptive execution split a hot
    key: it does so only right behind a shuffle, which the join on a key that the right side
    is already dealt by would save. So the rows carry a piece number that is part of the join key.

    Rows without a key are spread by their content, so that a retried task
    repeats it. So are those of the keys that the caller names as ``hot``, over
    ``pieces``; the right rows of these keys, and no others, are repeated once a piece.
    """
    on, piece = list(on), "_piece"
    # Always 0, in a form that isn't folded.
    one = F.pmod(F.xxhash64(*on), F.lit(1)).cast("int")
    keyless = reduce(or_, [F.col(name).isNull() for name in on])
    spread = lambda n: F.pmod(F.xxhash64(*comparable(left)), F.lit(n)).cast("int")
    named = [reduce(and_, [F.col(name).eqNullSafe(F.lit(value)) for name, value in zip(on, key)]) for key in hot]
    is_hot = reduce(or_, named, F.lit(False))
    mine = F.when(keyless, spread(KEYLESS_PIECES))
    theirs = right.withColumn(piece, one)
    if hot:
        mine = mine.when(is_hot, spread(pieces))
        copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(one))
        theirs = right.withColumn(piece, F.explode(copies))
    return left.withColumn(piece, mine.otherwise(one)).join(theirs, [*on, piece], how).drop(piece)


def map_keys(facts: DataFrame, mapping: DataFrame, *, key: str, values: Sequence[str]) -> DataFrame:
    """Left lookup on ``key``: a mapped value wins over the row's own."""
    require_columns(mapping, [key, *values], "mapping")
    table = mapping.select(key, *values)
    lookup = first_per_key(table, [key])
    renamed = lookup.select(key, *[F.col(v).alias(f"_mapped_{v}") for v in values])
    own = [F.col(v) if v in facts.columns else F.lit(None).cast(mapping.schema[v].dataType) for v in values]
    joined = lookup_join(facts, renamed, [key])
    return joined.withColumns(
        {v: F.coalesce(F.col(f"_mapped_{v}"), mine) for v, mine in zip(values, own)}
    ).drop(*[f"_mapped_{v}" for v in values])


def merge_overrides(
    base: DataFrame,
    overrides: DataFrame,
    *,
    key: str,
    values: Sequence[str],
    source: str = "source_precedence",
    override_tag: str = "override",
    default_tag: str = "world_bank",
) -> DataFrame:
    """Full-outer merge in which an override wins field by field and is tagged as such."""
    require_columns(overrides, [key, *values], "overrides")
    theirs = overrides.select(key, *[F.col(v).alias(f"_override_{v}") for v in values])
    joined = base.join(theirs, [key], "full_outer").where(F.col(key).isNotNull())
    overridden = F.coalesce(*[F.col(f"_override_{v}") for v in values]).isNotNull()
    merged = joined.select(
        key,
        *[F.coalesce(f"_override_{v}", v).alias(v) for v in values],
        F.when(overridden, F.lit(override_tag))
        .otherwise(F.coalesce(blank_to_null(source), F.lit(default_tag)))
        .alias(source),
    )
    return first_per_key(merged, [key])


def join_measures(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Left join that keeps only rows with the right side's measure.

    Both sides are unique on the keys, hence no key is hot, and arrive hashed on
    them from their own dedup, hence no further shuffle. Catalyst turns the outer
    join into an inner one.
    """
    return left.join(right.select(*keys, measure), list(keys), "left").where(F.col(measure).isNotNull())


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Rows of the left without a measured partner."""
    return left.join(right.where(F.col(measure).isNotNull()).select(*keys), list(keys), "left_anti")


def count_unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """How many rows of the left have no measured partner, and how many there are."""
    joined = left.select(*keys).join(right.select(*keys, measure), list(keys), "left")
    return joined.agg(F.count_if(F.col(measure).isNull()).alias("missing"), F.count(F.lit(1)).alias("pairs"))


def not_seen(new: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key was not seen before. A NULL key counts as new.

    The seen side is reduced to its distinct keys. Copies of one record may fill a
    large part of the new rows, see ``lookup_join``.
    """
    return lookup_join(new, seen.select(*keys).distinct(), keys, "left_anti")


def with_name_key(df: DataFrame, name: str, key: str) -> DataFrame:
    """Add the key of a name column: each distinct name is folded once and joined back."""
    names = df.select(name).distinct().withColumn(key, name_key(name))
    return lookup_join(df.drop(key), names, [name]).withColumn(key, F.coalesce(key, F.lit("")))


def for_requested(requested: list[int], stats: DataFrame, key: str = "year") -> DataFrame:
    """One row per requested key, whether or not there are statistics for it."""
    spark = stats.sparkSession
    keys = F.array(*[F.lit(int(k)) for k in dict.fromkeys(requested)])
    rows = spark.range(0, 1, 1, 1).select(F.explode(keys).alias(key))
    return rows.join(stats, [key], "left")
