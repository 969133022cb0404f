"""Nested to flat and wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.parsing import bind, col_of


def zip_cells(headers: Column | str, cells: Column | str) -> Column:
    """Map from headers to cells by position.

    A short row is padded with NULL, extra cells are ignored, and of a repeated
    header the last one counts.
    """
    names = col_of(headers)

    def pair_up(values: Column) -> Column:
        pairs = F.transform(names, lambda name, i: F.struct(name.alias("key"), F.get(values, i).alias("value")))
        last = F.filter(
            pairs,
            lambda pair, i: pair["key"].isNotNull()
            & ~F.array_contains(F.slice(names, i + 2, F.size(names)), pair["key"]),
        )
        return F.map_from_entries(last)

    return bind(cells, pair_up)


def unnest_rows(df: DataFrame, rows: Column | str, keep: Sequence[str], alias: str = "row") -> DataFrame:
    """One output row per element of an array column."""
    return df.select(*keep, F.explode(col_of(rows)).alias(alias))


def wide_to_long(
    df: DataFrame, ids: Sequence[str], columns: Mapping[str, int], *, key: str = "year", value: str = "value"
) -> DataFrame:
    """One row per (row, column) with a value: ``columns`` maps a name to its key.

    A pass over the rows in place, as the pairs of one row are exploded where it lies.
    """
    pairs = F.array(
        *[F.struct(F.lit(k).alias(key), F.col(name).cast("double").alias(value)) for name, k in columns.items()]
    )
    long = df.select(*ids, F.explode(F.filter(pairs, lambda p: p[value].isNotNull())).alias("_pair"))
    return long.select(*ids, "_pair.*")


def long_to_wide(df: DataFrame, ids: Sequence[str], columns: Mapping[str, int], *, key: str = "year", value: str) -> DataFrame:
    """The reverse: one column per listed key, NULL where a group lacks it."""
    return df.groupBy(*ids).agg(
        *[F.max(F.when(F.col(key) == k, F.col(value))).alias(name) for name, k in columns.items()]
    )
