"""Centred moments of pairs that can be merged: count, means, sums of squares and products about the means.

A table of them stands for the rows it was made of: correlation and least-squares fit of
any union of the rows come from the merged moments, and new rows are the only ones to be read
again. Moments about the mean lose no digits where the values are large and
their spread is small, as plain sums of squares would.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.operators.project import drop_null


def moments(df: DataFrame, group: Sequence[str], x: str, y: str) -> DataFrame:
    """Moments of the complete pairs of each group, by partial aggregation."""
    n = F.count(F.lit(1))
    return drop_null(df, x, y).groupBy(*group).agg(
        n.alias("n"),
        F.avg(x).alias("x_mean"),
        F.avg(y).alias("y_mean"),
        (F.var_pop(x) * n).alias("xx"),
        (F.var_pop(y) * n).alias("yy"),
        (F.covar_pop(x, y) * n).alias("xy"),
        *[f(c).cast("double").alias(f"{name}_{end}") for name, c in (("x", x), ("y", y)) for end, f in (("min", F.min), ("max", F.max))],
    )


def merge_moments(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Moments of the union of the rows behind the parts of each group.

    The spread of the union is that within the parts and that of their means about the
    common mean, which is found first. Rows without pairs count for nothing.
    """
    group = list(group)
    known = parts.where(F.col("n") > 0)
    weigh = lambda name: (F.sum(F.col("n") * F.col(name)) / F.sum("n"))
    common = known.groupBy(*[F.col(g).alias(f"_of_{g}") for g in group]).agg(weigh("x_mean").alias("_x"), weigh("y_mean").alias("_y"))
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group])
    moved = known.join(common, same).withColumns({"_dx": F.col("x_mean") - F.col("_x"), "_dy": F.col("y_mean") - F.col("_y")})

    def spread(inner: str, a: str, b: str) -> Column:
        return F.sum(F.col(inner) + F.col("n") * F.col(a) * F.col(b)).alias(inner)

    return moved.groupBy(*group).agg(
        F.sum("n").alias("n"), weigh("x_mean").alias("x_mean"), weigh("y_mean").alias("y_mean"),
        spread("xx", "_dx", "_dx"), spread("yy", "_dy", "_dy"), spread("xy", "_dx", "_dy"),
        F.min("x_min").alias("x_min"), F.max("x_max").alias("x_max"), F.min("y_min").alias("y_min"), F.max("y_max").alias("y_max"),
    )


def fit_of(merged: DataFrame, group: Sequence[str]) -> DataFrame:
    """Least-squares line and correlation of each group: as ``linear_fit``, with ``pearson`` beside it.

    A constant x has no line, a constant side or a single pair no correlation.
    """
    # Told by the range, as merged means of equal values may differ in the last digit.
    x_varies, y_varies = F.col("x_min") < F.col("x_max"), F.col("y_min") < F.col("y_max")
    slope = F.when(x_varies, F.try_divide("xy", "xx"))
    pearson = F.when(x_varies & y_varies, F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")))
    return merged.withColumns({"slope": slope, "pearson": pearson}).select(
        *group, "slope", (F.col("y_mean") - F.col("slope") * F.col("x_mean")).alias("intercept"),
        (F.col("pearson") * F.col("pearson")).alias("r2"), "n", "x_min", "x_max", "pearson",
    )
