"""Per-group correlation, linear fit, residual ranks and ordered lists.

Statistics are algebraic aggregates: map tasks send one small row per group, so
one year may hold most of the data without a hot task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.text import fixed_point
from strataflow.operators.dedup import first_per_key
from strataflow.operators.joins import lookup_join
from strataflow.operators.project import drop_null


def _pearson(x: str, y: str):
    """NULL on a constant side or fewer than two pairs, where ``corr`` would fail or give NaN."""
    return F.when(
        F.count(F.lit(1)) >= 2,
        F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)),
    )


def correlation(df: DataFrame, group: Sequence[str], x: str, y: str, name: str = "pearson") -> DataFrame:
    """Pearson correlation over complete pairs."""
    return drop_null(df, x, y).groupBy(*group).agg(_pearson(x, y).alias(name))


def linear_fit(df: DataFrame, group: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares line of y on x with r2 (squared correlation), count and range of x."""
    fit = drop_null(df, x, y).groupBy(*group).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        _pearson(x, y).alias("_r"),
        F.count(F.lit(1)).alias("n"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
    )
    return fit.select(
        *group, "slope", "intercept", (F.col("_r") * F.col("_r")).alias("r2"), "n", "x_min", "x_max"
    )


def fit_line(fit: DataFrame, group: Sequence[str], points: int = 200) -> DataFrame:
    """Evenly spaced points of each fitted line over the range of x."""
    step = F.lit(points - 1)
    spread = fit.where(F.col("slope").isNotNull()).select(
        *group, "slope", "intercept", "x_min", "x_max", F.explode(F.sequence(F.lit(0), step)).alias("i")
    )
    x = F.when(F.col("i") == step, F.col("x_max")).otherwise(
        F.col("x_min") + F.col("i") * ((F.col("x_max") - F.col("x_min")) / step)
    )
    return spread.select(*group, "i", x.alias("x_line"), (F.col("slope") * x + F.col("intercept")).alias("y_line"))


def with_residuals(df: DataFrame, fit: DataFrame, group: Sequence[str], x: str, y: str) -> DataFrame:
    """Add the fitted value and the residual."""
    lines = fit.select(*group, "slope", "intercept")
    y_hat = F.col("slope") * F.col(x) + F.col("intercept")
    joined = lookup_join(drop_null(df, x, y), lines, list(group))
    return joined.withColumn("y_hat", y_hat).withColumn("residual", F.col(y) - F.col("y_hat")).drop("slope", "intercept")


def residual_outliers(
    df: DataFrame, group: Sequence[str], x: str, y: str, n: int = 7, fit: DataFrame | None = None
) -> DataFrame:
    """The ``n`` points of each group farthest from its line, with their rank."""
    lines = linear_fit(df, group, x, y) if fit is None else fit
    scored = with_residuals(df, lines, group, x, y).where(F.col("residual").isNotNull())
    return first_per_key(scored, list(group), [F.abs("residual").desc()], n, rank="outlier_rank")


def top_n(
    df: DataFrame, group: Sequence[str], value: str, label: str, n: int = 5, ascending: bool = False
) -> DataFrame:
    """The ``n`` rows of each group with the highest or lowest value, NULLs left out."""
    order = F.col(value).asc() if ascending else F.col(value).desc()
    rows = drop_null(df, value, label).select(*group, label, value)
    return first_per_key(rows, list(group), [order, F.col(label)], n, rank="position")


def ranked_list(
    ranked: DataFrame, group: Sequence[str], value: str, label: str, name: str, with_value: bool = True
) -> DataFrame:
    """The ranked rows of a group as one text, ``label: 0.000`` joined by semicolons."""
    entry = fixed_point(F.col(label), F.col(value)) if with_value else F.col(label)
    entries = F.array_sort(F.collect_list(F.struct(F.col("position"), entry.alias("entry"))))
    return ranked.groupBy(*group).agg(F.array_join(entries["entry"], ";").alias(name))


def top_rows(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """The first ``n`` rows overall; each task keeps its own n, no full sort."""
    return df.orderBy(*order).limit(n)
