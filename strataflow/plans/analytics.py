"""ANALYTICS layer: correlation summary and regression tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.dedup import last_per_key
from strataflow.operators.joins import for_requested, lookup_join
from strataflow.operators.project import drop_null
from strataflow.operators.stats import (
    correlation,
    fit_line,
    linear_fit,
    ranked_list,
    residual_outliers,
    top_n,
    with_residuals,
)
from strataflow.plans import defaults
from strataflow.session import freeing, settle
from strataflow.sinks.tables import replace_table, write_report
from strataflow.sources.tables import read_curated

X, Y, RATIO, NAME = "gdp_per_capita_usd", "co2_tons_per_capita", "co2_per_1000usd_gdp", "country_name"
HIGHEST, LOWEST = "top5_countries_highest_co2_per_1000usd_gdp", "top5_countries_lowest_co2_per_1000usd_gdp"


def unique_curated(curated: DataFrame) -> DataFrame:
    """One row per (code, year): the one of the newest snapshot."""
    return last_per_key(curated, ["country_code", "year"], ["snapshot_date", "last_update_ts"])


def correlation_summary(
    curated: DataFrame, years: Sequence[int] = defaults.REPORT_YEARS, *, with_values: bool = True
) -> DataFrame:
    """One row per requested year: correlation and the top lists of the ratio.

    A year without data has a NULL correlation and empty lists.
    """
    pairs = drop_null(curated.where(F.col("year").isin(list(years))), X, Y)
    stats = correlation(pairs, ["year"], X, Y, "pearson_correlation_gdp_co2")
    for name, ascending in ((HIGHEST, False), (LOWEST, True)):
        ranked = top_n(pairs, ["year"], RATIO, NAME, defaults.TOP_N, ascending)
        stats = stats.join(ranked_list(ranked, ["year"], RATIO, NAME, name, with_values), ["year"], "left")
    return for_requested(list(years), stats).select(
        "year",
        "pearson_correlation_gdp_co2",
        F.coalesce(HIGHEST, F.lit("")).alias(HIGHEST),
        F.coalesce(LOWEST, F.lit("")).alias(LOWEST),
    )


@dataclass(frozen=True)
class Regression:
    """Tables of a fit: one row per year, per point, per line point."""

    fit: DataFrame
    points: DataFrame
    line: DataFrame


def regression(curated: DataFrame, outliers: int = defaults.OUTLIERS) -> Regression:
    """Fit of CO2 on GDP per year, points with residuals, and the drawn line.

    Points that are not among the outliers have a NULL ``outlier_rank``.
    """
    # Read for the fit, the ranks and the table.
    points = settle(drop_null(curated, X, Y, RATIO))
    fit = settle(linear_fit(points, ["year"], X, Y))
    scored = with_residuals(points, fit, ["year"], X, Y)
    ranks = residual_outliers(points, ["year"], X, Y, outliers, fit).select("year", "country_code", "outlier_rank")
    table = lookup_join(scored, ranks, ["year", "country_code"]).select(
        "year",
        "country_code",
        NAME,
        F.col(X).alias("x"),
        F.col(Y).alias("y"),
        F.col(RATIO).alias("ratio"),
        "y_hat",
        "residual",
        "outlier_rank",
    )
    return Regression(fit, table, fit_line(fit, ["year"]))


def build_correlation_summary(
    spark: SparkSession,
    curated_path: str,
    out: str,
    years: Sequence[int] = defaults.REPORT_YEARS,
    now: datetime | None = None,
) -> str:
    """Summary of the newest snapshots as headed CSV under the run date.

    With no data for any of the years the report has a header only.
    """
    stamp = now or datetime.now(timezone.utc)
    curated = read_curated(spark, curated_path, years)
    summary = correlation_summary(unique_curated(curated), years)
    if curated.isEmpty():
        summary = spark.createDataFrame([], summary.schema)
    return write_report(summary.orderBy("year"), out, defaults.REPORT_NAME, f"{stamp:%Y%m%d}")


class EmptyFit(RuntimeError):
    """There is nothing to fit a line to."""


def build_regression(
    spark: SparkSession,
    curated_path: str,
    out: str,
    year: int = defaults.FIT_YEAR,
    *,
    outliers: int = defaults.OUTLIERS,
    now: datetime | None = None,
) -> dict[str, str]:
    """Regression tables of one year under the run date; a year without points is an error."""
    stamp = now or datetime.now(timezone.utc)
    curated = read_curated(spark, curated_path, [year])
    if curated.isEmpty():
        raise EmptyFit(f"no curated data for year={year}")
    root = f"{out.rstrip('/')}/run_date={stamp:%Y%m%d}/regression"
    paths = {"fit": f"{root}/fit", "points": f"{root}/points", "line": f"{root}/line"}
    with freeing(spark):
        result = regression(unique_curated(curated), outliers)
        if result.fit.isEmpty():
            raise EmptyFit(f"no complete points for year={year}")
        for part, path in paths.items():
            replace_table(getattr(result, part), path)
    return paths
