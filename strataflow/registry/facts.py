"""Fact join, statistics, ranking and summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.functions.text import fixed_point
from strataflow.operators.dedup import distinct_years, first_per_key, last_per_key, top_per_key
from strataflow.operators.joins import count_unmatched, lookup_join, unmatched
from strataflow.operators.moments import fit_of, merge_moments, moments
from strataflow.operators.project import drop_null, keep_expected, union_all, year_between
from strataflow.operators.stats import correlation, fit_line, linear_fit, residual_outliers, top_n, top_rows
from strataflow.plans.analytics import HIGHEST, LOWEST, NAME, RATIO, X, Y, correlation_summary, regression
from strataflow.registry import query
from strataflow.registry.inputs import (
    CURATED_SQL,
    PART_SQL,
    nation_years,
    part_prices,
    part_returns,
    part_years,
    table,
)
from strataflow.session import fresh_folder

KEYS = ["country_code", "year"]
SUMMARY_YEARS = [1997, 1999, 2001, 2023]


@query(
    "curated_join",
    f"""WITH {CURATED_SQL}
SELECT *, 'world_bank_api' AS gdp_source_system, 'wikipedia_co2' AS co2_source_system,
       'run-1' AS first_ingestion_run_id, 'run-1' AS last_update_run_id,
       CAST(1704067200 AS BIGINT) AS last_update_s
FROM curated""",
)
def curated_join(spark, sf):
    return nation_years(spark, sf).withColumn("last_update_s", F.unix_seconds("last_update_ts")).drop("last_update_ts")


@query(
    "part_year_curated",
    f"WITH {PART_SQL} SELECT country_code, year, gdp_per_capita_usd, co2_tons_per_capita, co2_per_1000usd_gdp FROM curated",
)
def part_year_curated(spark, sf):
    return keep_expected(part_years(spark, sf), [*KEYS, X, Y, RATIO])


@query(
    "missing_pairs",
    f"""WITH {PART_SQL}
SELECT country_code, year FROM prices p WHERE NOT EXISTS (
  SELECT 1 FROM returned r WHERE r.country_code = p.country_code AND r.year = p.year)""",
)
def missing_pairs(spark, sf):
    return unmatched(part_prices(spark, sf), part_returns(spark, sf), KEYS, Y).select(*KEYS)


@query(
    "missing_pair_count",
    f"""WITH {PART_SQL}
SELECT count(*) FILTER (WHERE r.co2_tons_per_capita IS NULL) AS missing, count(*) AS pairs
FROM prices p LEFT JOIN returned r ON r.country_code = p.country_code AND r.year = p.year""",
)
def missing_pair_count(spark, sf):
    return count_unmatched(part_prices(spark, sf), part_returns(spark, sf), KEYS, Y)


@query(
    "pearson_by_year",
    f"""WITH {CURATED_SQL}
SELECT year, round(corr(co2_tons_per_capita, gdp_per_capita_usd), 6) AS pearson FROM curated GROUP BY year""",
)
def pearson_by_year(spark, sf):
    return correlation(nation_years(spark, sf), ["year"], X, Y).withColumn("pearson", F.round("pearson", 6))


_FIT_SQL = """fit AS (
  SELECT year, regr_slope(co2_tons_per_capita, gdp_per_capita_usd) AS slope,
         regr_intercept(co2_tons_per_capita, gdp_per_capita_usd) AS intercept,
         corr(co2_tons_per_capita, gdp_per_capita_usd) AS r, count(*) AS n,
         min(gdp_per_capita_usd) AS x_min, max(gdp_per_capita_usd) AS x_max
  FROM curated GROUP BY year)"""

_FIT_OUT = """year, round(slope, 8) AS slope, round(intercept, 4) AS intercept, round(r * r, 6) AS r2, n, x_min, x_max"""


def _rounded_fit(fit):
    return fit.withColumns(
        {"slope": F.round("slope", 8), "intercept": F.round("intercept", 4), "r2": F.round("r2", 6)}
    )


@query("regression_by_year", f"WITH {CURATED_SQL}, {_FIT_SQL} SELECT {_FIT_OUT} FROM fit")
def regression_by_year(spark, sf):
    return _rounded_fit(linear_fit(nation_years(spark, sf), ["year"], X, Y))


_MOMENTS_SQL = """year, round(slope, 8) AS slope, round(intercept, 4) AS intercept, round(r * r, 6) AS r2, n, x_min, x_max,
  round(r, 6) AS pearson"""


def _rounded_moments(fit):
    return _rounded_fit(fit).withColumn("pearson", F.round("pearson", 6))


@query("moments_merged", f"WITH {PART_SQL}, {_FIT_SQL} SELECT {_MOMENTS_SQL} FROM fit")
def moments_merged(spark, sf):
    """Fits from the stored moments of five increments, none of which was read again."""
    path, rows = fresh_folder(spark, "moments"), part_years(spark, sf)
    dealt = rows.withColumn("increment", F.pmod(F.xxhash64(F.col("country_code")), F.lit(5)))
    for i in range(5):
        increment = moments(dealt.where(F.col("increment") == i), ["year"], X, Y)
        increment.write.mode("append").parquet(path)
    return _rounded_moments(fit_of(merge_moments(spark.read.parquet(path), ["year"]), ["year"]))


@query("part_year_regression", f"WITH {PART_SQL}, {_FIT_SQL} SELECT {_FIT_OUT} FROM fit")
def part_year_regression(spark, sf):
    return _rounded_fit(linear_fit(part_years(spark, sf), ["year"], X, Y))


@query(
    "fit_line_points",
    f"""WITH {CURATED_SQL}, {_FIT_SQL},
line AS (SELECT year, slope, intercept, CAST(i AS INTEGER) AS i,
                CASE WHEN i = 199 THEN x_max ELSE x_min + i * ((x_max - x_min) / 199) END AS x_line
         FROM fit, range(200) r(i))
SELECT year, i, round(x_line, 4) AS x_line, round(slope * x_line + intercept, 4) AS y_line FROM line""",
)
def fit_line_points(spark, sf):
    line = fit_line(linear_fit(nation_years(spark, sf), ["year"], X, Y), ["year"])
    return line.select("year", "i", F.round("x_line", 4).alias("x_line"), F.round("y_line", 4).alias("y_line"))


_OUTLIER_SQL = """scored AS (
  SELECT c.year, c.country_code, c.country_name, c.gdp_per_capita_usd AS x, c.co2_tons_per_capita AS y,
         c.co2_per_1000usd_gdp AS ratio, f.slope * c.gdp_per_capita_usd + f.intercept AS y_hat
  FROM curated c JOIN fit f ON c.year = f.year),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY abs(y - y_hat) DESC, country_code) AS INTEGER)
         AS outlier_rank
  FROM scored)"""
_OUTLIER_OUT = "year, country_code, round(y_hat, 4) AS y_hat, round(y - y_hat, 4) AS residual"


def _outliers(rows):
    picked = residual_outliers(rows, ["year"], X, Y)
    return picked.select(
        "year", "country_code", F.round("y_hat", 4).alias("y_hat"), F.round("residual", 4).alias("residual"), "outlier_rank"
    )


@query(
    "residual_outliers",
    f"WITH {CURATED_SQL}, {_FIT_SQL}, {_OUTLIER_SQL} SELECT {_OUTLIER_OUT}, outlier_rank FROM ranked WHERE outlier_rank <= 7",
)
def nation_outliers(spark, sf):
    return _outliers(nation_years(spark, sf))


@query(
    "part_year_outliers",
    f"WITH {PART_SQL}, {_FIT_SQL}, {_OUTLIER_SQL} SELECT {_OUTLIER_OUT}, outlier_rank FROM ranked WHERE outlier_rank <= 7",
)
def part_year_outliers(spark, sf):
    return _outliers(part_years(spark, sf))


@query(
    "regression_points",
    f"""WITH {CURATED_SQL}, {_FIT_SQL}, {_OUTLIER_SQL}
SELECT {_OUTLIER_OUT}, country_name, x, y, ratio,
       CASE WHEN outlier_rank <= 7 THEN outlier_rank END AS outlier_rank FROM ranked""",
)
def regression_points(spark, sf):
    points = regression(nation_years(spark, sf)).points
    return points.withColumns({"y_hat": F.round("y_hat", 4), "residual": F.round("residual", 4)})


def _top_sql(source: str, order: str) -> str:
    return f"""WITH {source}, ranked AS (
  SELECT year, country_name, co2_per_1000usd_gdp, CAST(row_number() OVER (
    PARTITION BY year ORDER BY co2_per_1000usd_gdp {order}, country_name) AS INTEGER) AS position
  FROM curated WHERE co2_per_1000usd_gdp IS NOT NULL)
SELECT * FROM ranked WHERE position <= 5"""


@query("top5_high", _top_sql(CURATED_SQL, "DESC"))
def top5_high(spark, sf):
    return top_n(nation_years(spark, sf), ["year"], RATIO, NAME)


@query("top5_low", _top_sql(CURATED_SQL, "ASC"))
def top5_low(spark, sf):
    return top_n(nation_years(spark, sf), ["year"], RATIO, NAME, ascending=True)


@query("part_year_top5", _top_sql(PART_SQL, "DESC"))
def part_year_top5(spark, sf):
    return top_n(part_years(spark, sf), ["year"], RATIO, NAME)


def summary_sql(source: str, years: list[int], entry: str) -> str:
    wanted = ", ".join(f"({year})" for year in years)
    lists = ", ".join(
        f"""(SELECT coalesce(string_agg({entry}, ';' ORDER BY p), '') FROM (
    SELECT c.country_name, c.co2_per_1000usd_gdp, row_number() OVER (
      ORDER BY c.co2_per_1000usd_gdp {order}, c.country_name) AS p
    FROM curated c WHERE c.year = w.year AND c.co2_per_1000usd_gdp IS NOT NULL) t WHERE p <= 5) AS {name}"""
        for name, order in ((HIGHEST, "DESC"), (LOWEST, "ASC"))
    )
    return f"""WITH {source}, wanted(year) AS (VALUES {wanted})
SELECT CAST(w.year AS INTEGER) AS year,
       (SELECT round(corr(co2_tons_per_capita, gdp_per_capita_usd), 6) FROM curated c WHERE c.year = w.year)
         AS pearson_correlation_gdp_co2, {lists}
FROM wanted w"""


@query("summary_by_year", summary_sql(CURATED_SQL, SUMMARY_YEARS, "country_name"))
def summary_by_year(spark, sf):
    summary = correlation_summary(nation_years(spark, sf), SUMMARY_YEARS, with_values=False)
    return summary.withColumn("pearson_correlation_gdp_co2", F.round("pearson_correlation_gdp_co2", 6))


@query(
    "summary_with_values",
    summary_sql(CURATED_SQL, SUMMARY_YEARS, "printf('%s: %.3f', country_name, co2_per_1000usd_gdp)"),
)
def summary_with_values(spark, sf):
    summary = correlation_summary(nation_years(spark, sf), SUMMARY_YEARS)
    return summary.withColumn("pearson_correlation_gdp_co2", F.round("pearson_correlation_gdp_co2", 6))


@query(
    "fixed_point_text",
    "SELECT o_orderkey, printf('%s: %.3f', o_orderpriority, o_totalprice / 7) AS entry FROM orders",
)
def fixed_point_text(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", fixed_point(F.col("o_orderpriority"), F.col("o_totalprice") / 7).alias("entry")
    )


@query(
    "dedup_first",
    """SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def dedup_first(spark, sf):
    rows = first_per_key(table(spark, sf, "events"), ["user_id", "event_type"], ["ts"])
    return rows.select("user_id", "event_type", "event_id", "value")


@query(
    "dedup_last",
    """SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""",
)
def dedup_last(spark, sf):
    rows = last_per_key(table(spark, sf, "events"), ["user_id", "event_type"], ["ts"])
    return rows.select("user_id", "event_type", "event_id", "value")


def _order_years(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))


@query("distinct_years", "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def distinct_order_years(spark, sf):
    return distinct_years(_order_years(spark, sf))


@query("max_year", "SELECT CAST(max(year(o_orderdate)) AS INTEGER) AS max_year, count(*) AS n FROM orders")
def max_year(spark, sf):
    return _order_years(spark, sf).agg(F.max("year").alias("max_year"), F.count(F.lit(1)).alias("n"))


@query(
    "year_range_filter",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
WHERE year(o_orderdate) > 1996 AND year(o_orderdate) <= 1999""",
)
def year_range_filter(spark, sf):
    return year_between(_order_years(spark, sf), "year", 1996, 1999)


@query(
    "complete_labels",
    """SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
)
def complete_labels(spark, sf):
    labels = table(spark, sf, "labels")
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(labels, "doc_id", "left")
    return drop_null(joined, "quality", "toxic")


@query(
    "union_by_name",
    """SELECT c_custkey AS account, c_nationkey AS nationkey, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL BY NAME SELECT s_suppkey AS account, s_nationkey AS nationkey, s_acctbal AS balance FROM supplier""",
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("account"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_suppkey").alias("account"),
        F.col("s_nationkey").alias("nationkey"),
    )
    return union_all([customers, suppliers])


@query(
    "topk_global",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def topk_global(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return top_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 100)


_CHATS_SQL = """chats AS (
  SELECT conv_id % 97 AS k, turn, role, conv_id, row_number() OVER (
    PARTITION BY conv_id % 97 ORDER BY turn DESC, conv_id DESC, role) AS p FROM conversations)"""


@query("dedup_nested", f"WITH {_CHATS_SQL} SELECT k, conv_id, turn, role FROM chats WHERE p = 1")
def dedup_nested(spark, sf):
    """Rows that hold maps inside an array inside a struct, the last of each key."""
    chats = table(spark, sf, "conversations").select(
        (F.col("conv_id") % 97).alias("k"),
        "turn",
        "conv_id",
        F.struct(F.array(F.create_map(F.lit("role"), F.col("role"))).alias("turns")).alias("nested"),
    )
    rows = last_per_key(chats, ["k"], ["turn", "conv_id"])
    return rows.select("k", "conv_id", "turn", F.col("nested.turns")[0]["role"].alias("role"))


@query(
    "salted_lookup",
    """SELECT l_orderkey, l_linenumber, l_returnflag, n FROM lineitem JOIN (
  SELECT l_returnflag AS f, count(*) AS n FROM lineitem GROUP BY 1) ON l_returnflag = f""",
)
def salted_lookup(spark, sf):
    """A shuffled join on a key of three values, every one of them hot."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    flags = lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    hot = [(flag,) for flag in ("A", "N", "R")]
    joined = lookup_join(lines, flags.hint("merge"), ["l_returnflag"], "inner", hot=hot, pieces=8)
    return joined.select("l_orderkey", "l_linenumber", "l_returnflag", "n")


@query(
    "top_many",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, note,
  CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INTEGER) AS position
FROM (SELECT *, 'line ' || l_linenumber || ' of ' || l_orderkey AS note FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 5000""",
)
def top_many(spark, sf):
    """The 5000 dearest lines of each flag, of which one has half the lines."""
    note = F.concat(F.lit("line "), F.col("l_linenumber"), F.lit(" of "), F.col("l_orderkey"))
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", note.alias("note"))
    order = {"l_extendedprice": True, "l_orderkey": False, "l_linenumber": False}
    return top_per_key(lines, ["l_returnflag"], order, 5000, rank="position")
