"""Inputs the queries share, derived from the given tables, with their SQL."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.plans.curate import curate

RUN_ID = "run-1"
SNAPSHOT_TS = datetime(2024, 1, 1, tzinfo=timezone.utc)
CODE, YEAR = "country_code", "year"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def econ(spark: SparkSession, sf: str) -> DataFrame:
    """Mean order price per nation and year, as the GDP side.

    Orders are summed per customer before the join, so a customer with most of
    the orders arrives there as a few rows.
    """
    price = F.col("o_totalprice").cast("decimal(15,2)")
    per_customer = (
        table(spark, sf, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias(YEAR))
        .agg(F.sum(price).alias("total"), F.count(F.lit(1)).alias("n"))
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", YEAR)
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_nationkey").cast("string").alias(CODE),
        F.col("n_name").alias("country_name"),
        YEAR,
        (F.col("total").cast("double") / F.col("n")).alias("gdp_per_capita_usd"),
    )


def env(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity shipped per nation and year, as the CO2 side."""
    per_supplier = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", F.year("l_shipdate").alias(YEAR))
        .agg(F.sum("l_quantity").alias("total"))
    )
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    per_nation = (
        per_supplier.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", YEAR)
        .agg(F.sum("total").alias("total"))
    )
    return per_nation.select(
        F.col("s_nationkey").cast("string").alias(CODE), YEAR, F.col("total").alias("co2_tons_per_capita")
    )


def nation_years(spark: SparkSession, sf: str) -> DataFrame:
    return curate(econ(spark, sf), env(spark, sf), run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS)


def part_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Mean price per part and year."""
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias(CODE), F.year("l_shipdate").alias(YEAR), price.alias("price")
    )
    return lines.groupBy(CODE, YEAR).agg((F.sum("price").cast("double") / F.count(F.lit(1))).alias("gdp_per_capita_usd"))


def part_returns(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity returned per part and year; not every part has one in every year."""
    lines = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    keyed = lines.select(F.col("l_partkey").cast("string").alias(CODE), F.year("l_shipdate").alias(YEAR), "l_quantity")
    return keyed.groupBy(CODE, YEAR).agg(F.sum("l_quantity").alias("co2_tons_per_capita"))


def part_years(spark: SparkSession, sf: str) -> DataFrame:
    """Curated rows at the grain (part, year): mean price against quantity returned."""
    prices, returned = part_prices(spark, sf), part_returns(spark, sf)
    named = prices.withColumn("country_name", F.concat(F.lit("part "), CODE))
    return curate(named, returned, run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS)


ECON_SQL = """econ AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS country_code, n_name AS country_name,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) / count(*) AS gdp_per_capita_usd
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3)"""

ENV_SQL = """env AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS country_code, CAST(year(l_shipdate) AS INTEGER) AS year,
         sum(l_quantity) AS co2_tons_per_capita
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""

CURATED_SQL = f"""{ECON_SQL}, {ENV_SQL}, curated AS (
  SELECT e.country_code, e.country_name, e.year, e.gdp_per_capita_usd, v.co2_tons_per_capita,
         CASE WHEN e.gdp_per_capita_usd > 0
              THEN v.co2_tons_per_capita * CAST(1000 AS DOUBLE) / e.gdp_per_capita_usd END AS co2_per_1000usd_gdp
  FROM econ e LEFT JOIN env v ON e.country_code = v.country_code AND e.year = v.year
  WHERE v.co2_tons_per_capita IS NOT NULL)"""

PART_SQL = """prices AS (
  SELECT CAST(l_partkey AS VARCHAR) AS country_code, CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) / count(*) AS gdp_per_capita_usd
  FROM lineitem GROUP BY 1, 2),
returned AS (
  SELECT CAST(l_partkey AS VARCHAR) AS country_code, CAST(year(l_shipdate) AS INTEGER) AS year,
         sum(l_quantity) AS co2_tons_per_capita
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
curated AS (
  SELECT p.country_code, 'part ' || p.country_code AS country_name, p.year, p.gdp_per_capita_usd, r.co2_tons_per_capita,
         CASE WHEN p.gdp_per_capita_usd > 0
              THEN r.co2_tons_per_capita * CAST(1000 AS DOUBLE) / p.gdp_per_capita_usd END AS co2_per_1000usd_gdp
  FROM prices p JOIN returned r ON p.country_code = r.country_code AND p.year = r.year)"""
