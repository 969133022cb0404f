"""PROCESSED layer: typed API table and typed long table of HTML values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.functions.parsing import default_if_blank, parse_cell_number, parse_number, parse_utc_timestamp, parse_year
from strataflow.operators.dedup import first_per_key
from strataflow.operators.joins import map_keys, with_name_key
from strataflow.operators.project import align, drop_blank
from strataflow.operators.reshape import unnest_rows, wide_to_long
from strataflow.plans import defaults
from strataflow.plans.mapping import KEY, VALUES, mapping_changes
from strataflow.session import discard, settle
from strataflow.sinks.tables import Written, overwrite_partitions, replace_table
from strataflow.sources.tables import only_partitions, read_mapping, read_table
from strataflow.streaming.increments import load_new_files


def type_records(raw: DataFrame) -> DataFrame:
    """RAW API records to typed rows; those without code, name or year are dropped."""
    flat = raw.select(
        F.col("countryiso3code").alias("country_code"),
        F.col("country.value").alias("country_name"),
        parse_year("date").alias("year"),
        parse_number("value").alias("gdp_per_capita_usd"),
        F.col("indicator.id").alias("indicator_id"),
        F.col("indicator.value").alias("indicator_name"),
        "ingestion_run_id",
        parse_utc_timestamp("ingestion_ts").alias("ingestion_ts"),
        default_if_blank("data_source", defaults.GDP_SOURCE).alias("data_source"),
    )
    keyed = drop_blank(flat, "country_code", "country_name").where(F.col("year").isNotNull())
    return align(keyed, schemas.PROCESSED_GDP)


def type_table_rows(
    raw: DataFrame,
    mapping: DataFrame | None = None,
    *,
    location: str = defaults.LOCATION_HEADER,
    values: Mapping[str, int] | None = None,
) -> DataFrame:
    """RAW table snapshots to one row per (location, year) that has a value."""
    values = dict(defaults.VALUE_HEADERS if values is None else values)
    rows = unnest_rows(
        raw,
        "raw_table_json.rows",
        [
            "ingestion_run_id",
            parse_utc_timestamp("ingestion_ts").alias("ingestion_ts"),
            default_if_blank("data_source", defaults.CO2_SOURCE).alias("data_source"),
            F.col("raw_table_json.page_url").alias("page_url"),
        ],
    )
    ids = ["page_url", "country_name", "country_name_normalized", "ingestion_run_id", "ingestion_ts", "data_source"]
    wide = rows.where(F.col("row")[location] != "").select(
        "page_url",
        F.col("row")[location].alias("country_name"),
        "ingestion_run_id",
        "ingestion_ts",
        "data_source",
        *[parse_cell_number(F.col("row")[header]).alias(f"_{year}") for header, year in values.items()],
    )
    columns = {f"_{year}": year for year in values.values()}
    keyed = with_name_key(wide, "country_name", KEY)
    long = align(wide_to_long(keyed, ids, columns, value="co2_tons_per_capita"), schemas.PROCESSED_CO2)
    return long if mapping is None else map_names(long, mapping)


def map_names(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Typed table rows with the code and name that the mapping has for their name key."""
    return map_keys(rows, mapping, key=KEY, values=VALUES).select(*rows.columns)


def process_records(spark: SparkSession, raw_root: str, out: str, state: str) -> Written:
    """New RAW API files to the year-partitioned typed table: the latest row per (code, indicator, year)."""
    return load_new_files(
        spark, raw_root, schemas.RAW_RECORD, out, state, type_records,
        merge_on=["country_code", "indicator_id", "year"], latest_by=["ingestion_ts"],
    )


def latest_page(raw: DataFrame) -> DataFrame:
    """The newest snapshot of each page."""
    return first_per_key(raw, ["page_url"], [F.col("ingestion_ts").desc_nulls_last(), F.col("revid").desc_nulls_last()])


def process_tables(
    spark: SparkSession,
    raw_root: str,
    out: str,
    state: str,
    mapping: DataFrame | None = None,
    *,
    values: Mapping[str, int] | None = None,
) -> Written:
    """New RAW table snapshots to the year-partitioned long table.

    A page's new snapshot replaces what the page had, in whichever year; other pages stay.
    """
    return load_new_files(
        spark, raw_root, schemas.RAW_TABLE, out, state,
        lambda raw: type_table_rows(latest_page(raw), mapping, values=values), owner="page_url",
    )


def remap_tables(spark: SparkSession, mapping: str, applied: str, out: str) -> Written:
    """Map stored rows anew whose name key the mapping has got or changed since it was last applied.

    ``applied`` keeps the mapping as it was then, and is replaced once the rows are
    written: a run that dies before repeats the same changes, which alters nothing. Only
    years that hold a row to be altered are written. A name key that left the mapping keeps what
    its rows have. ``rows`` counts the altered ones.
    """
    wanted = read_mapping(spark, mapping)
    changes = settle(mapping_changes(wanted, read_table(spark, applied, schemas.MAPPING)))
    if changes.isEmpty():
        discard(changes)
        return Written(out, 0)
    stored = read_table(spark, out, schemas.PROCESSED_CO2)
    old = F.struct(*VALUES)
    altered = map_names(stored.select(KEY, "year", *VALUES, old.alias("_old")).join(changes.select(KEY), KEY, "left_semi"), changes)
    years = settle(altered.where(~F.struct(*VALUES).eqNullSafe(F.col("_old"))).groupBy("year").agg(F.count(F.lit(1)).alias("n")))
    count = years.agg(F.sum("n")).first()[0] or 0
    if count:
        new = settle(map_names(only_partitions(stored, years, ["year"]), changes))
        overwrite_partitions(new, out)
        discard(new)
    replace_table(wanted, applied)
    discard(changes, years)
    return Written(out, count)
