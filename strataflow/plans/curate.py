"""CURATED layer: two fact tables joined on entity and year."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.functions.parsing import guarded_ratio
from strataflow.operators.dedup import first_per_key
from strataflow.operators.joins import join_measures
from strataflow.operators.project import align, drop_null
from strataflow.plans import defaults
from strataflow.plans.ledger import RunLedger
from strataflow.sinks.tables import Written, write_snapshot
from strataflow.sources.tables import read_table

KEYS = ["country_code", "year"]


def unique_facts(table: DataFrame, columns: list[str], measure: str) -> DataFrame:
    """One row per (code, year), the latest ingested; rows without either key are dropped."""
    order = [F.col("ingestion_ts").desc_nulls_last()] if "ingestion_ts" in table.columns else []
    kept = drop_null(table, *KEYS).select(*columns, *(["ingestion_ts"] if order else []))
    return first_per_key(kept, KEYS, [*order, F.col(measure).asc_nulls_last()]).select(*columns)


def curated_rows(gdp: DataFrame, co2: DataFrame, *, run_id: str, snapshot_ts: datetime) -> DataFrame:
    """Join of unique facts with the guarded ratio and provenance.

    Rows without CO2 are dropped; a row without GDP stays, with a NULL ratio.
    """
    joined = join_measures(gdp, co2, KEYS, "co2_tons_per_capita")
    derived = joined.withColumns(
        {
            "co2_per_1000usd_gdp": guarded_ratio("co2_tons_per_capita", "gdp_per_capita_usd", 1000.0),
            "gdp_source_system": F.lit(defaults.GDP_SOURCE),
            "co2_source_system": F.lit(defaults.CO2_SOURCE),
            "first_ingestion_run_id": F.lit(run_id),
            "last_update_run_id": F.lit(run_id),
            "last_update_ts": F.lit(snapshot_ts),
        }
    )
    return align(derived, schemas.CURATED_ROW)


def curate(gdp_table: DataFrame, co2_table: DataFrame, *, run_id: str, snapshot_ts: datetime) -> DataFrame:
    gdp = unique_facts(gdp_table, ["country_code", "country_name", "year", "gdp_per_capita_usd"], "gdp_per_capita_usd")
    co2 = unique_facts(co2_table, ["country_code", "year", "co2_tons_per_capita"], "co2_tons_per_capita")
    return curated_rows(gdp, co2, run_id=run_id, snapshot_ts=snapshot_ts)


def build_and_save_curated(
    spark: SparkSession,
    gdp_path: str,
    co2_path: str,
    out: str,
    ledger: RunLedger,
    *,
    run_scope: str = defaults.CURATED_SCOPE,
    now: datetime | None = None,
) -> Written:
    """Curated snapshot of the day, recorded in the ledger."""
    stamp = now or datetime.now(timezone.utc)
    with ledger.run(run_scope) as run:
        rows = curate(
            read_table(spark, gdp_path, schemas.PROCESSED_GDP),
            read_table(spark, co2_path, schemas.PROCESSED_CO2),
            run_id=run.run_id,
            snapshot_ts=stamp,
        )
        written = write_snapshot(rows, out, f"{stamp:%Y%m%d}")
        run.rows = written.rows
        run.checkpoint = f"snapshot_date={stamp:%Y%m%d}"
    return written
