"""All layers in order, from landed files to the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from strataflow.plans import defaults
from strataflow.plans.analytics import EmptyFit, build_correlation_summary, build_regression
from strataflow.plans.curate import build_and_save_curated
from strataflow.plans.fits import refresh_moments
from strataflow.plans.ingest import ingest_pages, ingest_records
from strataflow.plans.ledger import RunLedger
from strataflow.plans.mapping import build_and_save_mapping
from strataflow.plans.processed import process_records, process_tables, remap_tables
from strataflow.sinks.seen import SeenKeys
from strataflow.sources.tables import read_mapping


@dataclass(frozen=True)
class Layers:
    """Where each dataset lives below one root."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])


@dataclass
class Artefacts:
    """Paths written by each step; a skipped step has none."""

    paths: dict[str, str | None] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


def run_layers(
    spark: SparkSession,
    envelopes: DataFrame,
    pages: DataFrame,
    root: str,
    *,
    min_year: int | None = None,
    max_year: int | None = None,
    overrides_path: str | None = None,
    skip_empty_fit: bool = False,
    page_values: Mapping[str, int] | None = None,
    report_years: Sequence[int] = defaults.REPORT_YEARS,
    now: datetime | None = None,
) -> Artefacts:
    """Ingest, type, map, curate and report.

    Typed tables are fed by the file streams of RAW: whatever an earlier run landed
    but failed to type is typed now, and a changed page replaces its own rows alone. Records
    are told new by their content, so late revisions of any year arrive, and names
    that the API brings later are given to the rows of pages typed before.
    With ``skip_empty_fit`` a missing regression does not end the run.
    """
    layers, done = Layers(root), Artefacts()
    ledger = RunLedger(spark, layers.path("metadata"))
    gdp, co2 = layers.path("processed", "gdp"), layers.path("processed", "co2")
    mapping, curated = layers.path("processed", "country_mapping"), layers.path("curated", "country_year")

    def note(step: str, written) -> None:
        done.paths[step] = None if written is None else written.path
        done.rows[step] = 0 if written is None else written.rows

    raw = ingest_records(
        envelopes, layers.path("raw", "gdp"), ledger, min_year=min_year, max_year=max_year,
        seen=SeenKeys(spark, layers.path("metadata", "seen_records")), now=now,
    )
    note("records_raw", raw)
    note("records_processed", process_records(spark, layers.path("raw", "gdp"), gdp, layers.path("state", "gdp")))
    note("mapping", build_and_save_mapping(spark, gdp, mapping, overrides_path))
    landed = ingest_pages(
        pages, layers.path("raw", "co2"), ledger, rejects=layers.path("rejects", "co2"),
        seen=SeenKeys(spark, layers.path("metadata", "seen_pages")), now=now,
    )
    note("tables_raw", landed)
    typed = process_tables(
        spark, layers.path("raw", "co2"), co2, layers.path("state", "co2"), read_mapping(spark, mapping), values=page_values
    )
    note("tables_processed", typed)
    note("tables_remapped", remap_tables(spark, mapping, layers.path("state", "applied_mapping"), co2))
    note("curated", build_and_save_curated(spark, gdp, co2, curated, ledger, now=now))
    try:
        done.paths.update(build_regression(spark, curated, layers.path("analytics"), now=now))
    except EmptyFit:
        if not skip_empty_fit:
            raise
    refresh_moments(spark, curated, layers.path("analytics", "moments"))
    done.paths["summary"] = build_correlation_summary(
        spark, curated, layers.path("analytics"), report_years, now
    )
    return done
