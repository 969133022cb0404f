"""RAW layer: landed API pages and HTML pages to audited JSON lines."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.hashing import canonical_json
from strataflow.functions.parsing import parse_year
from strataflow import schemas
from strataflow.operators.html_tables import page_tables
from strataflow.operators.joins import not_seen
from strataflow.operators.project import with_audit, year_between
from strataflow.plans import defaults
from strataflow.plans.ledger import SKIPPED, RunLedger
from strataflow.session import discard, settle
from strataflow.sinks.seen import SeenKeys
from strataflow.sinks.tables import Written, write_raw
from strataflow.sources.landed import read_json_lines, unpack_envelope


def baseline_year(checkpoint: str | None, min_year: int | None) -> int | None:
    """Year above which records are new.

    The checkpoint if it is a number; ``min_year - 1`` where that lies further on.
    """
    try:
        mark = None if checkpoint is None else int(checkpoint)
    except ValueError:
        mark = None
    if min_year is not None and (mark is None or min_year > mark):
        return min_year - 1
    return mark


def new_records(records: DataFrame, baseline: int | None, max_year: int | None, date: str = "date") -> DataFrame:
    """Records whose year lies above the baseline and within the bound."""
    dated = records.withColumn("_year", parse_year(date))
    return year_between(dated, "_year", baseline, max_year).drop("_year")


def record_key() -> Column:
    """What an API record is about: entity, indicator and date."""
    return F.sha1(F.to_json(F.struct("countryiso3code", "country.id", "country.value", "indicator.id", "date"), {"ignoreNullFields": "false"}))


def ingest_records(
    envelopes: DataFrame,
    raw_root: str,
    ledger: RunLedger,
    *,
    min_year: int | None = None,
    max_year: int | None = None,
    run_scope: str = defaults.RECORD_SCOPE,
    checkpoint_key: str = defaults.RECORD_CHECKPOINT,
    seen: SeenKeys | None = None,
    now: datetime | None = None,
) -> Written:
    """Append the new records of landed API pages to RAW and move the year mark.

    Records above the mark are new. Where ``seen`` keeps the last hash of every record, the hash tells instead:
    records of any year are loaded that were not met before, or with another content
    last. The hashes are noted once the records are written; a run that dies in between
    loads them again, and typing keeps one row a key.

    Count and new mark are observed while writing.
    """
    stamp = now or datetime.now(timezone.utc)
    with ledger.run(run_scope) as run:
        checkpoint = ledger.load_checkpoint(checkpoint_key)
        baseline = baseline_year(None if seen is not None else checkpoint, min_year)
        fresh = new_records(unpack_envelope(envelopes), baseline, max_year)
        path = f"{raw_root.rstrip('/')}/{run_scope}_raw_{stamp:%Y%m%dT%H%M%S%fZ}"
        read = None
        if seen is not None and not seen.is_empty():
            # Read twice, for the folders to look into and for the records; the payload is canonical.
            read = settle(fresh)
            fresh = seen.changed(read, record_key(), F.sha1("payload"))
        kept = with_audit(
            fresh,
            "payload",
            run_id=run.run_id,
            ingestion_ts=stamp.isoformat(),
            data_source=defaults.GDP_SOURCE,
            location=path,
            canonical=True,
        ).drop("payload")
        written = write_raw(kept, path, {"max_year": F.max(parse_year("date"))})
        if seen is not None:
            stored = read_json_lines(envelopes.sparkSession, path, schemas.RAW_RECORD)
            seen.add(stored, record_key(), "record_hash", F.lit(stamp))
        if read is not None:
            discard(read)
        newest = written.metrics.get("max_year")
        if newest is not None and checkpoint is not None and seen is not None:
            # A run that brought revisions of old years alone doesn't move the mark back.
            newest = max(newest, baseline_year(checkpoint, None) or newest)
        if newest is not None:
            ledger.save_checkpoint(checkpoint_key, newest)
        run.rows = written.rows
        run.checkpoint = checkpoint if newest is None else str(newest)
        if run.checkpoint is not None and baseline_year(run.checkpoint, None) is None:
            run.checkpoint = None
    return written


def _text(value) -> str | None:
    return None if value is None else str(value)


def changed_pages(pages: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Pages whose revision differs from the one last taken from the same source.

    ``pages`` has (source, revid); a page without a revision is always taken.
    """
    seen = checkpoints.select("source", F.col("value").alias("_revision"))
    keyed = pages.withColumn("_revision", F.col("revid").cast("string"))
    return not_seen(keyed, seen, ["source", "_revision"]).drop("_revision")


def revised_pages(pages: DataFrame, seen: SeenKeys) -> DataFrame:
    """As ``changed_pages``, by the last revision of each URL in ``seen``."""
    keyed = pages.withColumn("_revision", F.col("revid").cast("string"))
    known = seen.changed(keyed.where(F.col("revid").isNotNull()), "url", "_revision")
    return known.unionByName(keyed.where(F.col("revid").isNull())).drop("_revision")


def table_snapshots(
    pages: DataFrame, *, run_id: str, ingestion_ts: str, location: str, strict: bool = False
) -> DataFrame:
    """RAW snapshot record of each page's table. The hash covers the table, not the audit fields."""
    content = F.struct(F.col("url").alias("page_url"), "headers", "rows")
    payload = canonical_json(F.to_json(content, {"ignoreNullFields": "false"}))
    return page_tables(pages, strict=strict).select(
        F.lit(run_id).alias("ingestion_run_id"),
        F.lit(ingestion_ts).alias("ingestion_ts"),
        F.lit(defaults.CO2_SOURCE).alias("data_source"),
        F.col("url").alias("page_url"),
        "pageid",
        "revid",
        "rev_timestamp",
        "table_html",
        content.alias("raw_table_json"),
        F.sha1(payload).alias("record_hash"),
        F.lit(location).alias("raw_file_path"),
    )


def ingest_pages(
    pages: DataFrame,
    raw_root: str,
    ledger: RunLedger,
    *,
    run_scope: str = defaults.TABLE_SCOPE,
    checkpoint_key: str = defaults.TABLE_CHECKPOINT,
    strict: bool = True,
    rejects: str | None = None,
    seen: SeenKeys | None = None,
    now: datetime | None = None,
) -> Written | None:
    """Append table snapshots of changed pages to RAW; None when nothing changed.

    ``pages`` has (url, html, pageid, revid, rev_timestamp). Each page keeps its
    own mark, and only a page whose snapshot was written moves it. Marks are checkpoints of
    the ledger, ``checkpoint_key`` followed by the URL, or for many pages the last revisions in ``seen``,
    of which a run reads the folders of its own pages. Pages without a usable table go to the ``rejects`` table with the
    reason and are tried again; where no page is usable, a strict load fails.
    ``rows_processed`` counts table rows, as a snapshot is one record.
    """
    stamp = now or datetime.now(timezone.utc)
    with ledger.run(run_scope) as run:
        keyed = pages.withColumn("source", F.concat(F.lit(f"{checkpoint_key}:"), "url"))
        if seen is None:
            changed = settle(changed_pages(keyed, ledger.checkpoints()))
        else:
            changed = settle(revised_pages(keyed, seen))
        if changed.isEmpty():
            run.status, run.rows = SKIPPED, 0
            run.checkpoint = _text(pages.agg(F.max("revid")).first()[0])
            # There may be none yet; the stream behind needs the folder.
            spark = pages.sparkSession
            spark.createDataFrame([], schemas.RAW_TABLE).write.mode("append").json(f"{raw_root.rstrip('/')}/_none")
            return None
        path = f"{raw_root.rstrip('/')}/{run_scope}_raw_{stamp:%Y%m%dT%H%M%S%fZ}"
        records = table_snapshots(changed, run_id=run.run_id, ingestion_ts=stamp.isoformat(), location=path)
        written = write_raw(records, path, {"table_rows": F.sum(F.size("raw_table_json.rows")), "revid": F.max("revid")})
        stored = read_json_lines(pages.sparkSession, path, schemas.RAW_TABLE).select("page_url", "revid")
        if seen is None:
            ledger.save_checkpoints(
                stored.select(
                    F.concat(F.lit(f"{checkpoint_key}:"), "page_url").alias("source"),
                    F.coalesce(F.col("revid").cast("string"), F.lit("")).alias("value"),
                )
            )
        else:
            seen.add(stored, "page_url", F.col("revid"), F.lit(stamp))
        if rejects is not None:
            bad = changed.join(stored.select(F.col("page_url").alias("url")).distinct(), "url", "left_anti")
            reason = F.when(F.coalesce(F.trim("html"), F.lit("")) == "", "empty page").otherwise("no table with a header and rows")
            bad.select(
                "url", "pageid", "revid", "rev_timestamp", reason.alias("reason"),
                F.lit(run.run_id).alias("ingestion_run_id"), F.lit(stamp).alias("rejected_ts"),
            ).write.mode("append").parquet(rejects)
        if strict and not written.rows:
            raise ValueError("no changed page has a usable table")
        run.rows = int(written.metrics.get("table_rows") or 0)
        run.checkpoint = _text(written.metrics.get("revid"))
        discard(changed)
    return written
