"""Stored-layer queries: each writes to a fresh folder and reads back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.functions.text import partition_value
from strataflow.operators.project import union_all, with_audit
from strataflow.plans.analytics import build_correlation_summary, build_regression
from strataflow.plans.fits import fit_years
from strataflow.plans.full_run import run_layers
from strataflow.plans.ingest import ingest_pages, ingest_records
from strataflow.plans.ledger import RunLedger
from strataflow.plans.mapping import build_mapping, default_overrides
from strataflow.plans.processed import process_records, type_records, type_table_rows
from strataflow.registry import query
from strataflow.registry.cleaning import DEFAULT_OVERRIDE_ROWS
from strataflow.registry.facts import SUMMARY_YEARS, summary_sql
from strataflow.registry.inputs import CURATED_SQL, ECON_SQL, ENV_SQL, econ, env, nation_years, table
from strataflow.operators.dedup import distinct_years
from strataflow.operators.html_tables import page_tables
from strataflow.operators.reshape import long_to_wide
from strataflow.session import fresh_folder, settle
from strataflow.sinks.seen import SeenKeys
from strataflow.sinks.tables import RAW_FILE_ROWS, overwrite_partitions, replace_table, write_raw, write_snapshot
from strataflow.sources.landed import read_envelopes, read_json_lines, read_overrides
from strataflow.sources.tables import (
    for_years,
    list_files,
    read_curated,
    read_mapping,
    read_table,
    with_partition_value,
)

ECON_SCHEMA = "country_code string, country_name string, gdp_per_capita_usd double, year int"
OLD, NEW = "20240101", "20240201"


def _two_snapshots(spark, sf, between=lambda path: None) -> str:
    """Curated rows as of one day, and again from 1999 on as of a later day with twice the CO2."""
    path = fresh_folder(spark, "curated")
    rows = nation_years(spark, sf)
    write_snapshot(rows, path, OLD)
    between(path)
    later = rows.where(F.col("year") >= 1999)
    write_snapshot(later.withColumn("co2_tons_per_capita", F.col("co2_tons_per_capita") * 2), path, NEW)
    return path


_SNAPSHOT_COLUMNS = ["country_code", "year", "co2_tons_per_capita", "snapshot_date"]
_SNAPSHOT_SQL = f"""{CURATED_SQL}, stored AS (
  SELECT country_code, year, co2_tons_per_capita, '{OLD}' AS snapshot_date FROM curated
  UNION ALL SELECT country_code, year, co2_tons_per_capita * 2, '{NEW}' FROM curated WHERE year >= 1999)"""


@query(
    "snapshot_latest",
    f"""WITH {_SNAPSHOT_SQL} SELECT * FROM stored s
WHERE snapshot_date = (SELECT max(snapshot_date) FROM stored t WHERE t.year = s.year)""",
)
def snapshot_latest(spark, sf):
    return read_curated(spark, _two_snapshots(spark, sf)).select(_SNAPSHOT_COLUMNS)


@query(
    "snapshot_selected_years",
    f"""WITH {_SNAPSHOT_SQL} SELECT * FROM stored s WHERE year IN (1998, 2000)
AND snapshot_date = (SELECT max(snapshot_date) FROM stored t WHERE t.year = s.year)""",
)
def snapshot_selected_years(spark, sf):
    return read_curated(spark, _two_snapshots(spark, sf), [1998, 2000]).select(_SNAPSHOT_COLUMNS)


@query(
    "fits_refreshed",
    f"""WITH {_SNAPSHOT_SQL}, latest AS (
  SELECT s.*, gdp_per_capita_usd FROM stored s JOIN curated c ON c.country_code = s.country_code AND c.year = s.year
  WHERE snapshot_date = (SELECT max(snapshot_date) FROM stored t WHERE t.year = s.year))
SELECT year, round(regr_slope(co2_tons_per_capita, gdp_per_capita_usd), 8) AS slope, count(*) AS n,
  round(corr(co2_tons_per_capita, gdp_per_capita_usd), 6) AS pearson FROM latest GROUP BY year""",
)
def fits_refreshed(spark, sf):
    """Fits of all years after the first snapshots, and again after newer ones of some years."""
    out = fresh_folder(spark, "moments")
    path = _two_snapshots(spark, sf, between=lambda curated: fit_years(spark, curated, out).count())
    return fit_years(spark, path, out).select("year", F.round("slope", 8).alias("slope"), "n", F.round("pearson", 6).alias("pearson"))


@query("snapshot_as_of", f"WITH {_SNAPSHOT_SQL} SELECT * FROM stored WHERE snapshot_date = '{OLD}'")
def snapshot_as_of(spark, sf):
    return read_curated(spark, _two_snapshots(spark, sf), as_of="20240131").select(_SNAPSHOT_COLUMNS)


@query("snapshot_all", f"WITH {_SNAPSHOT_SQL} SELECT * FROM stored")
def snapshot_all(spark, sf):
    return read_curated(spark, _two_snapshots(spark, sf), latest_only=False).select(_SNAPSHOT_COLUMNS)


@query(
    "partition_overwrite",
    f"""WITH {ECON_SQL} SELECT country_code, country_name, year,
  CASE WHEN year = 1997 THEN gdp_per_capita_usd * 2 ELSE gdp_per_capita_usd END AS gdp_per_capita_usd FROM econ""",
)
def partition_overwrite(spark, sf):
    path, rows = fresh_folder(spark, "econ"), econ(spark, sf)
    overwrite_partitions(rows, path)
    doubled = rows.withColumn("gdp_per_capita_usd", F.col("gdp_per_capita_usd") * 2)
    overwrite_partitions(doubled.where(F.col("year") == 1997), path)
    return _stored_econ(spark, path)


def _stored_econ(spark, path):
    rows = spark.read.schema(ECON_SCHEMA).parquet(path)
    return rows.select("country_code", "country_name", "year", "gdp_per_capita_usd")


def _orders_by_year(spark, sf) -> str:
    path = fresh_folder(spark, "orders")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    overwrite_partitions(orders, path)
    return path


_ORDERS_SCHEMA = "o_orderkey bigint, o_totalprice double, year int"


@query(
    "pruned_years",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
WHERE year(o_orderdate) IN (1996, 2000)""",
)
def pruned_years(spark, sf):
    return for_years(spark.read.schema(_ORDERS_SCHEMA).parquet(_orders_by_year(spark, sf)), [1996, 2000])


@query(
    "path_partition_value",
    "SELECT CAST(year(o_orderdate) AS VARCHAR) AS year_text, count(*) AS n FROM orders GROUP BY 1",
)
def path_partition_value(spark, sf):
    stored = spark.read.schema("o_orderkey bigint").option("recursiveFileLookup", "true").parquet(_orders_by_year(spark, sf))
    return with_partition_value(stored, "year").groupBy(F.col("year").alias("year_text")).agg(F.count(F.lit(1)).alias("n"))


@query("file_listing", "SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS year_text, true AS filled FROM orders")
def file_listing(spark, sf):
    files = list_files(spark, _orders_by_year(spark, sf))
    parts = files.where(F.endswith("path", F.lit(".parquet"))).select(partition_value("path", "year").alias("year_text"), "length")
    return parts.groupBy("year_text").agg((F.sum("length") > 0).alias("filled"))


@query("absent_table_union", f"WITH {ECON_SQL} SELECT country_code, year, gdp_per_capita_usd FROM econ")
def absent_table_union(spark, sf):
    """Rows joined with those of a table that has not been written yet."""
    absent = read_table(spark, fresh_folder(spark, "absent"), schemas.PROCESSED_GDP)
    return union_all([econ(spark, sf), absent]).select("country_code", "year", "gdp_per_capita_usd")


def _raw_orders(spark, sf):
    """One API-style record per order, with the gaps the typed table must deal with."""
    status = F.col("o_orderstatus")
    code = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.col("o_orderkey").cast("string"))
    date = F.when(status == "P", F.lit("n.d.")).otherwise(F.year("o_orderdate").cast("string"))
    value = F.when(F.col("o_orderpriority") == "2-HIGH", F.lit("bad")).otherwise(F.col("o_totalprice").cast("string"))
    # Fields in name order, so that the JSON text is canonical as it is.
    payload = F.struct(
        F.struct(status.alias("id"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("value")).alias("country"),
        code.alias("countryiso3code"),
        date.alias("date"),
        F.struct(F.lit("I1").alias("id"), F.lit("price").alias("value")).alias("indicator"),
        value.alias("value"),
    )
    return table(spark, sf, "orders").select(F.to_json(payload).alias("payload"), payload.alias("record")).select("record.*", "payload")


def _write_raw_orders(spark, sf) -> str:
    path = fresh_folder(spark, "raw")
    audited = with_audit(
        _raw_orders(spark, sf), "payload", run_id="run-1", ingestion_ts="2024-01-01T00:00:00+00:00",
        data_source="", location="raw/run-1", canonical=True,
    )
    write_raw(audited.drop("payload"), path)
    return path


@query(
    "raw_round_trip",
    """WITH parts AS (
  SELECT *, CASE WHEN o_orderstatus = 'P' THEN 'n.d.' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS date,
    CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS code,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'bad' ELSE CAST(o_totalprice AS VARCHAR) END AS value FROM orders)
SELECT 'Order ' || o_orderkey AS name, date, TRY_CAST(value AS DOUBLE) AS value, 'run-1' AS ingestion_run_id,
  'raw/run-1' AS raw_file_path, sha1('{"country":{"id":"' || o_orderstatus || '","value":"Order ' || o_orderkey
  || '"},"countryiso3code":"' || code || '","date":"' || date || '","indicator":{"id":"I1","value":"price"},"value":"' || value || '"}') AS record_hash
FROM parts""",
)
def raw_round_trip(spark, sf):
    raw = read_json_lines(spark, _write_raw_orders(spark, sf), schemas.RAW_RECORD)
    return raw.select(
        F.col("country.value").alias("name"),
        "date",
        F.col("value").try_cast("double").alias("value"),
        "ingestion_run_id",
        "raw_file_path",
        "record_hash",
    )


@query(
    "records_to_table",
    """SELECT CAST(o_orderkey AS VARCHAR) AS country_code, 'Order ' || o_orderkey AS country_name,
  CAST(year(o_orderdate) AS INTEGER) AS year,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice END AS gdp_per_capita_usd,
  'I1' AS indicator_id, 'world_bank_api' AS data_source, CAST(1704067200 AS BIGINT) AS ingested_s
FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'""",
)
def records_to_table(spark, sf):
    path = fresh_folder(spark, "typed")
    raw = read_json_lines(spark, _write_raw_orders(spark, sf), schemas.RAW_RECORD)
    overwrite_partitions(type_records(raw), path)
    return read_table(spark, path, schemas.PROCESSED_GDP).select(
        "country_code", "country_name", "year", "gdp_per_capita_usd", "indicator_id", "data_source",
        F.unix_seconds("ingestion_ts").alias("ingested_s"),
    )


def nation_pages(spark, sf, values=None):
    """One page per nation, its table holding one column per year; and the years by header."""
    long = settle(env(spark, sf) if values is None else values)
    years = [row["year"] for row in distinct_years(long).collect()]
    columns = {f"y{year}": year for year in years}
    wide = long_to_wide(long, ["country_code"], columns, value="co2_tons_per_capita")
    names = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("country_code"), "n_name")
    cells = [F.concat(F.lit("<td>"), F.coalesce(F.format_number(c, 1), F.lit("–")), F.lit("</td>")) for c in columns]
    heads = "".join(f"<th>Value {year}</th>" for year in years)
    html = F.concat(
        F.lit(f'<table class="wikitable"><caption>CO2</caption><tr><th>Location</th>{heads}</tr>'),
        F.lit("<tr><td><a href='#'>"), F.lower("n_name"), F.lit("</a>[a]</td>"), *cells,
        F.lit("</tr><tr><td></td>" + "<td>7</td>" * len(years) + "</tr></table>"),
    )
    pages = names.join(wide, "country_code", "left").select(
        F.col("country_code").cast("bigint").alias("pageid"),
        F.concat(F.lit("https://example.org/wiki/"), "n_name").alias("url"),
        html.alias("html"),
        F.lit(1).cast("bigint").alias("revid"),
        F.lit("2024-01-01T00:00:00Z").alias("rev_timestamp"),
    )
    return pages, {f"Value {year}": year for year in years}


@query(
    "tables_to_long",
    f"""WITH {ECON_SQL}, {ENV_SQL}, names AS (SELECT DISTINCT country_code, country_name FROM econ)
SELECT replace(lower(n.country_name), '_', ' ') AS country_name_normalized, n.country_code, n.country_name,
  v.year, v.co2_tons_per_capita
FROM names n JOIN env v ON n.country_code = v.country_code""",
)
def tables_to_long(spark, sf):
    pages, headers = nation_pages(spark, sf)
    raw = page_tables(pages).select(
        F.lit("run-1").alias("ingestion_run_id"),
        F.lit("2024-01-01T00:00:00Z").alias("ingestion_ts"),
        F.lit("").alias("data_source"),
        F.struct(F.col("url").alias("page_url"), "headers", "rows").alias("raw_table_json"),
    )
    mapping = settle(build_mapping(econ(spark, sf), default_overrides(spark)))
    long = type_table_rows(raw, mapping, values=headers)
    return long.select("country_name_normalized", "country_code", "country_name", "year", "co2_tons_per_capita")


@query(
    "mapping_table",
    f"""WITH {ECON_SQL}, overrides(k, code, name) AS (VALUES {DEFAULT_OVERRIDE_ROWS})
SELECT DISTINCT replace(lower(country_name), '_', ' ') AS country_name_normalized, country_code, country_name,
  'world_bank' AS source_precedence FROM econ
UNION ALL SELECT k, code, name, 'override' FROM overrides""",
)
def mapping_table(spark, sf):
    path = fresh_folder(spark, "mapping")
    replace_table(build_mapping(econ(spark, sf), default_overrides(spark)), path)
    return read_mapping(spark, path)


@query("summary_report", summary_sql(CURATED_SQL, SUMMARY_YEARS, "printf('%s: %.3f', country_name, co2_per_1000usd_gdp)"))
def summary_report(spark, sf):
    path = fresh_folder(spark, "curated")
    write_snapshot(nation_years(spark, sf), path, OLD)
    report = build_correlation_summary(spark, path, fresh_folder(spark, "analytics"), SUMMARY_YEARS)
    columns = (
        "year int, pearson_correlation_gdp_co2 double, top5_countries_highest_co2_per_1000usd_gdp string, "
        "top5_countries_lowest_co2_per_1000usd_gdp string"
    )
    stored = spark.read.schema(columns).option("header", True).csv(report)
    return stored.withColumn("pearson_correlation_gdp_co2", F.round("pearson_correlation_gdp_co2", 6)).fillna("")


def _landed_envelopes(spark, sf, rows=None):
    landed = fresh_folder(spark, "landed")
    record = F.struct(
        F.struct(F.lit("I1").alias("id"), F.lit("GDP").alias("value")).alias("indicator"),
        F.struct(F.lit("C").alias("id"), F.col("country_name").alias("value")).alias("country"),
        F.col("country_code").alias("countryiso3code"),
        F.col("year").cast("string").alias("date"),
        F.col("gdp_per_capita_usd").alias("value"),
    )
    body = F.concat(F.lit('[{"page":1},'), F.to_json(F.array(record)), F.lit("]"))
    # Compressed files can't be split by who reads them, so none is long.
    pages = (econ(spark, sf) if rows is None else rows).select(body.alias("value"))
    pages.write.options(compression="gzip", maxRecordsPerFile=RAW_FILE_ROWS).text(landed)
    return read_envelopes(spark, landed, per_line=True)


@query(
    "layered_run",
    f"""WITH {ECON_SQL}, {ENV_SQL}
SELECT e.country_code, e.country_name, e.year, e.gdp_per_capita_usd, v.co2_tons_per_capita
FROM econ e JOIN env v ON e.country_code = v.country_code AND e.year = v.year""",
)
def layered_run(spark, sf):
    """All layers over landed files: API pages of the GDP side and HTML pages of the CO2 side."""
    root = fresh_folder(spark, "layers")
    pages, headers = nation_pages(spark, sf)
    run_layers(
        spark, _landed_envelopes(spark, sf), pages, root, skip_empty_fit=True, page_values=headers,
        now=datetime(2024, 1, 1, tzinfo=timezone.utc),
    )
    curated = read_curated(spark, f"{root}/curated/country_year")
    return curated.select("country_code", "country_name", "year", "gdp_per_capita_usd", "co2_tons_per_capita")


@query(
    "layered_rerun",
    f"""WITH {ECON_SQL}, {ENV_SQL}
SELECT v.country_code, v.year, CASE WHEN CAST(v.country_code AS INTEGER) % 5 = 0 THEN v.co2_tons_per_capita + 1
  ELSE v.co2_tons_per_capita END AS co2_tons_per_capita
FROM env v JOIN econ e ON e.country_code = v.country_code AND e.year = v.year
WHERE NOT (CAST(v.country_code AS INTEGER) % 5 = 0 AND v.year > 1998)""",
)
def layered_rerun(spark, sf):
    """A second run in which each fifth page is revised and has lost its years after 1998."""
    root, envelopes = fresh_folder(spark, "layers"), _landed_envelopes(spark, sf)
    long = settle(env(spark, sf))
    pages, headers = nation_pages(spark, sf, long)
    fifth = F.col("country_code").cast("int") % 5 == 0
    revised = long.where(~fifth | (F.col("year") <= 1998)).withColumn(
        "co2_tons_per_capita", F.col("co2_tons_per_capita") + F.when(fifth, 1).otherwise(0)
    )
    newer, _ = nation_pages(spark, sf, revised)
    later = newer.withColumn("revid", F.when(F.col("pageid") % 5 == 0, F.lit(2)).otherwise(F.col("revid")).cast("bigint"))
    for day, frame in ((1, pages), (2, later)):
        run_layers(
            spark, envelopes, frame, root, skip_empty_fit=True, page_values=headers,
            now=datetime(2024, 1, day, tzinfo=timezone.utc),
        )
    # What is typed now; older snapshots of the curated table keep what they had.
    stored = read_table(spark, f"{root}/processed/co2", schemas.PROCESSED_CO2)
    return stored.select("country_code", "year", "co2_tons_per_capita")


@query(
    "layered_late_mapping",
    f"""WITH {ECON_SQL}, {ENV_SQL}
SELECT e.country_code, e.country_name, v.year, v.co2_tons_per_capita, e.gdp_per_capita_usd
FROM econ e JOIN env v ON e.country_code = v.country_code AND e.year = v.year""",
)
def layered_late_mapping(spark, sf):
    """Pages are typed in a first run, in which the API lacks every third nation; the second run brings these and no new page."""
    root, rows = fresh_folder(spark, "layers"), settle(econ(spark, sf))
    pages, headers = nation_pages(spark, sf)
    early = rows.where(F.col("country_code").cast("int") % 3 != 0)
    for day, known in ((1, early), (2, rows)):
        run_layers(
            spark, _landed_envelopes(spark, sf, known), pages, root, skip_empty_fit=True, page_values=headers,
            now=datetime(2024, 1, day, tzinfo=timezone.utc),
        )
    curated = read_curated(spark, f"{root}/curated/country_year")
    return curated.select("country_code", "country_name", "year", "co2_tons_per_capita", "gdp_per_capita_usd")


@query(
    "late_revision_load",
    """SELECT CAST(o_orderkey AS VARCHAR) AS country_code, CAST(year(o_orderdate) AS INTEGER) AS year,
  CASE WHEN o_orderkey % 10 = 0 AND year(o_orderdate) < 1998 THEN o_totalprice + 1 ELSE o_totalprice END AS value,
  CASE WHEN o_orderkey % 10 = 0 AND year(o_orderdate) < 1998 THEN 2 ELSE 1 END AS day
FROM orders""",
)
def late_revision_load(spark, sf):
    """Three loads of the same API: as it was, with some records of old years revised, and as before."""
    root, orders = fresh_folder(spark, "ingest"), table(spark, sf, "orders")
    ledger, seen = RunLedger(spark, f"{root}/metadata"), SeenKeys(spark, f"{root}/seen")
    late = (F.col("o_orderkey") % 10 == 0) & (F.year("o_orderdate") < 1998)
    for day, revised in ((1, False), (2, True), (3, True)):
        price = F.col("o_totalprice") + F.when(late, 1).otherwise(0) if revised else F.col("o_totalprice")
        rows = orders.select(
            F.col("o_orderkey").cast("string").alias("country_code"), F.lit("Order").alias("country_name"),
            F.year("o_orderdate").alias("year"), price.alias("gdp_per_capita_usd"),
        )
        now = datetime(2024, 1, day, tzinfo=timezone.utc)
        ingest_records(_landed_envelopes(spark, sf, rows), f"{root}/raw", ledger, seen=seen, now=now)
        process_records(spark, f"{root}/raw", f"{root}/typed", f"{root}/state")
    return read_table(spark, f"{root}/typed", schemas.PROCESSED_GDP).select(
        "country_code", "year", F.col("gdp_per_capita_usd").alias("value"), F.dayofmonth("ingestion_ts").alias("day")
    )


def _ingested_pages(spark, sf) -> tuple[str, RunLedger]:
    """Pages without a table where the nation's key is odd."""
    root = fresh_folder(spark, "pages")
    pages, _ = nation_pages(spark, sf)
    broken = pages.withColumn("html", F.when(F.col("pageid") % 2 == 1, F.lit("<p>moved</p>")).otherwise(F.col("html")))
    ledger = RunLedger(spark, f"{root}/metadata")
    ingest_pages(broken, f"{root}/raw", ledger, rejects=f"{root}/rejects")
    return root, ledger


@query(
    "page_rejects",
    """SELECT 'https://example.org/wiki/' || n_name AS url, CAST(1 AS BIGINT) AS revid,
  'no table with a header and rows' AS reason FROM nation WHERE n_nationkey % 2 = 1""",
)
def page_rejects(spark, sf):
    root, _ = _ingested_pages(spark, sf)
    return spark.read.parquet(f"{root}/rejects").select("url", "revid", "reason")


@query(
    "page_marks",
    "SELECT 'https://example.org/wiki/' || n_name AS url, '1' AS value FROM nation WHERE n_nationkey % 2 = 0",
)
def page_marks(spark, sf):
    _, ledger = _ingested_pages(spark, sf)
    return ledger.checkpoints().select(F.regexp_replace("source", "^[^:]*:", "").alias("url"), "value")


_REPORT_YEAR = 1998


@query(
    "regression_report",
    f"""WITH {CURATED_SQL}, one AS (SELECT * FROM curated WHERE year = {_REPORT_YEAR}), fit AS (
  SELECT regr_slope(co2_tons_per_capita, gdp_per_capita_usd) AS slope, regr_intercept(co2_tons_per_capita, gdp_per_capita_usd) AS intercept,
    corr(co2_tons_per_capita, gdp_per_capita_usd) AS r, count(*) AS n, min(gdp_per_capita_usd) AS lo, max(gdp_per_capita_usd) AS hi FROM one)
SELECT 'fit' AS part, 'line' AS label, round(slope, 8) AS a, round(intercept, 4) AS b, round(r * r, 6) AS c FROM fit
UNION ALL SELECT 'points', country_code, round(gdp_per_capita_usd, 4), round(co2_tons_per_capita, 4),
  round(co2_tons_per_capita - slope * gdp_per_capita_usd - intercept, 4) FROM one, fit
UNION ALL SELECT 'line', CAST(i AS VARCHAR), round(x, 4), round(slope * x + intercept, 4), NULL FROM (
  SELECT i, slope, intercept, CASE WHEN i = 199 THEN hi ELSE lo + i * ((hi - lo) / 199) END AS x FROM fit, range(200) t(i))""",
)
def regression_report(spark, sf):
    """The stored regression of one year, all three tables read back."""
    path = fresh_folder(spark, "curated")
    write_snapshot(nation_years(spark, sf), path, OLD)
    paths = build_regression(spark, path, fresh_folder(spark, "analytics"), _REPORT_YEAR)
    part = lambda name, label, a, b, c: spark.read.parquet(paths[name]).select(
        F.lit(name).alias("part"), label.alias("label"), a.alias("a"), b.alias("b"), c.alias("c")
    )
    nothing = F.lit(None).cast("double")
    fit = part("fit", F.lit("line"), F.round("slope", 8), F.round("intercept", 4), F.round("r2", 6))
    points = part("points", F.col("country_code"), F.round("x", 4), F.round("y", 4), F.round("residual", 4))
    line = part("line", F.col("i").cast("string"), F.round("x_line", 4), F.round("y_line", 4), nothing)
    return union_all([fit, points, line])


@query(
    "override_file",
    "SELECT lower(n_name) AS country_name_normalized, 'N' || n_nationkey AS country_code, n_name || ', the land' AS country_name FROM nation",
)
def override_file(spark, sf):
    """The override file as it is on disk: a header, and names with commas that need no quotes."""
    path = fresh_folder(spark, "overrides")
    name = F.concat(F.col("n_name"), F.lit(", the land"))
    line = F.concat_ws(",", F.lower("n_name"), F.concat(F.lit("N"), F.col("n_nationkey")), F.when(F.col("n_nationkey") % 2 == 0, name).otherwise(F.concat(F.lit('"'), name, F.lit('"'))))
    header = spark.range(1).select(F.lit(",".join(schemas.OVERRIDES.fieldNames())).alias("value"))
    header.unionByName(table(spark, sf, "nation").select(line.alias("value"))).coalesce(1).write.text(path)
    return read_overrides(spark, path)
