import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflow import fresh_folder, schemas
from strataflow.operators import joins
from strataflow.operators.project import align
from strataflow.plans import analytics, curate, defaults, fits, ingest, mapping, processed
from strataflow.plans.full_run import run_layers
from strataflow.plans.ledger import RunLedger
from strataflow.sinks import tables as sinks
from strataflow.sinks.seen import SeenKeys, packed, unpacked
from strataflow.sinks.tables import overwrite_partitions, write_snapshot
from strataflow.sources import tables
from strataflow.sources.folders import child_files, partition_values
from strataflow.sources.landed import read_json_lines
from strataflow.sources.tables import read_curated, read_mapping, read_table
from strataflow.streaming import increments
from strataflow.streaming.increments import load_new_files

DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


def record(code, name, date, value, **more):
    return {
        "indicator": {"id": "I1", "value": "GDP"}, "country": {"id": code[:2], "value": name},
        "countryiso3code": code, "date": date, "value": value, **more,
    }


def envelopes(spark, *pages):
    bodies = [(json.dumps([{"page": i + 1, "pages": len(pages)}, list(page)]),) for i, page in enumerate(pages)]
    return spark.createDataFrame(bodies, "body string")


@pytest.fixture
def ledger(spark):
    return RunLedger(spark, fresh_folder(spark, "ledger"))


def runs(ledger, scope=None):
    return [
        (r["run_scope"], r["status"], r["rows_processed"], r["last_checkpoint"])
        for r in ledger.list_runs(scope).orderBy("start_ts").collect()
    ]


def test_typed_records(spark):
    lines = [
        record("AAA", "Alpha", "2000", 1000.5), record("AAA", "Alpha", "2023", None), record("", "No code", "2000", 5),
        record("BBB", "Beta", "20x0", 5), record("CCC", "Côte Gamma", "2023", "bad"), record("DDD", None, "2000", 1),
    ]
    raw = spark.read.schema(schemas.RAW_RECORD).json(spark.sparkContext.parallelize([json.dumps(x) for x in lines]))
    typed = processed.type_records(raw)
    assert typed.dtypes == align(typed, schemas.PROCESSED_GDP).dtypes and typed.columns == schemas.PROCESSED_GDP.fieldNames()
    rows = sorted((r["country_code"], r["year"], r["gdp_per_capita_usd"], r["data_source"]) for r in typed.collect())
    assert [r[:3] for r in rows] == [("AAA", 2000, 1000.5), ("AAA", 2023, None), ("CCC", 2023, None)]
    assert {r[3] for r in rows} == {"world_bank_api"}


def test_long_table(spark):
    late, early = "Emissions per capita (tons per year)", "% change from 2000"
    table = [
        {"Location": "Alpha[a]", late: "1,234.5", early: "-"}, {"Location": "Béta", late: "N/A", early: "2"},
        {"Location": "", late: "1", early: "1"}, {"Location": None, late: "1"}, {late: "1"}, {"Location": "Gone", late: "abc"},
    ]
    raw = spark.read.schema(schemas.RAW_TABLE).json(
        spark.sparkContext.parallelize([json.dumps({"ingestion_run_id": "r", "raw_table_json": {"rows": table}})])
    )
    names = spark.createDataFrame([("beta", "BET", "Beta Land", "override")], schemas.MAPPING)
    long = processed.type_table_rows(raw, names)
    assert long.columns == schemas.PROCESSED_CO2.fieldNames()
    rows = sorted(tuple(r)[:5] for r in long.collect())
    assert rows == [("Alpha[a]", "alpha a", None, 2023, 1234.5), ("Beta Land", "beta", "BET", 2000, 2.0)]


def test_mapping(spark):
    rows = [
        ("AAA", "Alpha", datetime(2024, 1, 1)), ("AAX", "alpha!", datetime(2024, 2, 1)), ("BHS", "The Bahamas", None),
        (None, "x", None), ("X", None, None),
    ]
    table = spark.createDataFrame(rows, "country_code string, country_name string, ingestion_ts timestamp")
    built = mapping.build_mapping(table, mapping.default_overrides(spark))
    found = {r["country_name_normalized"]: tuple(r)[1:] for r in built.collect()}
    assert found["alpha"] == ("AAX", "alpha!", "world_bank")
    assert found["the bahamas"] == ("BHS", "The Bahamas", "world_bank")
    assert found["bahamas"] == ("BHS", "Bahamas, The", "override")
    assert found["hong kong"] == ("HKG", "Hong Kong SAR, China", "override")
    assert len(found) == 34


def test_curated_rules(spark):
    gdp = spark.createDataFrame(
        [("A", "a", 2000, 100.0), ("B", "b", 2000, None), ("C", "c", 2000, 0.0), ("D", "d", 2000, -5.0),
         ("E", "e", 2000, 1.0), ("F", "f", 2000, 1.0), (None, "g", 2000, 1.0), ("A", "a", None, 1.0)],
        "country_code string, country_name string, year int, gdp_per_capita_usd double",
    )
    co2 = spark.createDataFrame(
        [("A", 2000, 5.0), ("A", 2000, 6.0), ("B", 2000, 1.0), ("C", 2000, 1.0), ("D", 2000, 1.0), ("E", 2000, None), ("Z", 2000, 1.0)],
        "country_code string, year int, co2_tons_per_capita double",
    )
    rows = curate.curate(gdp, co2, run_id="r", snapshot_ts=DAY)
    assert rows.columns == schemas.CURATED_ROW.fieldNames()
    found = {r["country_code"]: r for r in rows.collect()}
    assert sorted(found) == ["A", "B", "C", "D"]
    assert found["A"]["co2_per_1000usd_gdp"] == 50.0
    assert [found[c]["co2_per_1000usd_gdp"] for c in "BCD"] == [None, None, None]
    assert found["B"]["first_ingestion_run_id"] == found["B"]["last_update_run_id"] == "r"


def test_latest_ingested_duplicate_wins(spark):
    rows = [("A", 2000, 1.0, datetime(2024, 1, 1)), ("A", 2000, 9.0, datetime(2024, 3, 1)), ("A", 2000, 0.5, None)]
    table = spark.createDataFrame(rows, "country_code string, year int, co2_tons_per_capita double, ingestion_ts timestamp")
    columns = ["country_code", "year", "co2_tons_per_capita"]
    assert [tuple(r) for r in curate.unique_facts(table, columns, columns[2]).collect()] == [("A", 2000, 9.0)]


@pytest.mark.parametrize(
    "checkpoint, min_year, expected",
    [(None, None, None), (None, 2000, 1999), ("2010", None, 2010), ("2010", 2000, 2010), ("2010", 2015, 2014), ("x", None, None), ("", 1990, 1989)],
)
def test_baseline_year(checkpoint, min_year, expected):
    assert ingest.baseline_year(checkpoint, min_year) == expected


def test_record_loads_are_incremental(spark, ledger):
    root = fresh_folder(spark, "raw")
    first = envelopes(spark, [record("AAA", "Alpha", "1999", 1), record("AAA", "Alpha", "2000", None)], [record("BBB", "Beta", "x", 1)])
    one = ingest.ingest_records(first, root, ledger)
    two = ingest.ingest_records(first, root, ledger)
    later = envelopes(spark, [record("AAA", "Alpha", "2000", 7), record("AAA", "Alpha", "2001", 8), record("AAA", "Alpha", "2005", 9)])
    three = ingest.ingest_records(later, root, ledger, max_year=2004)
    assert [w.rows for w in (one, two, three)] == [2, 0, 1]
    assert runs(ledger) == [("world_bank_api", "SUCCESS", n, c) for n, c in ((2, "2000"), (0, "2000"), (1, "2001"))]
    raw = read_json_lines(spark, root, schemas.RAW_RECORD)
    assert raw.count() == 3 and raw.where("raw_payload is null or length(record_hash) <> 40").count() == 0
    assert {r[0] for r in raw.select("raw_file_path").distinct().collect()} == {one.path, three.path}


def test_failed_load_is_recorded_and_raised(spark, ledger):
    bad = spark.createDataFrame([("{}",)], "body string")
    with pytest.raises(Exception, match="unexpected page structure"):
        ingest.ingest_records(bad, fresh_folder(spark, "raw"), ledger)
    last = ledger.last_run().first()
    assert last["status"] == "FAILED" and "unexpected page structure" in last["error_message"]
    assert ledger.load_checkpoint(defaults.RECORD_CHECKPOINT) is None


PAGE = (
    '<table class="wikitable"><caption>CO2 emissions</caption>'
    "<tr><th>Location</th><th>Emissions per capita (tons per year)</th><th>% change from 2000</th><th></th></tr>{}</table>"
)


def co2_page(spark, rows, revid, url="https://e.org/wiki/X"):
    body = "".join(f"<tr><td>{n}</td><td>{late}</td><td>{early}</td></tr>" for n, late, early in rows)
    return spark.createDataFrame(
        [(url, PAGE.format(body), 1, revid, "2024-01-01T00:00:00Z")],
        "url string, html string, pageid bigint, revid bigint, rev_timestamp string",
    )


def test_unchanged_page_is_skipped(spark, ledger):
    root = fresh_folder(spark, "raw")
    page = co2_page(spark, [("Alpha", "1", "2")], 10)
    assert ingest.ingest_pages(page, root, ledger).rows == 1
    assert ingest.ingest_pages(page, root, ledger) is None
    assert ingest.ingest_pages(co2_page(spark, [("Alpha", "1", "2"), ("B", "1", "1")], 11), root, ledger).rows == 1
    assert ingest.ingest_pages(co2_page(spark, [("Alpha", "1", "2")], None), root, ledger).rows == 1
    assert [r[1:] for r in runs(ledger)] == [("SUCCESS", 1, "10"), ("SKIPPED", 0, "10"), ("SUCCESS", 2, "11"), ("SUCCESS", 1, None)]
    hashes = [r[0] for r in read_json_lines(spark, root, schemas.RAW_TABLE).select("record_hash").collect()]
    assert len(hashes) == 3 and len(set(hashes)) == 2


def test_ledger(spark, ledger):
    assert ledger.last_run().count() == 0 and ledger.load_checkpoint("s", "dflt") == "dflt"
    one, two = ledger.start_run("a"), ledger.start_run("b")
    ledger.end_run(one, rows_processed=5, last_checkpoint=7)
    assert runs(ledger) == [("a", "SUCCESS", 5, "7"), ("b", "RUNNING", None, None)]
    assert runs(ledger, "b") == [("b", "RUNNING", None, None)]
    assert ledger.last_run().first()["ingestion_run_id"] == two
    assert ledger.last_run("a").first()["ingestion_run_id"] == one
    assert ledger.load_checkpoint("a") is None  # ending a run saves no checkpoint
    with pytest.raises(KeyError):
        ledger.end_run("nobody")
    ledger.save_checkpoint("s", 1)
    ledger.save_checkpoint("s", 2)
    ledger.save_checkpoint("t", "x")
    assert sorted((r["source"], r["value"]) for r in ledger.checkpoints().collect()) == [("s", "2"), ("t", "x")]
    row = ledger.list_runs("a").first()
    assert row["end_ts"] >= row["start_ts"] and row["error_message"] is None


@pytest.fixture
def curated_path(spark):
    path = fresh_folder(spark, "curated")
    gdp = spark.createDataFrame(
        [(f"C{i}", f"n{i}", y, float(i * i + 1)) for i in range(8) for y in (2000, 2023)],
        "country_code string, country_name string, year int, gdp_per_capita_usd double",
    )
    co2 = spark.createDataFrame(
        [(f"C{i}", y, float(3 * i + (i % 3))) for i in range(8) for y in (2000, 2023)],
        "country_code string, year int, co2_tons_per_capita double",
    )
    write_snapshot(curate.curate(gdp, co2, run_id="r", snapshot_ts=DAY), path, "20240101")
    return path


def test_summary_report(spark, curated_path):
    out = fresh_folder(spark, "analytics")
    report = analytics.build_correlation_summary(spark, curated_path, out, [2023, 2000, 1990], DAY)
    lines = [r[0] for r in spark.read.text(report).collect()]
    assert lines[0] == f"year,pearson_correlation_gdp_co2,{analytics.HIGHEST},{analytics.LOWEST}"
    assert [line.split(",")[0] for line in lines[1:]] == ["1990", "2000", "2023"]
    assert lines[1].split(",")[1] == ""
    assert lines[2].split(",")[2].split(";")[0] == "n1: 2000.000" and lines[2].split(",")[3].split(";")[0] == "n0: 0.000"
    empty = analytics.build_correlation_summary(spark, curated_path, out, [1990], DAY)
    assert [r[0] for r in spark.read.text(empty).collect()] == lines[:1]


def test_regression_tables(spark, curated_path):
    paths = analytics.build_regression(spark, curated_path, fresh_folder(spark, "analytics"), 2023, outliers=3, now=DAY)
    fit = spark.read.parquet(paths["fit"]).collect()
    assert len(fit) == 1 and fit[0]["n"] == 8
    points = spark.read.parquet(paths["points"])
    assert points.count() == 8 and points.where("outlier_rank is not null").count() == 3
    worst = points.orderBy(F.abs("residual").desc()).first()
    assert worst["outlier_rank"] == 1
    line = spark.read.parquet(paths["line"])
    assert line.count() == 200 and line.agg(F.max("x_line")).first()[0] == fit[0]["x_max"]
    with pytest.raises(RuntimeError, match="year=1990"):
        analytics.build_regression(spark, curated_path, fresh_folder(spark, "analytics"), 1990)


def test_all_layers_twice(spark):
    root = fresh_folder(spark, "layers")
    api = envelopes(spark, [record(c, n, y, v) for c, n, v in (("AAA", "Alpha", 100), ("BHS", "Bahamas, The", 200), ("CCC", "Côte", None)) for y in ("2000", "2023")])
    pages = co2_page(spark, [("Alpha", "1.5", "2"), ("Bahamas [a]", "4", "–"), ("COTE", "7", "x"), ("Nowhere", "1", "1")], 10)
    first = run_layers(spark, api, pages, root, now=DAY)
    assert first.rows["records_raw"] == 6 and first.rows["tables_processed"] == 6 and first.rows["curated"] == 4
    rows = {(r["country_code"], r["year"]): r for r in read_curated(spark, first.paths["curated"]).collect()}
    assert sorted(rows) == [("AAA", 2000), ("AAA", 2023), ("BHS", 2023), ("CCC", 2023)]
    assert rows["AAA", 2023]["co2_per_1000usd_gdp"] == 15.0 and rows["CCC", 2023]["co2_per_1000usd_gdp"] is None
    assert read_mapping(spark, first.paths["mapping"]).count() == 35
    again = run_layers(spark, api, pages, root, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    assert again.rows["records_raw"] == 0 and again.paths["tables_raw"] is None and again.rows["curated"] == 4
    snapshots = read_curated(spark, again.paths["curated"], latest_only=False)
    assert sorted(r[0] for r in snapshots.select("snapshot_date").distinct().collect()) == ["20240101", "20240102"]
    ledger = RunLedger(spark, f"{root}/metadata")
    assert [r[:2] for r in runs(ledger)] == [
        ("world_bank_api", "SUCCESS"), ("wikipedia_co2", "SUCCESS"), ("curated_join", "SUCCESS"),
        ("world_bank_api", "SUCCESS"), ("wikipedia_co2", "SKIPPED"), ("curated_join", "SUCCESS"),
    ]


def test_run_without_overlap(spark):
    api = envelopes(spark, [record("AAA", "Alpha", "2000", 1)])
    pages = co2_page(spark, [("Elsewhere", "1", "1")], 1)
    root = fresh_folder(spark, "layers")
    with pytest.raises(RuntimeError, match="no curated data"):
        run_layers(spark, api, pages, root, now=DAY)
    done = run_layers(spark, api, pages, root, skip_empty_fit=True, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    assert "fit" not in done.paths and len(spark.read.text(done.paths["summary"]).collect()) == 1


def test_each_file_is_streamed_once(spark):
    root = fresh_folder(spark, "stream")
    source, target, state = f"{root}/in", f"{root}/out", f"{root}/state"

    def land(*records):
        spark.createDataFrame([(json.dumps(r),) for r in records], "value string").coalesce(1).write.mode("append").text(source)

    def load(**options):
        load_new_files(spark, source, schemas.RAW_RECORD, target, state, processed.type_records, **options)
        table = read_table(spark, target, schemas.PROCESSED_GDP)
        return sorted((r["country_code"], r["year"], r["gdp_per_capita_usd"]) for r in table.collect())

    land(record("AAA", "Alpha", "2000", 1), record("AAA", "Alpha", "2001", 2))
    assert load(replace=True) == [("AAA", 2000, 1.0), ("AAA", 2001, 2.0)]
    assert load(replace=True) == [("AAA", 2000, 1.0), ("AAA", 2001, 2.0)]
    land(record("BBB", "Beta", "2001", 3))
    assert load(replace=True) == [("AAA", 2000, 1.0), ("BBB", 2001, 3.0)]
    land(record("CCC", "C", "2001", 4, ingestion_ts="2024-01-02"), record("BBB", "Beta", "2001", 5, ingestion_ts="2024-01-02"))
    merged = load(merge_on=["country_code", "year"], latest_by=["ingestion_ts"])
    assert merged == [("AAA", 2000, 1.0), ("BBB", 2001, 5.0), ("CCC", 2001, 4.0)]


def several_pages(spark, tables, revisions):
    """One page per name: its rows of (location, late, early)."""
    frames = [
        co2_page(spark, rows, revisions[name]).withColumns({"url": F.lit(f"https://example.org/{name}")})
        for name, rows in tables.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def page_rows(spark, root):
    table = read_table(spark, f"{root}/processed/co2", schemas.PROCESSED_CO2)
    return sorted((r["page_url"][-1], r["country_name"], r["year"], r["co2_tons_per_capita"]) for r in table.collect())


def test_second_run_keeps_other_pages(spark):
    """A revised page replaces its own rows, also those it no longer has; other pages stay."""
    root = fresh_folder(spark, "layers")
    api = envelopes(spark, [record("AAA", "Alpha", y, 100) for y in ("2000", "2023")])
    old = {"a": [("Aland", "1", "2"), ("Bland", "3", "4")], "b": [("Cland", "5", "6"), ("Dland", "7", "8")]}
    run_layers(spark, api, several_pages(spark, old, {"a": 1, "b": 1}), root, skip_empty_fit=True, now=DAY)
    assert len(page_rows(spark, root)) == 8
    new = {"a": old["a"], "b": [("Cland", "9", "–")]}
    run_layers(spark, api, several_pages(spark, new, {"a": 1, "b": 2}), root, skip_empty_fit=True, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    assert page_rows(spark, root) == [
        ("a", "Aland", 2000, 2.0), ("a", "Aland", 2023, 1.0), ("a", "Bland", 2000, 4.0), ("a", "Bland", 2023, 3.0), ("b", "Cland", 2023, 9.0),
    ]


def test_a_year_left_by_all_pages_is_emptied(spark):
    root = fresh_folder(spark, "layers")
    api = envelopes(spark, [record("AAA", "Alpha", "2000", 100)])
    run_layers(spark, api, several_pages(spark, {"a": [("Aland", "1", "2")]}, {"a": 1}), root, skip_empty_fit=True, now=DAY)
    run_layers(spark, api, several_pages(spark, {"a": [("Aland", "5", "–")]}, {"a": 2}), root, skip_empty_fit=True, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    assert page_rows(spark, root) == [("a", "Aland", 2023, 5.0)]


def test_records_are_typed_after_a_failed_step(spark, monkeypatch):
    root = fresh_folder(spark, "layers")
    api = envelopes(spark, [record("AAA", "Alpha", y, 100) for y in ("2000", "2023")])
    pages = co2_page(spark, [("Alpha", "1.5", "2")], 10)
    whole = processed.type_records

    def failing(raw):
        raise RuntimeError("typing failed")

    monkeypatch.setattr(processed, "type_records", failing)
    with pytest.raises(Exception, match="typing failed"):
        run_layers(spark, api, pages, root, now=DAY)
    monkeypatch.setattr(processed, "type_records", whole)
    done = run_layers(spark, api, pages, root, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    assert done.rows["records_raw"] == 0 and done.rows["records_processed"] == 2 and done.rows["curated"] == 2


def test_marks_only_of_written_pages(spark):
    root = fresh_folder(spark, "pages")
    ledger = RunLedger(spark, f"{root}/metadata")
    good = several_pages(spark, {"a": [("Aland", "1", "2")]}, {"a": 1})
    bad = good.withColumns({"url": F.lit("https://example.org/bad"), "html": F.lit("<p>no table</p>")})
    both = good.unionByName(bad)
    assert ingest.ingest_pages(both, f"{root}/raw", ledger, rejects=f"{root}/rejects", now=DAY).rows == 1
    assert [r["source"][-3:] for r in ledger.checkpoints().collect()] == ["g/a"]
    assert [(r["url"][-3:], r["revid"]) for r in spark.read.parquet(f"{root}/rejects").collect()] == [("bad", 1)]
    # The bad page is tried again, and alone it fails a strict load.
    with pytest.raises(ValueError, match="no changed page"):
        ingest.ingest_pages(both, f"{root}/raw", ledger, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    fixed = bad.withColumn("html", F.lit(good.first()["html"]))
    assert ingest.ingest_pages(good.unionByName(fixed), f"{root}/raw", ledger, now=datetime(2024, 1, 3, tzinfo=timezone.utc)).rows == 1


def test_merge_moves_keys_and_keeps_null_partitions(spark):
    path = fresh_folder(spark, "merge")
    schema = "id string, v int, year int, region string"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    parts = ["year", "region"]
    overwrite_partitions(frame([("a", 1, 2000, None), ("b", 1, 2000, "n"), ("y", 1, 2001, None), ("z", 1, 2002, "n")]), path, parts)
    for limit in (500, 0):
        batch = frame([("c", 2, 2000, None), ("z", 2, 2001, None)])
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(tables, "MAX_LITERAL_PARTITIONS", limit)
            rows, touched = increments.merge_partitions(batch, path, ["id"], ["v"], parts)
            assert sorted((r["id"], r["v"], r["year"]) for r in rows.collect()) == [("a", 1, 2000), ("c", 2, 2000), ("y", 1, 2001), ("z", 2, 2001)]
            assert touched.count() == 3
    increments.write_touched(rows, touched, path, parts)
    stored = read_table(spark, path, spark.createDataFrame([], schema).schema)
    assert sorted((r["id"], r["v"], r["year"], r["region"]) for r in stored.collect()) == [
        ("a", 1, 2000, None), ("b", 1, 2000, "n"), ("c", 2, 2000, None), ("y", 1, 2001, None), ("z", 2, 2001, None),
    ]


def test_files_of_one_partition_in_several_batches(spark):
    root = fresh_folder(spark, "stream")
    for i in range(3):
        row = record(f"A{i}", f"Alpha {i}", "2000", i)
        spark.createDataFrame([(json.dumps(row),)], "value string").coalesce(1).write.mode("append").text(f"{root}/in")
    args = (spark, f"{root}/in", schemas.RAW_RECORD, f"{root}/out", f"{root}/state", processed.type_records)
    with pytest.raises(ValueError, match="max_files"):
        load_new_files(*args, max_files=1, replace=True)
    with pytest.raises(ValueError, match="one of"):
        load_new_files(*args, replace=True, owner="page_url")
    with pytest.raises(Exception, match="source_file"):
        load_new_files(*args[:4], f"{root}/other", processed.type_records)
    assert load_new_files(*args, max_files=1, merge_on=["country_code", "year"], latest_by=["ingestion_ts"]).rows == 3
    assert read_table(spark, f"{root}/out", schemas.PROCESSED_GDP).count() == 3


def test_old_snapshots_are_not_opened(spark):
    path = fresh_folder(spark, "curated")
    rows = spark.createDataFrame([("AAA", "Alpha", 2000, 1.0)], "country_code string, country_name string, year int, gdp_per_capita_usd double")
    write_snapshot(rows, path, "20240101")
    write_snapshot(rows, path, "20240201")
    import glob

    for file in glob.glob(f"{path.removeprefix('file:')}/year=2000/snapshot_date=20240101/*.parquet"):
        with open(file, "wb") as broken:
            broken.write(b"this is no data file")
    got = tables.read_curated(spark, path).collect()
    assert [(r["country_code"], r["snapshot_date"]) for r in got] == [("AAA", "20240201")]


def test_rows_with_nested_maps_are_deduplicated(spark):
    row = {"page_url": "u", "raw_table_json": {"page_url": "u", "headers": ["x"], "rows": [{"b": "1", "a": "2"}]}, "revid": 1}
    raw = spark.createDataFrame([row, row | {"revid": 2}, row], schemas.RAW_TABLE)
    assert [r["revid"] for r in processed.latest_page(raw).collect()] == [2]
    names = spark.createDataFrame([("u", "label")], "page_url string, label string")
    assert joins.lookup_join(raw, names, ["page_url"], hot=[("u",)], pieces=3).where("label = 'label'").count() == 3


def stored_lines(spark, path):
    table = read_table(spark, path, StructType.fromDDL("v int, year int"))
    return sorted((r["v"], r["year"]) for r in table.collect())


def test_appended_files_are_neither_lost_nor_doubled(spark, monkeypatch):
    root = fresh_folder(spark, "append")
    schema = StructType.fromDDL("v int, year int")
    land = lambda *rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{root}/in")
    load = lambda state="state", **more: load_new_files(spark, f"{root}/in", schema, f"{root}/out", f"{root}/{state}", lambda df: df, **more).rows
    land((1, 2000), (2, 2000), (3, 2001))
    assert load() == 3
    land((4, 2000), (4, 2000), (5, None))
    assert load() == 2 and load() == 0
    whole = [(1, 2000), (2, 2000), (3, 2001), (4, 2000), (4, 2000)]
    assert stored_lines(spark, f"{root}/out") == whole
    # A batch that dies after its rows were written is repeated.
    land((6, 2001))
    written = increments.append_partitions

    def dying(*args):
        written(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(increments, "append_partitions", dying)
    with pytest.raises(Exception, match="lost"):
        load()
    monkeypatch.setattr(increments, "append_partitions", written)
    assert (6, 2001) in stored_lines(spark, f"{root}/out")
    assert load() == 1
    assert stored_lines(spark, f"{root}/out") == sorted([*whole, (6, 2001)])
    # All files again, one a batch: each replaces its own rows.
    assert load("another", max_files=1) == 6
    assert stored_lines(spark, f"{root}/out") == sorted([*whole, (6, 2001)])


def test_a_new_file_leaves_stored_files_alone(spark):
    root = fresh_folder(spark, "append")
    rows = lambda v: spark.createDataFrame([(v, 2000, f"file:/in/{v}")], "v int, year int, source_file string")
    for v in (1, 2):
        increments.append_files(rows(v), rows(v).select("source_file"), f"{root}/out")
        files = spark.read.parquet(f"{root}/out").inputFiles()
        assert len(files) == v
    increments.append_files(rows(2), rows(2).select("source_file"), f"{root}/out")
    assert stored_lines(spark, f"{root}/out") == [(1, 2000), (2, 2000)]


def test_emptied_partitions_of_any_type_go(spark):
    from datetime import date

    schema = "id int, v int, at timestamp, day date, name string"
    at = datetime(2024, 1, 1, 12, 30, 5, 250000)
    places = [(at, date(2024, 1, 1), "a:b"), (at, date(2024, 1, 2), "a/b%"), (None, None, ""), (at, None, "{x}='")]
    for parts in (["at", "day", "name"], ["name", "at"], ["day", "name", "at"]):
        path = fresh_folder(spark, "merge")
        named = [(i, 1, *p) for i, p in enumerate(places) if dict(zip(("at", "day", "name"), p))[parts[0]]]
        overwrite_partitions(spark.createDataFrame(named, schema), path, parts)
        batch = spark.createDataFrame([(r[0], 2, at.replace(year=2025), date(2025, 1, 1), "other") for r in named], schema)
        for _ in range(2):
            rows, touched = increments.merge_partitions(batch, path, ["id"], ["v"], parts)
            increments.write_touched(rows, touched, path, parts)
            stored = read_table(spark, path, StructType.fromDDL(schema)).collect()
            assert sorted((r["id"], r["v"], r["name"]) for r in stored) == [(r[0], 2, "other") for r in named]


def test_empty_text_is_the_null_partition(spark):
    path, schema = fresh_folder(spark, "merge"), "id int, v int, year int, side string"
    overwrite_partitions(spark.createDataFrame([(1, 1, 2000, None), (2, 1, 2000, "a")], schema), path, ["year", "side"])
    rows, touched = increments.merge_partitions(spark.createDataFrame([(3, 1, 2000, "")], schema), path, ["id"], ["v"], ["year", "side"])
    increments.write_touched(rows, touched, path, ["year", "side"])
    stored = read_table(spark, path, StructType.fromDDL(schema)).collect()
    assert sorted((r["id"], r["side"]) for r in stored) == [(1, None), (2, "a"), (3, None)]


def test_seen_keys_are_looked_up_by_folder(spark):
    seen = SeenKeys(spark, fresh_folder(spark, "seen"), buckets=64)
    frame = lambda rows: spark.createDataFrame(rows, "k string, v string")
    assert seen.changed(frame([("a", "1"), (None, "1")]), "k", "v").count() == 2
    seen.add(frame([(f"key{i}", "1") for i in range(500)]), "k", "v")
    before = set(seen._read(list(partition_values(spark, seen.path, "bucket").values())).inputFiles())
    seen.add(frame([("key7", "2"), ("new", None)]), "k", "v")
    after = set(seen._read(list(partition_values(spark, seen.path, "bucket").values())).inputFiles())
    # A run adds files and rewrites none; a lookup of two keys opens the files of two folders.
    assert before < after and len(after - before) <= 2
    asked = frame([("key7", "2"), ("key7", "1"), ("key8", "1"), ("new", None), ("none", "1"), (None, None)])
    near = seen.near(asked.where("k in ('key8', 'key7')"), "k")
    assert len({f.rsplit("/", 2)[1] for f in near.inputFiles()}) <= 2 and len(near.inputFiles()) <= 4
    changed = lambda: sorted((r["k"] or "", r["v"] or "") for r in seen.changed(asked, "k", "v").collect())
    wanted = [("", ""), ("key7", "1"), ("none", "1")]
    assert changed() == wanted
    assert sorted(r["key"] for r in seen.known(asked, "k").collect()) == ["key7", "key8", "new"]
    for i in range(3):
        seen.add(frame([("key7", "2")]), "k", "v")
    assert seen.compact(files=2) == 1 and seen.compact(files=2) == 0
    assert changed() == wanted


def co2_rows(spark, root):
    table = read_table(spark, f"{root}/processed/co2", schemas.PROCESSED_CO2)
    return {(r["country_name"], r["country_code"], r["year"]) for r in table.collect()}


def test_names_that_come_later_reach_typed_rows(spark, monkeypatch):
    root = fresh_folder(spark, "layers")
    first = envelopes(spark, [record("AAA", "Alpha", "2000", 100)])
    both = envelopes(spark, [record("AAA", "Alpha", "2000", 100), record("BBB", "Betaland", "2000", 5)])
    pages = co2_page(spark, [("ALPHA", "1", "2"), ("Beta-land", "3", "–"), ("betaland", "–", "4"), ("Nowhere", "1", "–")], 10)
    # A header's year 2023 comes first, then 2000.
    run_layers(spark, first, pages, root, skip_empty_fit=True, now=DAY)
    assert ("betaland", None, 2000) in co2_rows(spark, root)
    monkeypatch.setattr(processed, "overwrite_partitions", lambda *_: 1 / 0)
    day = lambda n: datetime(2024, 1, n, tzinfo=timezone.utc)
    with pytest.raises(ZeroDivisionError):
        run_layers(spark, both, pages, root, skip_empty_fit=True, now=day(2))
    monkeypatch.undo()
    # The run that died had the mapping written; the next one makes its rows up.
    done = run_layers(spark, both, pages, root, skip_empty_fit=True, now=day(3))
    assert done.rows["tables_remapped"] == 1
    rows = co2_rows(spark, root)
    assert rows == {
        ("Alpha", "AAA", 2000), ("Alpha", "AAA", 2023), ("Beta-land", None, 2023), ("Betaland", "BBB", 2000), ("Nowhere", None, 2023),
    }
    assert {r["country_code"] for r in read_curated(spark, f"{root}/curated/country_year").collect()} == {"AAA", "BBB"}
    again = run_layers(spark, both, pages, root, skip_empty_fit=True, now=day(4))
    assert again.rows["tables_remapped"] == 0 and co2_rows(spark, root) == rows


def test_only_years_of_changed_names_are_written(spark):
    root = fresh_folder(spark, "remap")
    rows = spark.createDataFrame(
        [("Aland", "aland", "AAA", 2000, 1.0), ("bland", "bland", None, 2001, 2.0), ("Aland", "aland", "AAA", 2001, 2.0), (None, "bland", None, 2001, 3.0)],
        "country_name string, country_name_normalized string, country_code string, year int, co2_tons_per_capita double",
    )
    overwrite_partitions(align(rows, schemas.PROCESSED_CO2), f"{root}/co2")
    files = lambda year: {f for f in spark.read.parquet(f"{root}/co2").inputFiles() if f"year={year}" in f}
    before = files(2000), files(2001)
    names = spark.createDataFrame([("aland", "AAA", "Aland", "w"), ("bland", "BBB", "Bland", "w"), (None, "X", "X", "w")], schemas.MAPPING)
    names.write.parquet(f"{root}/mapping")
    assert processed.remap_tables(spark, f"{root}/mapping", f"{root}/applied", f"{root}/co2").rows == 2
    assert files(2000) == before[0] and not files(2001) & before[1]
    stored = read_table(spark, f"{root}/co2", schemas.PROCESSED_CO2).collect()
    assert sorted((r["country_code"], r["country_name"], r["year"]) for r in stored) == [
        ("AAA", "Aland", 2000), ("AAA", "Aland", 2001), ("BBB", "Bland", 2001), ("BBB", "Bland", 2001),
    ]


def test_packed_text_is_one_to_one(spark):
    digests = [c * 40 for c in "09af"]
    texts = [None, "", "a", "10", "9", "é\U0001f600", "A" * 40, "g" * 40, "a" * 39, "a" * 41, "a" * 40 + "\n", *digests]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("packed", packed(F.col("text")))
    got = rows.withColumn("back", unpacked(F.col("packed"))).orderBy("i").collect()
    assert [r["back"] for r in got] == texts and len({bytes(r["packed"]) for r in got[1:]}) == len(texts) - 1
    assert [len(r["packed"]) for r in got[-4:]] == [21] * 4
    first = rows.where(F.col("text").isin(digests)).orderBy("packed").collect()
    assert [r["text"] for r in first] == digests


def test_a_load_stores_and_compares_few_bytes(spark, ledger, tmp_path):
    """A load writes a record's digests and text in little room, and the first one has nothing to compare."""
    seen, n = SeenKeys(spark, f"file:{tmp_path}/seen", buckets=4), 4000
    pages = envelopes(spark, [record(f"C{i}", f"Country {i}", "1999", i) for i in range(n)])
    assert ingest.ingest_records(pages, f"file:{tmp_path}/raw", ledger, seen=seen, now=DAY).rows == n
    size = lambda folder: sum(f.stat().st_size for f in (tmp_path / folder).rglob("part-*"))
    assert size("raw") < 120 * n and size("seen") < 60 * n
    keyed = spark.range(5).select(F.col("id").cast("string").alias("k"), F.lit("1").alias("v"))
    assert SeenKeys(spark, fresh_folder(spark, "none")).changed(keyed, "k", "v") is keyed
    joined = seen.changed(keyed, "k", "v")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 5 and "_packed" in plan


def test_raw_files_are_short(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sinks, "RAW_FILE_ROWS", 10)
    rows = spark.range(0, 35, 1, 1).select("id")
    assert sinks.write_raw(rows, f"file:{tmp_path}/raw").rows == 35
    assert len(list((tmp_path / "raw").glob("part-*"))) == 4
    assert sorted(r["id"] for r in spark.read.schema("id long").json(f"file:{tmp_path}/raw").collect()) == list(range(35))


def test_records_revised_late_and_set_back(spark, ledger):
    root = fresh_folder(spark, "ingest")
    seen = SeenKeys(spark, f"{root}/seen")

    def load(day, *records, **options):
        now = datetime(2024, 1, day, tzinfo=timezone.utc)
        return ingest.ingest_records(envelopes(spark, list(records)), f"{root}/raw", ledger, seen=seen, now=now, **options)

    old, new = record("AAA", "Alpha", "1999", 1), record("AAA", "Alpha", "2005", 2)
    assert load(1, old, new).rows == 2
    assert load(2, old, new).rows == 0
    changed = record("AAA", "Alpha", "1999", 7)
    assert load(3, changed, new).rows == 1
    # A value that comes back has changed again; the mark stays where it was.
    assert load(4, old, new).rows == 1
    assert ledger.load_checkpoint(defaults.RECORD_CHECKPOINT) == "2005"
    assert load(5, record("AAA", "Alpha", "1990", 1), min_year=1995).rows == 0
    assert load(6, record("AAA", "Alpha", "2020", 1), max_year=2010).rows == 0
    assert ledger.list_runs().count() == 6


def many_events(spark, runs):
    """Start and end of each run, and a checkpoint in between."""
    at = lambda minute: (F.lit(DAY) + F.make_interval(mins=F.lit(minute) + 3 * F.col("id"))).alias("event_ts")
    name = F.concat(F.lit("r"), F.col("id")).alias("ingestion_run_id")
    scope = F.concat(F.lit("s"), F.col("id") % 7).alias("run_scope")
    none = lambda kind, field: F.lit(None).cast(kind).alias(field)
    ids = spark.range(runs)
    started = ids.select(name, scope, at(0), F.lit("RUNNING").alias("status"), none("long", "rows_processed"), F.concat(F.lit("c"), F.col("id")).alias("last_checkpoint"), none("string", "error_message"))
    ended = ids.select(name, scope, at(1), F.when(F.col("id") % 9 == 0, "FAILED").otherwise("SUCCESS").alias("status"), F.col("id").alias("rows_processed"), none("string", "last_checkpoint"), F.when(F.col("id") % 9 == 0, "no").alias("error_message"))
    return started.unionByName(ended)


def test_compacted_ledger_opens_the_state_and_the_tail(spark):
    ledger = RunLedger(spark, fresh_folder(spark, "ledger"), compact_after=10**6)
    log = ledger.run_log
    events = many_events(spark, 5000).repartition(25).cache()
    log.append(events)
    before = sorted(map(tuple, ledger.list_runs().collect()))
    assert len(before) == 5000 and len(log.read().inputFiles()) == 25
    assert log.compact() == 25 and log.compact() == 0
    files = log.read().inputFiles()
    assert all("_states" in f for f in files) and not child_files(spark, log.path)
    assert sorted(map(tuple, ledger.list_runs().collect())) == before
    ledger.end_run("r5", rows_processed=77)
    opened = log.read().inputFiles()
    assert set(files) < set(opened) and len(opened) == len(files) + 1
    assert ledger.list_runs("s5").where("ingestion_run_id = 'r5'").first()["rows_processed"] == 77
    events.unpersist()


def test_compaction_cut_short_loses_nothing(spark, monkeypatch):
    import strataflow.sinks.eventlog as eventlog

    ledger = RunLedger(spark, fresh_folder(spark, "ledger"), compact_after=10**6)
    log = ledger.run_log
    state = lambda: sorted(map(tuple, ledger.list_runs().collect()))
    log.append(many_events(spark, 10).repartition(3))
    whole = state()

    def dies(*_):
        raise OSError("cut")

    # After the rows, after the list of files, and in the middle of deleting; then events that come in between.
    for where in ("write_text", "remove"):
        with monkeypatch.context() as patch:
            patch.setattr(eventlog, where, dies)
            with pytest.raises(OSError):
                log.compact()
        assert state() == whole
    removed = eventlog.remove
    with monkeypatch.context() as patch:
        patch.setattr(eventlog, "remove", lambda spark, paths: (removed(spark, list(paths)[:1]), dies()))
        with pytest.raises(OSError):
            log.compact()
    assert state() == whole and len(child_files(spark, log.path)) == 2
    ledger.end_run("r1", "FAILED", error_message="late")
    later = state()
    assert [r[4] for r in later if r[0] == "r1"] == ["FAILED"] and len(later) == 10
    assert log.compact() == 1
    assert state() == later and not child_files(spark, log.path) and len(log._states()) == 1


def test_ledger_compacts_itself(spark):
    ledger = RunLedger(spark, fresh_folder(spark, "ledger"), compact_after=4)
    for i in range(6):
        ledger.save_checkpoint("s", i)
    assert len(child_files(spark, ledger.mark_log.path)) <= 4
    assert ledger.load_checkpoint("s") == "5" and ledger.checkpoints().count() == 1


def test_only_new_snapshots_are_read_for_moments(spark):
    import glob

    path, out = fresh_folder(spark, "curated"), fresh_folder(spark, "moments")

    def write(rows, day):
        frame = spark.createDataFrame(rows, "country_code string, year int, gdp_per_capita_usd double, co2_tons_per_capita double")
        write_snapshot(align(frame, schemas.CURATED_ROW), path, day)

    line = lambda year, slope: [(f"C{i}", year, float(i), slope * i + 1) for i in range(6)] + [("X", year, None, 1.0)]
    slopes = lambda: {r["year"]: (round(r["slope"], 9) if r["slope"] is not None else None, r["n"]) for r in fits.fit_years(spark, path, out).collect()}
    write(line(2000, 2.0) + line(2001, 3.0) + [("A", 2002, 5.0, 5.0), ("B", 2002, 5.0, 6.0), ("N", 2003, None, 1.0)], "20240101")
    assert slopes() == {2000: (2.0, 6), 2001: (3.0, 6), 2002: (None, 2)}
    for file in glob.glob(f"{path.removeprefix('file:')}/year=*/snapshot_date=20240101/*.parquet"):
        with open(file, "wb") as broken:
            broken.write(b"this is no data file")
    write(line(2001, 4.0), "20240201")
    assert slopes() == {2000: (2.0, 6), 2001: (4.0, 6), 2002: (None, 2)}
    # The same day written again counts as new.
    write(line(2001, 5.0), "20240201")
    assert slopes() == {2000: (2.0, 6), 2001: (5.0, 6), 2002: (None, 2)}
    assert fits.fit_years(spark, fresh_folder(spark, "none"), fresh_folder(spark, "none")).count() == 0


def test_pages_are_told_changed_by_their_last_revision(spark, ledger):
    root = fresh_folder(spark, "pages")
    seen = SeenKeys(spark, f"{root}/seen")
    rows = {"a": [("Aland", "1", "2")], "b": [("Bland", "3", "4")]}

    def load(day, revisions):
        written = ingest.ingest_pages(several_pages(spark, rows, revisions), f"{root}/raw", ledger, seen=seen, now=datetime(2024, 1, day, tzinfo=timezone.utc))
        return 0 if written is None else written.rows

    assert load(1, {"a": 1, "b": 1}) == 2 and load(2, {"a": 1, "b": 1}) == 0
    assert load(3, {"a": 1, "b": 2}) == 1
    # Set back to an earlier revision it has changed again; without a revision it is always taken.
    assert load(4, {"a": 1, "b": 1}) == 1 and load(5, {"a": None, "b": 1}) == 1 and load(6, {"a": None, "b": 1}) == 1
    assert ledger.checkpoints().count() == 0
