"""Cleaning, parsing, reshaping, hashing and key-mapping queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from strataflow.functions.hashing import record_hash
from strataflow.functions.parsing import (
    default_if_blank,
    parse_cell_number,
    parse_number,
    parse_utc_timestamp,
    parse_year,
)
from strataflow.functions.text import clean_cell, name_key
from strataflow.operators.dedup import distinct_years
from strataflow.operators.joins import map_keys, with_name_key
from strataflow.operators.project import align, drop_blank, missing_fields
from strataflow.operators.reshape import long_to_wide, unnest_rows, wide_to_long, zip_cells
from strataflow.plans import defaults
from strataflow.plans.mapping import build_mapping
from strataflow.registry import query
from strataflow.registry.inputs import ECON_SQL, ENV_SQL, econ, env, table
from strataflow.session import settle
from strataflow.sources.landed import parse_overrides


@query(
    "key_normalise",
    """SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g')) AS name_key
FROM documents""",
)
def key_normalise(spark, sf):
    return table(spark, sf, "documents").select("doc_id", name_key("text").alias("name_key"))


@query(
    "cell_clean",
    r"""SELECT doc_id, trim(regexp_replace(regexp_replace(text || ' [' || doc_id || ']', '\[[^\]]*\]', '', 'g'),
  '[\s\p{Z}\x{85}]+', ' ', 'g')) AS cell FROM documents""",
)
def cell_clean(spark, sf):
    noted = F.concat(F.col("text"), F.lit(" ["), F.col("doc_id").cast("string"), F.lit("]"))
    return table(spark, sf, "documents").select("doc_id", clean_cell(noted).alias("cell"))


@query(
    "safe_float",
    """WITH cells AS (
  SELECT o_orderkey, CASE o_orderpriority
    WHEN '1-URGENT' THEN format('{:,.2f}', o_totalprice) WHEN '2-HIGH' THEN '-' WHEN '3-MEDIUM' THEN ' n/a '
    WHEN '4-NOT SPECIFIED' THEN '  ' || CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)
    ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) || ' t' END AS cell FROM orders)
SELECT o_orderkey, CASE WHEN upper(trim(cell)) NOT IN ('', '-', '–', 'NA', 'N/A')
  THEN TRY_CAST(replace(trim(cell), ',', '') AS DOUBLE) END AS value FROM cells""",
)
def safe_float(spark, sf):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    plain = price.cast("decimal(15,2)").cast("string")
    cell = (
        F.when(priority == "1-URGENT", F.format_number(price.cast("decimal(15,2)"), 2))
        .when(priority == "2-HIGH", F.lit("-"))
        .when(priority == "3-MEDIUM", F.lit(" n/a "))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("  "), plain))
        .otherwise(F.concat(plain, F.lit(" t")))
    )
    return table(spark, sf, "orders").select("o_orderkey", parse_cell_number(cell).alias("value"))


@query(
    "year_parse",
    """WITH dated AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(year(o_orderdate) AS VARCHAR)
    WHEN 'O' THEN year(o_orderdate) || 'O' ELSE ' ' || year(o_orderdate) END AS date FROM orders)
SELECT o_orderkey, CASE WHEN regexp_full_match(date, '[0-9]+') THEN TRY_CAST(date AS INTEGER) END AS year FROM dated""",
)
def year_parse(spark, sf):
    year, status = F.year("o_orderdate").cast("string"), F.col("o_orderstatus")
    date = (
        F.when(status == "F", year)
        .when(status == "O", F.concat(year, F.lit("O")))
        .otherwise(F.concat(F.lit(" "), year))
    )
    return table(spark, sf, "orders").select("o_orderkey", parse_year(date).alias("year"))


@query(
    "timestamp_parse",
    """SELECT o_orderkey, CAST(CASE o_orderpriority
  WHEN '1-URGENT' THEN epoch(o_orderdate) WHEN '2-HIGH' THEN epoch(o_orderdate) + 8 * 3600
  WHEN '3-MEDIUM' THEN epoch(o_orderdate) + 8 * 3600 + 1800 END AS BIGINT) AS seconds FROM orders""",
)
def timestamp_parse(spark, sf):
    day, priority = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", day)
        .when(priority == "2-HIGH", F.concat(day, F.lit("T10:00:00+02:00")))
        .when(priority == "3-MEDIUM", F.concat(day, F.lit(" 08:30:00")))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("on "), day))
    )
    return table(spark, sf, "orders").select("o_orderkey", F.unix_seconds(parse_utc_timestamp(text)).alias("seconds"))


@query(
    "json_project",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
  coalesce(nullif(CASE WHEN event_type = 'error' THEN '' ELSE event_type END, ''), 'unknown') AS kind
FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL AND json_extract_string(props, '$.k') <> ''""",
)
def json_project(spark, sf):
    record = F.from_json("props", StructType([StructField("k", StringType())]))
    flat = table(spark, sf, "events").select("event_id", "event_type", record["k"].alias("key"))
    kind = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type"))
    return drop_blank(flat, "key").select(
        "event_id", parse_number("key").alias("k"), default_if_blank(kind, "unknown").alias("kind")
    )


@query(
    "schema_align",
    """SELECT c_custkey AS account, TRY_CAST(c_acctbal AS INTEGER) > 0 AS positive, CAST(NULL AS VARCHAR) AS note,
  CAST(c_acctbal AS DOUBLE) AS balance, TRY_CAST(c_mktsegment AS INTEGER) AS segment_id FROM customer""",
)
def schema_align(spark, sf):
    schema = StructType(
        [
            StructField("account", LongType()),
            StructField("note", StringType()),
            StructField("balance", DoubleType()),
            StructField("segment_id", IntegerType()),
        ]
    )
    loose = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("account"),
        F.col("c_acctbal").cast("string").alias("balance"),
        F.col("c_mktsegment").alias("segment_id"),
        F.col("c_name").alias("extra"),
    )
    aligned = align(loose, schema)
    return aligned.withColumn("positive", F.round("balance", 0) > 0)


@query(
    "unpivot_years",
    f"""WITH {ENV_SQL}
SELECT country_code, CAST(year AS INTEGER) AS year, co2_tons_per_capita FROM env""",
)
def unpivot_years(spark, sf):
    """All years to columns, one each, and back."""
    long = settle(env(spark, sf))
    columns = {f"y{row['year']}": row["year"] for row in distinct_years(long).collect()}
    wide = long_to_wide(long, ["country_code"], columns, value="co2_tons_per_capita")
    return wide_to_long(wide, ["country_code"], columns, value="co2_tons_per_capita")


@query(
    "zip_cells",
    """WITH lines AS (
  SELECT doc_id, string_split(unnest(string_split(text, chr(10))), ' ') AS cells,
         CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS pos FROM documents)
SELECT doc_id, pos, cells[1] AS a, cells[4] AS b, cells[3] AS c FROM lines""",
)
def zip_document_cells(spark, sf):
    headers = F.array(*[F.lit(name) for name in ("a", "b", "c", "b")])
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    zipped = lines.select("doc_id", "pos", zip_cells(headers, F.split("line", " ", -1)).alias("row"))
    return zipped.select("doc_id", "pos", *[F.col("row")[name].alias(name) for name in ("a", "b", "c")])


@query(
    "unnest_words",
    "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents",
)
def unnest_words(spark, sf):
    words = table(spark, sf, "documents").withColumn("words", F.split("text", " ", -1))
    return unnest_rows(words, "words", ["doc_id"], "word")


@query(
    "record_hash",
    """SELECT event_id, sha1('{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":{"k":'
  || json_extract_string(props, '$.k') || '},"user_id":' || user_id || '}') AS record_hash FROM events""",
)
def event_hash(spark, sf):
    payload = F.concat(
        F.lit('{"user_id": '), F.col("user_id"), F.lit(', "props": '), F.col("props"),
        F.lit(', "event_type": "'), F.col("event_type"), F.lit('", "event_id": '), F.col("event_id"), F.lit("}"),
    )
    return table(spark, sf, "events").select("event_id", record_hash(payload).alias("record_hash"))


OVERRIDE_LINES = [
    "country_name_normalized,country_code,country_name",
    "nation 0,ZZ0,Nation, Zero",
    "",
    'Nátion  3,ZZ3,"Nation, Three"',
    "atlantis,ATL,Atlantis",
    "nation 5,,Five",
]
_OVERRIDE_SQL = """overrides(k, code, name) AS (VALUES ('nation 0', 'ZZ0', 'Nation, Zero'),
  ('nation 3', 'ZZ3', 'Nation, Three'), ('atlantis', 'ATL', 'Atlantis'), ('nation 5', NULL, 'Five'))"""
_MAPPING_SQL = f"""base AS (
  SELECT DISTINCT replace(lower(country_name), '_', ' ') AS k, country_code AS code, country_name AS name FROM econ),
{_OVERRIDE_SQL},
mapping AS (SELECT coalesce(o.k, b.k) AS country_name_normalized, coalesce(o.code, b.code) AS country_code,
  coalesce(o.name, b.name) AS country_name,
  CASE WHEN o.k IS NOT NULL THEN 'override' ELSE 'world_bank' END AS source_precedence
  FROM base b FULL JOIN overrides o ON b.k = o.k)"""


def nation_mapping(spark, sf):
    lines = spark.createDataFrame([(line,) for line in OVERRIDE_LINES], "value string")
    return build_mapping(econ(spark, sf), parse_overrides(lines))


@query("mapping_override", f"WITH {ECON_SQL}, {_MAPPING_SQL} SELECT * FROM mapping")
def mapping_override(spark, sf):
    return nation_mapping(spark, sf)


@query(
    "lookup_join",
    f"""WITH {ECON_SQL}, {_MAPPING_SQL}, facts AS (
  SELECT c_custkey, 'Nation  ' || c_nationkey || '!' AS country_name, 'nation ' || c_nationkey AS k FROM customer)
SELECT f.c_custkey, f.k AS country_name_normalized, m.country_code, coalesce(m.country_name, f.country_name) AS country_name
FROM facts f LEFT JOIN mapping m ON f.k = m.country_name_normalized""",
)
def lookup_join_names(spark, sf):
    spoken = F.concat(F.lit("Nation  "), F.col("c_nationkey").cast("string"), F.lit("!"))
    facts = table(spark, sf, "customer").select("c_custkey", spoken.alias("country_name"))
    keyed = with_name_key(facts, "country_name", "country_name_normalized")
    return map_keys(
        keyed, nation_mapping(spark, sf), key="country_name_normalized", values=["country_code", "country_name"]
    ).select("c_custkey", "country_name_normalized", "country_code", "country_name")


def _default_override_rows() -> str:
    rows = [line.split(",", 2) for line in defaults.COUNTRY_OVERRIDES.splitlines()[1:]]
    quoted = [", ".join("'" + part.replace("'", "''") + "'" for part in row) for row in rows]
    return ", ".join(f"({row})" for row in quoted)


DEFAULT_OVERRIDE_ROWS = _default_override_rows()


@query(
    "missing_columns",
    """SELECT o_orderkey, 'country_code' AS missing FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT o_orderkey, 'date' FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 'value' FROM orders WHERE o_custkey % 7 = 0
UNION ALL SELECT o_orderkey, 'indicator' FROM orders""",
)
def missing_columns(spark, sf):
    """Required columns that landed records lack, reported as rows."""
    record = F.struct(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("country_code"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("date"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_totalprice")).alias("value"),
        F.lit("more").alias("unit"),
    )
    landed = table(spark, sf, "orders").select("o_orderkey", F.to_json(record).alias("payload"))
    return missing_fields(landed, "payload", ["country_code", "date", "value", "indicator"], ["o_orderkey"])
