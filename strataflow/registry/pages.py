"""HTML page and landed JSON page queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.functions.text import page_title
from strataflow.operators.html_tables import element_texts, page_tables
from strataflow.plans.ingest import changed_pages, table_snapshots
from strataflow.registry import query
from strataflow.registry.inputs import table
from strataflow.sources.landed import pages_with_revisions, read_pages, revision_fields, unpack_envelope

# A reference may lack its semicolon before anything but a letter or digit.
_TEXT_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(item, '<[^>]*>', ' ', 'g'), '&lt(;|\b)', '<', 'g'), '&gt(;|\b)', '>', 'g'), '&quot(;|\b)', '"', 'g'),
  '&copy(;|\b)', '©', 'g'), '&amp(;|\b)', '&', 'g'), '\[[^\]]*\]', '', 'g'), '\s+', ' ', 'g'))"""

_ITEMS_SQL = f"""items AS (
  SELECT page_id, url, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS pos, unnest(found) AS item
  FROM (SELECT page_id, url, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS found FROM pages)),
texts AS (SELECT page_id, url, pos, {_TEXT_SQL} AS text FROM items)"""


@query("html_rows", f"WITH {_ITEMS_SQL} SELECT page_id, pos, text FROM texts WHERE text <> ''")
def html_rows(spark, sf):
    return element_texts(table(spark, sf, "pages"), "li", keep=["page_id"])


@query(
    "html_headings",
    rf"""WITH items AS (
  SELECT page_id, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS pos, unnest(found) AS item
  FROM (SELECT page_id, regexp_extract_all(regexp_replace(html, '(?s)<script>.*?</script>|<!--.*?-->', '', 'g'),
        '(?s)<h1>(.*?)</h1>', 1) AS found FROM pages))
SELECT page_id, pos, {_TEXT_SQL} AS text FROM items WHERE {_TEXT_SQL} <> ''""",
)
def html_headings(spark, sf):
    return element_texts(table(spark, sf, "pages"), "h1", keep=["page_id"])


def link_pages(spark, sf):
    """The given pages with their link list written as a second table beside a plain one."""
    html = F.col("html")
    for old, new in (
        ("<li>", "<tr><td>"),
        ("</li>", " [n]</td><td></td><td>1,5</td><td>extra</td></tr>"),
        (
            "<ul>",
            '<table class="wikitable"><caption>Other</caption><tr><th>A</th></tr><tr><td>1</td></tr></table>'
            '<table class="sortable wikitable"><caption>CO<sub>2</sub> <b>Emissions</b> per capita</caption>'
            "<tr><th>Location</th><th> </th><th>N<br>1</th><th>V [b]</th></tr><tr><th>head</th><td>x</td></tr>",
        ),
        ("</ul>", "</table>"),
    ):
        html = F.replace(html, F.lit(old), F.lit(new))
    return table(spark, sf, "pages").withColumn("html", html)


@query(
    "html_table_pick",
    f"""WITH {_ITEMS_SQL}
SELECT page_id, 'Location;N 1;V' AS headers, nullif(text, '') AS location, CAST(NULL AS VARCHAR) AS n, '1,5' AS v
FROM texts""",
)
def html_table_pick(spark, sf):
    tables = page_tables(link_pages(spark, sf))
    rows = tables.select("page_id", F.array_join("headers", ";").alias("headers"), F.explode("rows").alias("row"))
    return rows.select(
        "page_id",
        "headers",
        F.col("row")["Location"].alias("location"),
        F.col("row")["N 1"].alias("n"),
        F.col("row")["V"].alias("v"),
    )


@query(
    "html_nested_tables",
    f"""WITH {_ITEMS_SQL}
SELECT page_id, 'Location;V' AS headers, nullif(text, '') AS location, nullif(text, '') AS v FROM texts
UNION ALL SELECT page_id, 'Location;V', nullif(text, ''), NULL FROM texts""",
)
def html_nested_tables(spark, sf):
    """The link list as a table each row of which holds a table of its own: rows and cells of both are read."""
    html = F.col("html")
    for old, new in (
        ("<li>", "<tr><td><table><tr><td>"),
        ("</li>", "</td></tr></table></td><td>1</td></tr>"),
        ("<ul>", '<table><tr><td><table></table></td></tr></table><table class="wikitable"><tr><th>Location</th><th>V</th></tr>'),
        ("</ul>", "</table>"),
    ):
        html = F.replace(html, F.lit(old), F.lit(new))
    tables = page_tables(table(spark, sf, "pages").withColumn("html", html))
    rows = tables.select("page_id", F.array_join("headers", ";").alias("headers"), F.explode("rows").alias("row"))
    return rows.select("page_id", "headers", F.col("row")["Location"].alias("location"), F.col("row")["V"].alias("v"))


@query(
    "page_snapshots",
    f"""WITH {_ITEMS_SQL}
SELECT url AS page_url, page_id AS pageid, page_id * 10 AS revid, 'wikipedia_co2' AS data_source,
       count(*) AS n_rows, CAST(3 AS INTEGER) AS n_headers,
       sha1('{{"headers":["Location","N 1","V"],"page_url":' || to_json(url) || ',"rows":[' || string_agg(
         '{{"Location":' || coalesce(CAST(to_json(nullif(text, '')) AS VARCHAR), 'null') || ',"N 1":null,"V":"1,5"}}', ',' ORDER BY pos)
         || ']}}') AS record_hash
FROM texts GROUP BY url, page_id""",
)
def page_snapshots(spark, sf):
    pages = link_pages(spark, sf).select(
        "url",
        "html",
        F.col("page_id").alias("pageid"),
        (F.col("page_id") * 10).alias("revid"),
        F.lit("2024-01-01T00:00:00Z").alias("rev_timestamp"),
    )
    snapshots = table_snapshots(pages, run_id="run-1", ingestion_ts="2024-01-01T00:00:00Z", location="raw/run-1")
    return snapshots.select(
        "page_url",
        "pageid",
        "revid",
        "data_source",
        F.size("raw_table_json.rows").cast("bigint").alias("n_rows"),
        F.size("raw_table_json.headers").alias("n_headers"),
        "record_hash",
    )


@query(
    "url_title",
    """SELECT page_id, url_decode(replace(regexp_extract(url, '^[a-z]+://[^/?#]*/*([^?#]*)', 1), '+', '%2B')) AS title
FROM pages""",
)
def url_title(spark, sf):
    return table(spark, sf, "pages").select("page_id", page_title("url").alias("title"))


@query(
    "wiki_title",
    """SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*/*([^?#]*)', 1) || ' é/' || page_id AS title FROM pages""",
)
def wiki_title(spark, sf):
    path = page_title("url")
    url = F.concat(F.lit("https://en.example.org/wiki/"), path, F.lit("%20%C3%A9/"), F.col("page_id"), F.lit("?a=1#b"))
    return table(spark, sf, "pages").select("page_id", page_title(url).alias("title"))


@query(
    "page_revision_guard",
    """SELECT page_id FROM pages WHERE NOT (url LIKE '%/en/%') OR url IS NULL""",
)
def page_revision_guard(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id", F.concat_ws(":", F.lit("rev"), "page_id").alias("source"), F.col("page_id").alias("revid"), "url"
    )
    known = F.when(F.col("url").like("%/en/%"), F.col("revid")).otherwise(F.col("revid") - 1)
    checkpoints = pages.select("source", known.cast("string").alias("value"))
    return changed_pages(pages, checkpoints).select("page_id")


@query(
    "envelope_unpack",
    """SELECT CAST(o_orderkey AS VARCHAR) AS code, CAST(year(o_orderdate) AS VARCHAR) AS date,
       CAST(o_orderpriority AS VARCHAR) AS name FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'""",
)
def envelope_unpack(spark, sf):
    key = F.col("o_orderkey").cast("string")
    first = F.struct(
        key.alias("countryiso3code"),
        F.struct(F.lit("c").alias("id"), F.col("o_orderpriority").alias("value")).alias("country"),
        F.year("o_orderdate").cast("string").alias("date"),
    )
    second = F.struct(
        key.alias("countryiso3code"),
        F.struct(F.lit("c").alias("id"), F.col("o_orderstatus").alias("value")).alias("country"),
        F.lit(None).cast("string").alias("date"),
    )
    page = F.concat(F.lit('[{"page":1,"pages":1},'), F.to_json(F.array(first, second)), F.lit("]"))
    body = F.when(F.col("o_orderstatus") == "P", F.lit('{"message":"no data"}')).otherwise(page)
    records = unpack_envelope(table(spark, sf, "orders").select(body.alias("body")), strict=False)
    return records.select(
        F.col("countryiso3code").alias("code"), "date", F.col("country.value").alias("name")
    )


@query(
    "revision_fields",
    """SELECT page_id AS key, page_id AS pageid, CASE WHEN url LIKE '%/en/%' THEN page_id * 10 END AS revid,
       CASE WHEN url LIKE '%/en/%' THEN url END AS rev_timestamp FROM pages""",
)
def revision_of_pages(spark, sf):
    revision = F.when(
        F.col("url").like("%/en/%"),
        F.array(F.struct((F.col("page_id") * 10).alias("revid"), F.col("url").alias("timestamp"))),
    ).otherwise(F.array())
    page = F.struct(F.col("page_id").alias("pageid"), revision.alias("revisions"))
    response = F.to_json(F.struct(F.struct(F.array(page).alias("pages")).alias("query")))
    return table(spark, sf, "pages").select(F.col("page_id").alias("key"), *revision_fields(response))


@query(
    "pages_with_revisions",
    """SELECT p.page_id, p.url, length(p.html) AS html_length, CAST(length(p.url) AS BIGINT) AS pageid,
  CASE WHEN p.url LIKE '%/en/%' THEN CAST(length(p.url) * 10 AS BIGINT) END AS revid FROM pages p""",
)
def revised_pages(spark, sf):
    """Stored pages joined with their landed revision responses; some have no revision."""
    pages = read_pages(spark, f"{sf.rstrip('/')}/pages.parquet")
    size = F.length("url").cast("bigint")
    revision = F.when(F.col("url").like("%/en/%"), F.array(F.struct((size * 10).alias("revid")))).otherwise(F.array())
    page = F.struct(size.alias("pageid"), revision.alias("revisions"))
    body = F.to_json(F.struct(F.struct(F.array(page).alias("pages")).alias("query")))
    responses = pages.select("url").distinct().select("url", body.alias("body"))
    joined = pages_with_revisions(pages, responses)
    return joined.select("page_id", "url", F.length("html").cast("bigint").alias("html_length"), "pageid", "revid")
