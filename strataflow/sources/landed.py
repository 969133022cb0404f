"""RAW-side scans: JSON lines, paged envelopes, revision responses, pages, overrides."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflow import schemas
from strataflow.functions.parsing import bind, blank_to_null, col_of, strip
from strataflow.operators.project import require_columns


def read_json_lines(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """JSON lines under a fixed schema. Blank lines are skipped, a malformed one fails."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", "true").json(path)


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(*([path] if isinstance(path, str) else path))


def read_envelopes(spark: SparkSession, path: str | list[str], *, per_line: bool = False) -> DataFrame:
    """One row per landed API page: a file each, or a line each where a file holds many."""
    pages = spark.read.text(path, wholetext=not per_line, recursiveFileLookup=True)
    return pages.where(F.trim("value") != "").select(F.col("value").alias("body"))


def unpack_envelope(envelopes: DataFrame, body: str = "body", *, strict: bool = True) -> DataFrame:
    """Records of ``[meta, [record, ...]]`` pages: typed fields, and canonical JSON as ``payload``.

    A body of another shape fails the job; without ``strict`` it gives no rows.
    """
    parts = F.try_variant_get(F.try_parse_json(F.col(body)), "$", "array<variant>")
    records = bind(
        parts,
        lambda found: F.when(
            (F.size(found) == 2) & F.schema_of_variant(F.get(found, F.lit(0))).startswith("OBJECT"),
            F.try_variant_get(F.get(found, F.lit(1)), "$", "array<variant>"),
        ),
    )
    if strict:
        message = F.concat(F.lit("unexpected page structure: "), F.substring(F.coalesce(body, F.lit("")), 1, 200))
        records = F.coalesce(records, F.raise_error(message).cast("array<variant>"))
    return envelopes.select(F.explode(records).alias("_record")).select(
        *[
            F.try_variant_get("_record", f"$.{field.name}", field.dataType.simpleString()).alias(field.name)
            for field in schemas.RAW_RECORD.fields[:5]
        ],
        F.to_json("_record").alias("payload"),
    )


def revision_fields(body: Column | str) -> list[Column]:
    """Page id, revision id and revision time of a page-revision response."""
    response = F.try_parse_json(col_of(body))
    revision = "$.query.pages[0].revisions[0]"
    return [
        F.try_variant_get(response, "$.query.pages[0].pageid", "bigint").alias("pageid"),
        F.try_variant_get(response, f"{revision}.revid", "bigint").alias("revid"),
        F.try_variant_get(response, f"{revision}.timestamp", "string").alias("rev_timestamp"),
    ]


def pages_with_revisions(pages: DataFrame, responses: DataFrame) -> DataFrame:
    """Stored pages as the page ingest takes them: each with the revision of its landed response.

    ``responses`` has (url, body), one a URL. A page without a response has no revision.
    """
    revisions = responses.select("url", *revision_fields("body"))
    return pages.join(revisions, "url", "left")


def parse_overrides(lines: DataFrame, value: str = "value") -> DataFrame:
    """Rows of ``key,code,name`` text lines; the name may hold commas and need not be quoted."""
    parts = F.split(F.col(value), ",", 3)
    unquoted = F.replace(F.regexp_replace(strip(parts[2]), '^"(.*)"$', "$1"), F.lit('""'), F.lit('"'))
    names = schemas.OVERRIDES.fieldNames()
    return (
        lines.where((strip(value) != "") & (strip(value) != F.lit(",".join(names))))
        .select(
            blank_to_null(strip(parts[0])).alias(names[0]),
            blank_to_null(strip(parts[1])).alias(names[1]),
            blank_to_null(unquoted).alias(names[2]),
        )
    )


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Manual overrides of a small headed text file; no file means no overrides."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.OVERRIDES)
    header = lines.first()
    if header is None:
        return spark.createDataFrame([], schemas.OVERRIDES)
    found = [name.strip() for name in header["value"].split(",")]
    require_columns(spark.createDataFrame([], ", ".join(f"`{n}` string" for n in found)), schemas.OVERRIDES.fieldNames(), "overrides file")
    return parse_overrides(lines)
