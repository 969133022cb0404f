"""Projections, filters and schema alignment."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StructType, TimestampType

from strataflow.functions.hashing import canonical_json
from strataflow.functions.parsing import col_of, nan_to_null, parse_utc_timestamp


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks required columns: {missing}")
    return df


def missing_fields(df: DataFrame, payload: Column | str, required: Iterable[str], keep: Iterable[str]) -> DataFrame:
    """One row for each required field that a JSON record lacks, with the kept columns; no object lacks them all.

    What ``require_columns`` says of a table before it is read, of the records of one that
    is landed as text.
    """
    names = F.array(*[F.lit(name) for name in sorted(set(required))])
    found = F.coalesce(F.json_object_keys(col_of(payload)), F.array().cast("array<string>"))
    return df.select(*keep, F.explode(F.array_except(names, found)).alias("missing"))


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``: extras dropped, absent ones NULL, types cast leniently."""
    present = dict(df.dtypes)

    def cast(field) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source, kind = F.col(field.name), field.dataType
        if present[field.name] == kind.simpleString():
            value = source
        elif isinstance(kind, TimestampType) and present[field.name] == "string":
            value = parse_utc_timestamp(source)
        else:
            value = source.try_cast(kind)
        if isinstance(kind, (DoubleType, FloatType)):
            value = nan_to_null(value)
        elif isinstance(kind, (IntegerType, LongType)) and present[field.name] in ("double", "float"):
            value = nan_to_null(source).try_cast(kind)
        return value.alias(field.name)

    return df.select([cast(field) for field in schema.fields])


def keep_expected(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """The expected columns that are there, in the expected order."""
    present = set(df.columns)
    return df.select([name for name in expected if name in present])


def drop_blank(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows whose listed text columns are neither NULL nor empty."""
    for name in columns:
        df = df.where(F.col(name) != "")
    return df


def drop_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop(subset=list(columns))


def year_between(
    df: DataFrame, year: str, above: int | None = None, up_to: int | None = None
) -> DataFrame:
    """Rows with ``above < year <= up_to``; an open end is None. A NULL year never passes."""
    bounds = F.col(year).isNotNull()
    if above is not None:
        bounds = bounds & (F.col(year) > above)
    if up_to is not None:
        bounds = bounds & (F.col(year) <= up_to)
    return df.where(bounds)


def with_audit(
    df: DataFrame,
    payload: Column | str,
    *,
    run_id: str,
    ingestion_ts: str,
    data_source: str,
    location: str,
    canonical: bool = False,
) -> DataFrame:
    """Audit columns of the RAW layer: run, time, source, payload, hash and place.

    ``canonical`` says the payload already has its keys sorted.
    """
    body = col_of(payload) if canonical else canonical_json(payload)
    return df.withColumn("raw_payload", body).withColumns(
        {
            "ingestion_run_id": F.lit(run_id),
            "ingestion_ts": F.lit(ingestion_ts),
            "data_source": F.lit(data_source),
            "record_hash": F.sha1(F.col("raw_payload")),
            "raw_file_path": F.lit(location),
        }
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column one frame lacks is NULL in its rows."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
