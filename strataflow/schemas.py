"""Fixed schemas of the layers; every reader is given one, nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_ID_VALUE = _struct(id=StringType(), value=StringType())

RAW_RECORD = _struct(
    indicator=_ID_VALUE,
    country=_ID_VALUE,
    countryiso3code=StringType(),
    date=StringType(),
    value=StringType(),
    ingestion_run_id=StringType(),
    ingestion_ts=StringType(),
    data_source=StringType(),
    raw_payload=StringType(),
    record_hash=StringType(),
    raw_file_path=StringType(),
)

RAW_TABLE_JSON = _struct(
    page_url=StringType(),
    headers=ArrayType(StringType()),
    rows=ArrayType(MapType(StringType(), StringType())),
)

RAW_TABLE = _struct(
    ingestion_run_id=StringType(),
    ingestion_ts=StringType(),
    data_source=StringType(),
    page_url=StringType(),
    pageid=LongType(),
    revid=LongType(),
    rev_timestamp=StringType(),
    table_html=StringType(),
    raw_table_json=RAW_TABLE_JSON,
    record_hash=StringType(),
    raw_file_path=StringType(),
)

PAGES = _struct(page_id=LongType(), url=StringType(), html=StringType())

PROCESSED_GDP = _struct(
    country_code=StringType(),
    country_name=StringType(),
    year=IntegerType(),
    gdp_per_capita_usd=DoubleType(),
    indicator_id=StringType(),
    indicator_name=StringType(),
    ingestion_run_id=StringType(),
    ingestion_ts=TimestampType(),
    data_source=StringType(),
)

PROCESSED_CO2 = _struct(
    country_name=StringType(),
    country_name_normalized=StringType(),
    country_code=StringType(),
    year=IntegerType(),
    co2_tons_per_capita=DoubleType(),
    notes=StringType(),
    ingestion_run_id=StringType(),
    ingestion_ts=TimestampType(),
    data_source=StringType(),
    page_url=StringType(),
)

OVERRIDES = _struct(
    country_name_normalized=StringType(),
    country_code=StringType(),
    country_name=StringType(),
)

MAPPING = _struct(
    country_name_normalized=StringType(),
    country_code=StringType(),
    country_name=StringType(),
    source_precedence=StringType(),
)

CURATED_ROW = _struct(
    country_code=StringType(),
    country_name=StringType(),
    year=IntegerType(),
    gdp_per_capita_usd=DoubleType(),
    co2_tons_per_capita=DoubleType(),
    co2_per_1000usd_gdp=DoubleType(),
    gdp_source_system=StringType(),
    co2_source_system=StringType(),
    first_ingestion_run_id=StringType(),
    last_update_run_id=StringType(),
    last_update_ts=TimestampType(),
)

# As stored: the snapshot partition is text, never a number.
CURATED = StructType(CURATED_ROW.fields + [StructField("snapshot_date", StringType(), True)])

LEDGER = _struct(
    ingestion_run_id=StringType(),
    run_scope=StringType(),
    event_ts=TimestampType(),
    status=StringType(),
    rows_processed=LongType(),
    last_checkpoint=StringType(),
    error_message=StringType(),
)

CHECKPOINTS = _struct(source=StringType(), value=StringType(), saved_ts=TimestampType())

# Moments of a curated snapshot, and which files it consisted of.
MOMENTS = _struct(
    n=LongType(),
    x_mean=DoubleType(),
    y_mean=DoubleType(),
    xx=DoubleType(),
    yy=DoubleType(),
    xy=DoubleType(),
    x_min=DoubleType(),
    x_max=DoubleType(),
    y_min=DoubleType(),
    y_max=DoubleType(),
    files=StringType(),
    year=IntegerType(),
    snapshot_date=StringType(),
)
