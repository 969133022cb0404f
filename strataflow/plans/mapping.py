"""Key mapping: normalised name to code, from typed rows and manual overrides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.functions.text import name_key
from strataflow.operators.dedup import first_per_key
from strataflow.operators.joins import merge_overrides
from strataflow.operators.project import drop_null, require_columns
from strataflow.plans import defaults
from strataflow.sinks.tables import Written, replace_table
from strataflow.sources.landed import parse_overrides, read_overrides
from strataflow.sources.tables import read_table

KEY, VALUES = "country_name_normalized", ["country_code", "country_name"]


def default_overrides(spark: SparkSession) -> DataFrame:
    """The built-in manual overrides."""
    lines = [(line,) for line in defaults.COUNTRY_OVERRIDES.splitlines()]
    return parse_overrides(spark.createDataFrame(lines, "value string"))


def base_mapping(processed: DataFrame) -> DataFrame:
    """Mapping from the names in use.

    Names are reduced to distinct ones before keys are computed. Of several names
    with one key the latest ingested wins.
    """
    require_columns(processed, VALUES, "processed table")
    newest = F.max("ingestion_ts") if "ingestion_ts" in processed.columns else F.lit(None).cast("timestamp")
    names = drop_null(processed, *VALUES).groupBy(*VALUES).agg(newest.alias("_newest"))
    keyed = names.withColumn(KEY, name_key("country_name"))
    picked = first_per_key(keyed, [KEY], [F.col("_newest").desc_nulls_last()])
    return picked.select(KEY, *VALUES, F.lit(defaults.MAPPING_TAG).alias("source_precedence"))


def build_mapping(processed: DataFrame, overrides: DataFrame) -> DataFrame:
    normalised = overrides.withColumn(KEY, name_key(KEY))
    return merge_overrides(
        base_mapping(processed),
        normalised,
        key=KEY,
        values=VALUES,
        override_tag=defaults.OVERRIDE_TAG,
        default_tag=defaults.MAPPING_TAG,
    )


def mapping_changes(wanted: DataFrame, applied: DataFrame) -> DataFrame:
    """Mapping rows whose key is new, or whose code or name is another than in ``applied``."""
    before = applied.select(KEY, F.struct(*VALUES).alias("_before"))
    joined = wanted.join(before, KEY, "left")
    return joined.where(~F.col("_before").eqNullSafe(F.struct(*VALUES))).drop("_before")


def build_and_save_mapping(
    spark: SparkSession, processed_path: str, out: str, overrides_path: str | None = None
) -> Written:
    """Mapping of a stored table, with overrides of a file or the built-in ones."""
    overrides = default_overrides(spark) if overrides_path is None else read_overrides(spark, overrides_path)
    processed = read_table(spark, processed_path, schemas.PROCESSED_GDP)
    return replace_table(build_mapping(processed, overrides), out)
