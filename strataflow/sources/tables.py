"""Scans of stored, partitioned Parquet tables and their snapshots."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflow import schemas
from strataflow.functions.text import partition_value
from strataflow.sources.folders import newest_folders

# Up to this many partitions are also named in a literal filter, which prunes the scan.
MAX_LITERAL_PARTITIONS = 500


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table under a fixed schema; a path that is not there is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MAPPING).parquet(path)


def for_years(table: DataFrame, years: Iterable[int] | None, year: str = "year") -> DataFrame:
    """Only the partitions of the given years."""
    return table if years is None else table.where(F.col(year).isin([int(y) for y in years]))


def only_partitions(table: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the partitions listed in ``wanted``, one row per partition; NULL is a value like others.

    A short list becomes a literal filter, so other partitions are not opened. A
    long one is joined by the same null-safe rule, with the same rows.
    """
    columns = list(columns)
    values = wanted.select(*columns).limit(MAX_LITERAL_PARTITIONS + 1).collect()
    if len(values) > MAX_LITERAL_PARTITIONS:
        named = wanted.select(*[F.col(c).alias(f"_wanted_{c}") for c in columns])
        return table.join(named, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_wanted_{c}")) for c in columns]), "left_semi")
    if not values:
        return table.where(F.lit(False))
    return table.where(reduce(or_, [reduce(and_, [F.col(c).eqNullSafe(v[c]) for c in columns]) for v in values]))


def read_folders(spark: SparkSession, path: str, folders: Sequence[str], schema: StructType) -> DataFrame:
    """The named partition folders of a table, and no others; no folder is an empty table."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def read_curated(
    spark: SparkSession,
    path: str,
    years: Iterable[int] | None = None,
    *,
    latest_only: bool = True,
    as_of: str | None = None,
) -> DataFrame:
    """Curated rows: chosen years, newest snapshot of each unless all are wanted.

    The newest snapshots are picked by the names of their folders, as they stood on ``as_of`` if
    that is given; no file of an older one is listed or opened.
    """
    chosen = None if years is None else {int(y) for y in years}
    if latest_only:
        wanted = None if chosen is None else lambda year: year.lstrip("-").isdigit() and int(year) in chosen
        return read_folders(spark, path, newest_folders(spark, path, "year", "snapshot_date", wanted, as_of), schemas.CURATED)
    table = for_years(read_table(spark, path, schemas.CURATED), chosen)
    return table if as_of is None else table.where(F.col("snapshot_date") <= as_of)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under a prefix with size and time; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", "modificationTime")


def with_partition_value(table: DataFrame, name: str) -> DataFrame:
    """Add the ``name=value`` part of each row's file path as a column."""
    return table.withColumn(name, partition_value(F.col("_metadata.file_path"), name))
