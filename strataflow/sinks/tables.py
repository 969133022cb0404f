"""RAW, partitioned, mapping and report writers.

Before a partitioned write the rows are rebalanced on the partition columns:
adaptive execution then splits a hot year into several even files and joins
small ones, where a plain ``repartition`` would send it all to one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


#: Records of a RAW file at most.
RAW_FILE_ROWS = 20_000


@dataclass(frozen=True)
class Written:
    """What a write did: the row count, and further metrics asked for."""

    path: str
    rows: int
    metrics: dict = field(default_factory=dict)


def _observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    # In the last stage, where Spark counts each task once even when it is retried.
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]), observation


def _result(path: str, observation: Observation) -> Written:
    values = dict(observation.get)
    return Written(path, values.pop("rows", 0) or 0, values)


def write_raw(df: DataFrame, path: str, metrics: dict[str, Column] | None = None) -> Written:
    """One new folder of JSON lines per run, written even when there are no rows.

    The files are compressed, and so can't be split by who reads them: none holds more than ``RAW_FILE_ROWS``.
    """
    counted, observation = _observed(df, metrics or {})
    options = {"ignoreNullFields": "false", "compression": "gzip", "maxRecordsPerFile": RAW_FILE_ROWS}
    counted.write.mode("errorifexists").options(**options).json(path)
    return _result(path, observation)


def as_stored(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Empty text in a partition column as NULL, since a path can't tell the two apart."""
    kinds = dict(df.dtypes)
    texts = [p for p in partitions if kinds[p] == "string"]
    return df.withColumns({p: F.nullif(p, F.lit("")) for p in texts}) if texts else df


def _write_partitions(df: DataFrame, path: str, partitions: Sequence[str], mode: str) -> Written:
    """Rows without a value for the first partition column are not written."""
    keyed = as_stored(df, partitions).where(F.col(partitions[0]).isNotNull()).hint("rebalance", *[F.col(p) for p in partitions])
    counted, observation = _observed(keyed, {})
    (
        counted.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    return _result(path, observation)


def overwrite_partitions(df: DataFrame, path: str, partitions: Sequence[str] = ("year",)) -> Written:
    """Replace only the partitions that have rows in ``df``; the others stay."""
    return _write_partitions(df, path, partitions, "overwrite")


def append_partitions(df: DataFrame, path: str, partitions: Sequence[str] = ("year",)) -> Written:
    """Add rows to the partitions they belong to; nothing stored is read or written anew."""
    return _write_partitions(df, path, partitions, "append")


def write_snapshot(df: DataFrame, path: str, snapshot_date: str) -> Written:
    """Write ``year=/snapshot_date=`` partitions; a rerun of the same day replaces them."""
    stamped = df.drop("snapshot_date").withColumn("snapshot_date", F.lit(snapshot_date))
    return overwrite_partitions(stamped, path, ("year", "snapshot_date"))


def replace_table(df: DataFrame, path: str) -> Written:
    """Replace a whole table; a small one ends up in one file."""
    counted, observation = _observed(df.hint("rebalance"), {})
    counted.write.mode("overwrite").parquet(path)
    return _result(path, observation)


def write_report(df: DataFrame, root: str, name: str, run_date: str) -> str:
    """Headed CSV under ``run_date=``, header included when there are no rows.

    A report has one row per requested key, so one file in order is enough.
    """
    path = f"{root.rstrip('/')}/run_date={run_date}/{name}"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
