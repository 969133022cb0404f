"""Fits of all years from stored moments of the curated snapshots."""

from __future__ import annotations

from hashlib import sha1

from pyspark.sql import DataFrame, SparkSession

from strataflow import schemas
from strataflow.operators.moments import fit_of, merge_moments, moments
from strataflow.plans.analytics import X, Y, unique_curated
from strataflow.session import discard, settle
from strataflow.sinks.tables import overwrite_partitions
from strataflow.sources.folders import child_files, newest_folders, partition_values
from strataflow.sources.tables import read_folders

def _signature(spark: SparkSession, folder: str) -> str:
    """What a snapshot consists of: a snapshot that is written again has files of other names."""
    return sha1("\n".join(child_files(spark, folder)).encode()).hexdigest()


def refresh_moments(spark: SparkSession, curated: str, out: str) -> DataFrame:
    """Moments of the newest snapshot of each year, stored below ``out`` by year and snapshot.

    Only snapshots whose moments aren't stored yet, or that were written again since, are read. A
    snapshot without complete pairs is noted with none.
    """
    newest = {tuple(f.rsplit("/", 2)[1:]): f for f in newest_folders(spark, curated, "year", "snapshot_date")}
    made_of = {key: _signature(spark, folder) for key, folder in newest.items()}
    stored = {
        (year.rsplit("/", 1)[1], folder.rsplit("/", 1)[1]): folder
        for year in partition_values(spark, out, "year").values()
        for folder in partition_values(spark, year, "snapshot_date").values()
    }
    known = read_folders(spark, out, [stored[k] for k in newest if k in stored], schemas.MOMENTS)
    fresh = {(f"year={r['year']}", f"snapshot_date={r['snapshot_date']}"): r["files"] for r in known.select("year", "snapshot_date", "files").collect()}
    stale = [key for key in newest if fresh.get(key) != made_of[key]]
    if stale:
        rows = read_folders(spark, curated, [newest[key] for key in stale], schemas.CURATED)
        found = moments(unique_curated(rows), ["year", "snapshot_date"], X, Y)
        names = spark.createDataFrame(
            [(int(year.split("=")[1]), snapshot.split("=")[1], made_of[year, snapshot]) for year, snapshot in stale],
            "year int, snapshot_date string, files string",
        )
        whole = names.join(found, ["year", "snapshot_date"], "left").fillna(0, ["n"])
        new = settle(whole.select(*schemas.MOMENTS.fieldNames()))
        overwrite_partitions(new, out, ("year", "snapshot_date"))
        discard(new)
    return read_folders(spark, out, [f"{out.rstrip('/')}/{year}/{snapshot}" for year, snapshot in newest], schemas.MOMENTS)


def fit_years(spark: SparkSession, curated: str, out: str) -> DataFrame:
    """Fit and correlation of every year of the curated table as it is now."""
    merged = merge_moments(refresh_moments(spark, curated, out), ["year"])
    return fit_of(merged, ["year"])
