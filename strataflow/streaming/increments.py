"""New RAW files to a partitioned table, each file once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strataflow.operators.dedup import first_per_key
from strataflow.session import freeing, settle
from strataflow.sinks.seen import SeenKeys
from strataflow.sinks.tables import Written, append_partitions, as_stored, overwrite_partitions
from strataflow.sources.folders import folder_of, remove
from strataflow.sources.tables import only_partitions, read_table

#: Which file a row was made of, in what a load reads and in what it appends.
SOURCE_FILE = "source_file"
#: Beside the data, where readers of the table don't look: the files that a load has begun to append.
LOADED_FILES = "_loaded_files"


def _touched(batch: DataFrame, stored: DataFrame, keys: Sequence[str], partitions: Sequence[str]) -> DataFrame:
    """Partitions a batch has rows for, and those that hold a stored row with one of its keys."""
    new = batch.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    moved = stored.join(new, same, "left_semi")
    return batch.select(*partitions).unionByName(moved.select(*partitions)).distinct()


def merge_partitions(
    batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partitions: Sequence[str] = ("year",)
) -> tuple[DataFrame, DataFrame]:
    """The touched partitions after a merge, the latest row per key, and which partitions those are.

    A key that the batch has in another partition than before leaves the old one.
    NULL counts as a value, in keys and in partitions, where empty text is NULL. The result is settled, since it is about to overwrite what it read.
    """
    batch, stored = as_stored(batch, partitions), read_table(batch.sparkSession, path, batch.schema)
    touched = settle(_touched(batch, stored, keys, partitions))
    both = batch.unionByName(only_partitions(stored, touched, partitions))
    return settle(first_per_key(both, keys, [F.col(name).desc_nulls_last() for name in order])), touched


def replace_owned(
    batch: DataFrame, owners: DataFrame, path: str, owner: str, partitions: Sequence[str] = ("year",)
) -> tuple[DataFrame, DataFrame]:
    """The touched partitions with all stored rows of the given owners replaced by those of the batch.

    For sources that are read whole, such as a page: what it no longer has must go,
    and what other owners have stays.
    """
    batch, stored = as_stored(batch, partitions), read_table(batch.sparkSession, path, batch.schema)
    named = settle(owners.select(owner).distinct())
    old = stored.join(named, owner, "left_semi")
    touched = settle(batch.select(*partitions).unionByName(old.select(*partitions)).distinct())
    others = only_partitions(stored, touched, partitions).join(named, owner, "left_anti")
    return settle(batch.unionByName(others)), touched


def write_touched(rows: DataFrame, touched: DataFrame, path: str, partitions: Sequence[str] = ("year",)) -> None:
    """Overwrite the touched partitions, all in one job; the folders of those that have no row left go.

    Their folders are taken from the files stored in them, whatever the values look
    like when written in a path.
    """
    spark = rows.sparkSession
    overwrite_partitions(rows, path, partitions)
    left = rows.select(*partitions).distinct()
    same = [touched[c].eqNullSafe(left[c]) for c in partitions]
    gone = touched.where(F.col(partitions[0]).isNotNull()).join(left, same, "left_anti").select(*partitions)
    stored = only_partitions(read_table(spark, path, rows.schema), gone, partitions)
    # One file of each folder is enough to name it.
    file = F.col("_metadata.file_path")
    files = stored.select(file.alias("file")).groupBy(F.regexp_replace("file", "/[^/]*$", "")).agg(F.first("file").alias("file"))
    remove(spark, [folder_of(spark, row["file"]) for row in files.toLocalIterator()])


def append_files(rows: DataFrame, files: DataFrame, path: str, partitions: Sequence[str] = ("year",)) -> int:
    """Append the rows made of some files, and put them in place of what these files have stored already.

    ``rows`` and ``files`` name the file in ``source_file``. The files are noted before their rows are
    written, so a batch that is repeated, after whatever part of it was written, finds them
    noted and replaces the rows of its own files and no others. New files cost neither a
    look at the table nor a rewrite.
    """
    log = SeenKeys(rows.sparkSession, f"{path.rstrip('/')}/{LOADED_FILES}")
    files = settle(files)
    known = log.known(files, SOURCE_FILE).select(F.col("key").alias(SOURCE_FILE))
    if known.isEmpty():
        log.add(files, SOURCE_FILE)
        return append_partitions(rows, path, partitions).rows
    known, made = settle(known), settle(rows)
    log.add(files, SOURCE_FILE)
    new, touched = replace_owned(made, known, path, SOURCE_FILE, partitions)
    write_touched(new, touched, path, partitions)
    return made.count()


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    state: str,
    transform: Callable[[DataFrame], DataFrame],
    *,
    partitions: Sequence[str] = ("year",),
    merge_on: Sequence[str] | None = None,
    latest_by: Sequence[str] = (),
    owner: str | None = None,
    replace: bool = False,
    max_files: int | None = None,
) -> Written:
    """Process files not seen before and stop; ``rows`` of the result counts those made of them.

    A batch that failed is processed again by the next run, and gives the same table.

    Rows are appended by lineage: ``transform`` gets a column ``source_file`` and has to
    hand it on, and a repeated batch replaces the rows of its own files. Other ways are asked
    for by name: with ``merge_on`` a batch is merged by key with what is stored, with
    ``owner`` (a column of the files and of the rows made of them) it replaces all that
    its owners have stored, and with ``replace`` the partitions it has rows for, whoever's rows they hold.
    As each batch would replace the last one's partitions, ``replace`` takes no ``max_files``.
    """
    if sum(way is not None for way in (merge_on, owner, replace or None)) > 1:
        raise ValueError("one of merge_on, owner and replace")
    if max_files is not None and replace:
        raise ValueError("max_files makes several batches, of which each would replace the last one's partitions")
    lineage = merge_on is None and owner is None and not replace
    counts: list[int] = []

    def made(read: DataFrame) -> DataFrame:
        return as_stored(transform(read), partitions).where(F.col(partitions[0]).isNotNull())

    def write(batch: DataFrame, _: int) -> None:
        with freeing(spark):
            write_batch(batch)

    def write_batch(batch: DataFrame) -> None:
        if replace:
            counts.append(overwrite_partitions(made(batch), target, partitions).rows)
            return
        if lineage:
            rows = made(batch)
            if SOURCE_FILE not in rows.columns:
                raise ValueError(f"rows are appended by {SOURCE_FILE}, which the transform drops: keep it, or name merge_on, owner or replace")
            counts.append(append_files(rows, batch.select(SOURCE_FILE).distinct(), target, partitions))
            return
        # Read a second time for its owners only.
        read = batch if owner is None else settle(batch)
        rows = settle(made(read))
        if owner is not None:
            new, touched = replace_owned(rows, read.where(F.col(owner).isNotNull()), target, owner, partitions)
        else:
            new, touched = merge_partitions(rows, target, merge_on, latest_by, partitions)
        write_touched(new, touched, target, partitions)
        counts.append(rows.count())

    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("mode", "FAILFAST")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.json(source)
    if lineage:
        files = files.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    query = (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return Written(target, sum(counts))


def with_lineage(schema: StructType) -> StructType:
    """Schema of a table that is appended to by file."""
    return StructType([*schema.fields, StructField(SOURCE_FILE, StringType(), True)])
