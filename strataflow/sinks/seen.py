"""What was met before: the last value of each key, appended run by run and looked up by hash prefix.

Rows lie in folders by a prefix of the key's hash. A run appends a file to the folders of
its own keys and rewrites nothing; a lookup opens the folders that its keys
fall into and no others. ``compact`` folds the files of a folder into one. Digests are
shuffled as bytes, since their hex text is twice as long and hardly shrinks there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.parsing import col_of
from strataflow.operators.dedup import latest_value
from strataflow.session import discard, settle
from strataflow.sources.folders import child_files, exists, partition_values

SCHEMA = "key string, value string, seen_ts timestamp, bucket int"
BUCKETS = 256
#: In front of packed text: a digest's bytes follow, or those of the text itself.
DIGEST, TEXT = b"\x01", b"\x00"


def packed(text: Column) -> Column:
    """Text as bytes, one to one and in the same order among digests and among other texts: a SHA-1 in hex takes half its room."""
    return F.when(text.rlike("\\A[0-9a-f]{40}\\z"), F.concat(F.lit(DIGEST), F.unhex(text))).otherwise(F.concat(F.lit(TEXT), text.cast("binary")))


def unpacked(value: Column) -> Column:
    body = F.substring(value, 2, 2**31 - 1)
    return F.when(F.substring(value, 1, 1) == F.lit(DIGEST), F.lower(F.hex(body))).otherwise(body.cast("string"))


def _last(rows: DataFrame) -> DataFrame:
    """Of rows with packed keys and values the last value of each key, packed."""
    picked = rows.groupBy("key").agg(F.max(F.struct("seen_ts", "value")).alias("_last"))
    return picked.select("key", F.col("_last.value").alias("value"), F.col("_last.seen_ts").alias("seen_ts"))


class SeenKeys:
    """Last value per key under one root folder."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def bucket(self, key: Column | str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int").alias("bucket")

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("basePath", self.path).parquet(*folders)

    def is_empty(self) -> bool:
        """Whether no key was met yet."""
        return not partition_values(self.spark, self.path, "bucket")

    def _near(self, keys: DataFrame, key: Column | str) -> DataFrame:
        stored = partition_values(self.spark, self.path, "bucket")
        wanted = [str(row["bucket"]) for row in keys.select(self.bucket(key)).distinct().collect()] if stored else []
        near = self._read([stored[b] for b in sorted(wanted) if b in stored])
        return _last(near.select(packed(F.col("key")).alias("key"), packed(F.col("value")).alias("value"), "seen_ts"))

    def near(self, keys: DataFrame, key: str) -> DataFrame:
        """Last value of every key in the folders that ``keys`` fall into, which are at most ``buckets``."""
        return self._near(keys, key).select(unpacked(F.col("key")).alias("key"), unpacked(F.col("value")).alias("value"))

    def known(self, keys: DataFrame, key: str) -> DataFrame:
        """The distinct keys that were met before."""
        mine = keys.select(F.col(key).alias("key")).distinct()
        return mine.join(self.near(keys, key), "key", "left_semi")

    def changed(self, rows: DataFrame, key: Column | str, value: Column | str) -> DataFrame:
        """Rows whose key is new, or was last met with another value. A NULL key counts as new.

        A value that comes back after another one has changed, too. ``rows`` is read twice, for the
        folders to look into and for the rows, unless nothing was met yet.
        """
        if self.is_empty():
            return rows
        key, value = col_of(key), col_of(value)
        last = self._near(rows, key).select(F.col("key").alias("_seen_key"), F.col("value").alias("_seen_value"))
        joined = rows.withColumn("_packed", packed(key)).join(last, F.col("_packed") == F.col("_seen_key"), "left")
        same = F.col("_seen_key").isNotNull() & packed(value).eqNullSafe(F.col("_seen_value"))
        return joined.where(~same).drop("_packed", "_seen_key", "_seen_value")

    def add(self, rows: DataFrame, key: Column | str, value: Column | str | None = None, seen_ts: Column | None = None) -> None:
        """Append the keys of a run: one file for each folder they fall into."""
        stamped = rows.select(
            packed(col_of(key).cast("string")).alias("key"),
            packed((F.lit(None) if value is None else col_of(value)).cast("string")).alias("value"),
            (F.current_timestamp() if seen_ts is None else seen_ts).alias("seen_ts"),
        ).where(F.col("key").isNotNull())
        dealt = _last(stamped).withColumn("bucket", self.bucket(unpacked(F.col("key")))).hint("rebalance", F.col("bucket"))
        last = dealt.withColumns({name: unpacked(F.col(name)) for name in ("key", "value")})
        last.write.mode("append").option("compression", "zstd").partitionBy("bucket").parquet(self.path)

    def compact(self, files: int = 16) -> int:
        """Fold the folders with more than ``files`` files, as one job; how many there were.

        A folder is replaced by the commit of that job, so one that is cut short leaves what was there.
        """
        if not exists(self.spark, self.path):
            return 0
        full = [f for f in partition_values(self.spark, self.path, "bucket").values() if len(child_files(self.spark, f)) > files]
        if full:
            last = settle(latest_value(self._read(full), ["key", "bucket"], ["seen_ts", "value"], value="value", seen_ts="seen_ts"))
            last.select("key", "value", "seen_ts", "bucket").hint("rebalance", F.col("bucket")).write.mode("overwrite").options(
                partitionOverwriteMode="dynamic", compression="zstd"
            ).partitionBy("bucket").parquet(self.path)
            discard(last)
        return len(full)
