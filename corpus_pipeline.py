"""Corpus pipeline: from ``documents`` to the shards of a training set.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
and read again as the next one's docs, and what it settled on the way is deleted then, with
the docs it was made of. All but the last return the columns of ``documents``. Texts
and ids may be NULL, texts may be empty or very long, rows may repeat, tables may be empty, and further columns are
carried along, whatever their names. Ties: of linked texts without order by id the stage keeps one,
and rows are numbered by the whole row where ids are equal.

1. quality classifier: documents that it rejects go
2. SimHash near-dedup: one document of each group stays
3. benchmark decontamination: documents that hold a test item go
4. mixing: sources that fall short of their target weight are repeated, none is cut
5. sharding: every row gets a shard and a slot
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.decontaminate import drop_leaks
from strataflow.llm.mixing import mix_sources
from strataflow.llm.quality import keep_quality
from strataflow.llm.sharding import shard_documents
from strataflow.llm.simhash import drop_near_duplicates
from strataflow.registry.inputs import table
from strataflow.session import freeing, fresh_folder
from strataflow.sources.folders import remove

SHARDS = 16


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mixture, files in the order of the schedule; a row comes once an epoch of its source, each once at least."""
    packed = docs.select(F.struct("*").alias("document"), "doc_id", "source")
    at = ["slot", "place"]
    return mix_sources(packed).repartitionByRange(*at).sortWithinPartitions(*at).select("document.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs, SHARDS)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
    ("sharding", sharding),
]

#: Trained weights and fingerprints by XXH64 can't be said in SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        path = fresh_folder(spark, f"pipeline-{name}")
        with freeing(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        remove(spark, before)
        docs, before = spark.read.parquet(path), [path]
    return docs
