import pytest
from pyspark.sql import functions as F

from strataflow.llm.rows import join_hot

SMALL = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_shuffles(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_is_split(spark, small_shuffles, how):
    rows = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"), "id")
    one = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    joined = join_hot(rows, one, "key", how)
    sums = joined.groupBy("id").agg(F.sum("n").alias("n"))
    got = sums.collect()
    assert len(got) == 40_000
    # The key 7 also comes from the row with that id.
    assert {r["n"] for r in got} == {1, 13_335}
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan and "BroadcastHashJoin" not in plan
