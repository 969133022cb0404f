import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from strataflow.operators import dedup, joins, moments, project, reshape, stats


def rows(frame, *order):
    return [tuple(r) for r in frame.orderBy(*(order or frame.columns)).collect()]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_first_and_last_per_key(spark):
    frame = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "b"), ("b", None, "z")], "k string, t int, v string")
    assert rows(dedup.first_per_key(frame, ["k"], ["t"])) == [("a", 1, "b"), ("b", None, "z")]
    assert rows(dedup.last_per_key(frame, ["k"], ["t"])) == [("a", 2, "x"), ("b", None, "z")]


def test_dedup_limits_each_key_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(dedup.first_per_key(frame, ["k"], ["id"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_latest_value(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, t int, v string")
    assert rows(dedup.latest_value(frame, ["k"], ["t"], v="v")) == [("a", None), ("b", "y")]


@pytest.fixture
def skewed(spark):
    """Facts with one key on a third of the rows, and a lookup that misses some keys."""
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    names = [("hot", "H")] + [(f"k{i}", f"K{i}") for i in range(40)]
    return facts, spark.createDataFrame(names, "k string, label string")


@pytest.mark.parametrize("hot", [(), [("hot",)], [("hot",), ("k1",), ("nothing",)]])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_agrees_with_plain_join(skewed, how, hot):
    facts, names = skewed
    facts = facts.unionByName(facts.where("id < 50").withColumn("k", F.lit(None).cast("string")))
    expected = rows(facts.join(names, ["k"], how))
    joined = joins.lookup_join(facts, names.hint("merge"), ["k"], how, hot=hot, pieces=5)
    assert joined.columns == facts.join(names, ["k"], how).columns
    assert rows(joined) == expected
    assert rows(joins.lookup_join(facts, names, ["k"], how)) == expected


@pytest.fixture
def settings(spark):
    saved = {}

    def use(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield use
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def jobs_of(spark, build):
    """What ``build`` gives, and how many jobs it ran."""
    spark.sparkContext.setJobGroup("build", "build")
    try:
        return build(), len(spark.sparkContext.statusTracker().getJobIdsForGroup("build"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_frames_are_built_without_a_job(skewed, spark):
    facts, names = skewed
    points = facts.select("k", F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    builds = [
        lambda: joins.lookup_join(facts, names, ["k"]),
        lambda: joins.not_seen(facts, names, ["k"]),
        lambda: joins.map_keys(facts, names, key="k", values=["label"]),
        lambda: joins.with_name_key(facts, "k", "key"),
        lambda: stats.residual_outliers(points, ["k"], "x", "y", 2),
    ]
    for build in builds:
        frame, jobs = jobs_of(spark, build)
        assert jobs == 0 and frame.count() > 0


def test_run_time_size_decides_about_the_broadcast(skewed, settings):
    facts, names = skewed
    small = names.groupBy("k").agg(F.max("label").alias("label"))
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="1m")
    joined = joins.lookup_join(facts, small, ["k"])
    assert len(joined.collect()) == 3000 and "BroadcastHashJoin" in plan_of(joined).split("Initial Plan")[0]
    settings(adaptive__autoBroadcastJoinThreshold="-1")
    joined = joins.lookup_join(facts, small, ["k"])
    assert len(joined.collect()) == 3000 and "BroadcastHashJoin" not in plan_of(joined)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_a_hot_key_is_split_at_run_time(spark, settings, how):
    """Also where the right side comes dealt by the key already."""
    settings(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k", adaptive__advisoryPartitionSizeInBytes="10k",
        adaptive__skewJoin__skewedPartitionFactor="1",
    )
    facts = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    names = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    right = names.where("k % 2 = 1 or k = 8") if how == "left_anti" else names
    value = F.sum("id" if how == "left_anti" else "n").alias("n")
    total = joins.lookup_join(facts, right, ["k"], how).agg(value)
    assert total.collect() == facts.join(right, ["k"], how).agg(value).collect()
    assert "skew=true" in plan_of(total)


def test_named_keys_are_spread_and_others_stay_whole(skewed, settings):
    facts, names = skewed
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    joined = joins.lookup_join(facts, names, ["k"], hot=[("hot",)], pieces=32)
    placed = joined.select("k", F.spark_partition_id().alias("task")).groupBy("k")
    spread = {r["k"]: r["tasks"] for r in placed.agg(F.count_distinct("task").alias("tasks")).collect()}
    assert spread.pop("hot") > 4 and set(spread.values()) == {1}


def test_names_are_keyed_below_an_aggregate(spark):
    frame = spark.createDataFrame([(1, "Côte"), (2, "COTE"), (3, None), (4, "Côte"), (5, "")], "id int, name string")
    keyed = joins.with_name_key(frame, "name", "key")
    assert rows(keyed.select("id", "key")) == [(1, "cote"), (2, "cote"), (3, ""), (4, "cote"), (5, "")]
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") <= 1 or plan.index("lower(") < plan.index("Aggregate")
    assert plan.index("Aggregate") < plan.rindex("LogicalRDD")


def test_map_keys(spark):
    facts = spark.createDataFrame([("a", "own", None), ("b", "own", "B0"), ("c", "own", None)], "k string, name string, code string")
    mapping = spark.createDataFrame([("a", "A1", "Alpha"), ("a", "A1", "Alpha"), ("b", None, "Beta")], "k string, code string, name string")
    mapped = joins.map_keys(facts, mapping, key="k", values=["code", "name"]).select("k", "code", "name")
    assert rows(mapped) == [("a", "A1", "Alpha"), ("b", "B0", "Beta"), ("c", None, "own")]
    with pytest.raises(ValueError, match="\\['code'\\]"):
        joins.map_keys(facts, mapping.drop("code"), key="k", values=["code", "name"])


def test_merge_overrides(spark):
    schema = "k string, code string, name string"
    base = spark.createDataFrame([("a", "A", "Alpha", "world_bank"), ("b", "B", "Beta", None)], schema + ", source_precedence string")
    over = spark.createDataFrame([("a", "A2", None), ("z", "Z", "Zed"), (None, "N", "None")], schema)
    merged = joins.merge_overrides(base, over, key="k", values=["code", "name"])
    assert rows(merged) == [
        ("a", "A2", "Alpha", "override"), ("b", "B", "Beta", "world_bank"), ("z", "Z", "Zed", "override"),
    ]
    only = joins.merge_overrides(base.where("false"), over, key="k", values=["code", "name"])
    assert rows(only.select("k", "source_precedence")) == [("a", "override"), ("z", "override")]


def test_join_measures_and_unmatched(spark):
    left = spark.createDataFrame([("a", 1, None), ("b", 1, 2.0), ("c", 1, 3.0), ("d", 1, 4.0)], "code string, year int, gdp double")
    right = spark.createDataFrame([("a", 1, 5.0), ("b", 1, None), ("c", 2, 6.0), ("e", 1, 7.0), ("d", 1, 8.0)], "code string, year int, co2 double")
    joined = joins.join_measures(left, right, ["code", "year"], "co2")
    assert rows(joined) == [("a", 1, None, 5.0), ("d", 1, 4.0, 8.0)]
    assert rows(joins.unmatched(left, right, ["code", "year"], "co2").select("code")) == [("b",), ("c",)]
    assert "LeftOuter" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_fact_join_reuses_the_dedup_partitioning(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    left = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        pair = [dedup.first_per_key(left, ["k"], ["id"]) for _ in range(2)]
        plan = plan_of(joins.join_measures(pair[0].withColumnRenamed("id", "other"), pair[1], ["k"], "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2


def test_not_seen_keeps_null_keys_and_copies(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "id int, h string")
    seen = spark.createDataFrame([("a",), ("a",), (None,)], "h string")
    assert rows(joins.not_seen(new, seen, ["h"]).select("id")) == [(2,), (3,), (4,)]


def test_requested_years_always_appear(spark):
    found = spark.createDataFrame([(2000, 1.0), (2005, 2.0)], "year int, s double")
    assert rows(joins.for_requested([2000, 2023, 2000], found)) == [(2000, 1.0), (2023, None)]


def test_zip_cells(spark):
    frame = spark.createDataFrame(
        [(["a", "b"], ["1", "2", "3"]), (["a", "b"], ["1"]), (["a", "b", "a"], ["1", "2", "3"]), ([], ["1"])],
        "h array<string>, c array<string>",
    )
    out = [r[0] for r in frame.select(reshape.zip_cells("h", "c")).collect()]
    assert out == [{"a": "1", "b": "2"}, {"a": "1", "b": None}, {"b": "2", "a": "3"}, {}]


def test_wide_to_long_and_back(spark):
    wide = spark.createDataFrame([("a", 1.0, None), ("b", None, None), ("c", 2.0, 3.0)], "k string, x double, y double")
    long = reshape.wide_to_long(wide, ["k"], {"x": 2000, "y": 2023})
    assert rows(long) == [("a", 2000, 1.0), ("c", 2000, 2.0), ("c", 2023, 3.0)]
    back = reshape.long_to_wide(long, ["k"], {"x": 2000, "y": 2023}, value="value")
    assert rows(back) == [("a", 1.0, None), ("c", 2.0, 3.0)]


def test_align(spark):
    schema = StructType([StructField("n", IntegerType()), StructField("x", DoubleType()), StructField("s", StringType())])
    frame = spark.createDataFrame([("1", float("nan"), True), ("q", 2.0, True)], "n string, x double, extra boolean")
    aligned = project.align(frame, schema)
    assert aligned.schema == schema
    assert rows(aligned) == [(None, 2.0, None), (1, None, None)]


def test_filters(spark):
    frame = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("b", None)], "s string, y int")
    assert rows(project.drop_blank(frame, "s")) == [("a", 1), ("b", None)]
    assert rows(project.drop_null(frame, "s", "y")) == [("", 2), ("a", 1)]
    assert rows(project.year_between(frame, "y", 1, 3).select("y")) == [(2,), (3,)]
    assert rows(project.year_between(frame, "y").select("y")) == [(1,), (2,), (3,)]
    assert project.keep_expected(frame, ["y", "z", "s"]).columns == ["y", "s"]
    with pytest.raises(ValueError, match="\\['a', 'z'\\]"):
        project.require_columns(frame, ["z", "y", "a"])


def test_union_all(spark):
    one = spark.createDataFrame([(1, "a")], "x int, y string")
    two = spark.createDataFrame([(2,)], "x int")
    assert rows(project.union_all([one, two])) == [(1, "a"), (2, None)]


def brute_fit(points):
    n = len(points)
    mx, my = sum(p[0] for p in points) / n, sum(p[1] for p in points) / n
    sxx = sum((x - mx) ** 2 for x, _ in points)
    syy = sum((y - my) ** 2 for _, y in points)
    sxy = sum((x - mx) * (y - my) for x, y in points)
    slope = sxy / sxx
    return slope, my - slope * mx, sxy / math.sqrt(sxx * syy)


@pytest.fixture
def points(spark):
    draw = random.Random(7)
    data = [(2000 + i % 2, f"n{i}", draw.uniform(1, 9), draw.uniform(1, 9)) for i in range(60)]
    data += [(2000, "half", None, 3.0), (2000, "half2", 3.0, None), (2001, "nan", 4.0, None)]
    return data, spark.createDataFrame(data, "year int, name string, x double, y double")


def test_statistics_match_brute_force(points):
    data, frame = points
    fits = {r["year"]: r for r in stats.linear_fit(frame, ["year"], "x", "y").collect()}
    pearson = {r["year"]: r["pearson"] for r in stats.correlation(frame, ["year"], "x", "y").collect()}
    for year in (2000, 2001):
        pairs = [(x, y) for yr, _, x, y in data if yr == year and x is not None and y is not None]
        slope, intercept, r = brute_fit(pairs)
        fit = fits[year]
        assert fit["slope"] == pytest.approx(slope) and fit["intercept"] == pytest.approx(intercept)
        assert fit["r2"] == pytest.approx(r * r) and pearson[year] == pytest.approx(r)
        assert (fit["n"], fit["x_min"], fit["x_max"]) == (len(pairs), min(pairs)[0], max(pairs)[0])


def test_outliers_match_brute_force(points):
    data, frame = points
    found = stats.residual_outliers(frame, ["year"], "x", "y", 4)
    for year in (2000, 2001):
        pairs = [(n, x, y) for yr, n, x, y in data if yr == year and x is not None and y is not None]
        slope, intercept, _ = brute_fit([(x, y) for _, x, y in pairs])
        expected = sorted(pairs, key=lambda p: -abs(p[2] - slope * p[1] - intercept))[:4]
        ours = found.where(F.col("year") == year).orderBy("outlier_rank").collect()
        assert [r["name"] for r in ours] == [p[0] for p in expected]


def test_degenerate_groups_give_null(spark):
    frame = spark.createDataFrame(
        [(1, 1.0, 1.0), (2, 1.0, 1.0), (2, 2.0, 1.0), (3, 5.0, 1.0), (3, 5.0, 2.0), (4, None, 1.0)], "year int, x double, y double"
    )
    assert rows(stats.correlation(frame, ["year"], "x", "y")) == [(1, None), (2, None), (3, None)]
    fit = stats.linear_fit(frame, ["year"], "x", "y").select("year", "slope", "r2")
    assert rows(fit) == [(1, None, None), (2, 0.0, None), (3, None, None)]
    assert rows(stats.fit_line(stats.linear_fit(frame, ["year"], "x", "y"), ["year"], 3).select("year", "x_line", "y_line")) == [
        (2, 1.0, 1.0), (2, 1.5, 1.0), (2, 2.0, 1.0),
    ]


def test_top_lists(spark):
    frame = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 3.0), (1, "c", 3.0), (1, None, 9.0), (1, "d", None), (1, "e", 2.0)], "year int, name string, v double"
    )
    high = stats.top_n(frame, ["year"], "v", "name", 3)
    assert rows(high.select("position", "name")) == [(1, "b"), (2, "c"), (3, "e")]
    low = stats.top_n(frame, ["year"], "v", "name", 2, ascending=True)
    assert rows(stats.ranked_list(low, ["year"], "v", "name", "low")) == [(1, "a: 1.000;e: 2.000")]


def test_top_rows_takes_without_a_full_sort(spark):
    plan = plan_of(stats.top_rows(spark.range(100), [F.desc("id")], 3))
    assert "TakeOrderedAndProject" in plan


def test_merged_moments_are_those_of_all_rows(spark):
    draw = random.Random(5)
    data = [(g, 1e6 + draw.gauss(0, 1), draw.gauss(0, 1), draw.randrange(7)) for g in ("a", "b", None) for _ in range(300)]
    data += [("c", 0.1, float(i), i % 7) for i in range(50)] + [("d", float(i), 0.3, i % 7) for i in range(50)] + [("e", 1.0, 2.0, 0), ("f", None, 1.0, 1)]
    frame = spark.createDataFrame(data, "g string, x double, y double, part int")
    parts = moments.moments(frame, ["g", "part"], "x", "y")
    merged = {r["g"]: r for r in moments.fit_of(moments.merge_moments(parts, ["g"]), ["g"]).collect()}
    whole = {r["g"]: r for r in stats.linear_fit(frame, ["g"], "x", "y").collect()}
    pearson = {r["g"]: r["pearson"] for r in stats.correlation(frame, ["g"], "x", "y").collect()}
    assert set(merged) == set(whole)
    for g, row in merged.items():
        assert row["n"] == whole[g]["n"] and row["x_min"] == whole[g]["x_min"] and row["x_max"] == whole[g]["x_max"]
        for name, wanted in (("slope", whole[g]["slope"]), ("pearson", pearson[g])):
            assert (row[name] is None) == (wanted is None), (g, name)
            assert row[name] is None or math.isclose(row[name], wanted, rel_tol=1e-6, abs_tol=1e-9)
    # In two steps as in one.
    halves = moments.merge_moments(parts.where("part < 3"), ["g"]).unionByName(moments.merge_moments(parts.where("part >= 3"), ["g"]))
    again = {r["g"]: r["slope"] for r in moments.fit_of(moments.merge_moments(halves, ["g"]), ["g"]).collect()}
    assert all(math.isclose(again[g], r["slope"], rel_tol=1e-9) for g, r in merged.items() if r["slope"] is not None)


@pytest.mark.parametrize("limit", [1000, 2])
def test_top_of_wide_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(dedup, "GROUP_LIMIT", limit)
    draw = random.Random(2)
    data = [("hot" if i % 3 else draw.choice(["a", "b", None]), draw.choice([1.0, 2.0, None, 3.5]), draw.randrange(4), f"text {i % 40}") for i in range(600)]
    data += [("dup", 1.0, 1, "same")] * 30 + [("dup", 2.0, 1, "less")] * 3
    frame = spark.createDataFrame(data, "k string, x double, y int, text string").repartition(5)
    for n in (1, 7, 25):
        got = dedup.top_per_key(frame, ["k"], {"x": True, "y": False}, n, rank="at", salts=3).collect()
        for key in ("hot", "a", "b", None, "dup"):
            mine = [(r["x"], r["y"]) for r in sorted((r for r in got if r["k"] == key), key=lambda r: r["at"])]
            all_ = sorted(((x, y) for k, x, y, _ in data if k == key), key=lambda v: (v[0] is None, -(v[0] or 0), v[1]))
            assert mine == all_[:n]
            assert sorted(r["at"] for r in got if r["k"] == key) == list(range(1, min(n, len(all_)) + 1))
        whole = {}
        for row in data:
            whole[row] = whole.get(row, 0) + 1
        for row in {tuple(r)[:4] for r in got}:
            assert sum(tuple(r)[:4] == row for r in got) <= whole[row]


def test_texts_are_not_sorted(spark):
    frame = spark.range(9000).select(F.lit("hot").alias("k"), "id", F.concat(F.lit("text "), "id").alias("text"))
    top = dedup.top_per_key(frame, ["k"], {"id": True}, 5000)
    plan = top._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window" in line or "Sort [" in line]
    assert windows and not any("text#" in line for line in windows)
    assert top.agg(F.min("id"), F.count("*")).first() == (4000, 5000)


def test_missing_fields_are_rows(spark):
    frame = spark.createDataFrame([(1, '{"a":1,"b":null}'), (2, "{}"), (3, "[1]"), (4, None), (5, "no json"), (6, '{"a":1,"c":{"b":1}}')], "id int, body string")
    missing = rows(project.missing_fields(frame, "body", ["b", "a", "a"], ["id"]))
    assert missing == [(2, "a"), (2, "b"), (3, "a"), (3, "b"), (4, "a"), (4, "b"), (5, "a"), (5, "b"), (6, "b")]
