"""Digest trees, verdicts by key, salted joins, buckets, footers."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quayside.operators import bag_difference, enrich_join, golden_verdict, golden_verdicts
from quayside.operators.digest_tree import tree_difference, tree_verdict
from quayside.operators.enrich import enrich_skewed, frequent_keys
from quayside.operators.footers import footer_reader, footer_rows
from quayside.plans.more_queries import _changed
from quayside.plans.queries import table
from quayside.sinks.buckets import bucketed_join, bucketing, write_bucketed

SF_DIR = "/root/testdata/sf0.001"


def told(df) -> list[str]:
    """Rows as text: a number that is none equals itself there."""
    return [repr(row) for row in rows(df)]


KINDS = "a long, b string, c array<string>, d double, e struct<x: int, y: string>, f date, g binary"


def odd_rows(seed: int, count: int) -> list[tuple]:
    draw = random.Random(seed)
    pick = draw.choice
    return [
        (pick([None, 0, 1, -1]), pick([None, "", "a", "null"]), pick([None, [], [None], ["a", None], [None, "a"]]),
         pick([None, 0.0, -0.0, float("nan"), 1.5]), pick([None, (None, "a"), (1, None), (None, None)]), None, pick([None, b"", b"\0"]))
        for _ in range(count)
    ]


@pytest.mark.parametrize("few", [0, 1 << 16])
def test_tree_finds_what_comparing_all_finds(spark, few):
    base = odd_rows(1, 400)
    other = base[5:] + base[:20] + odd_rows(2, 6)
    one, two = (spark.createDataFrame(x, KINDS).repartition(3) for x in (base, other))
    found = tree_difference(one, two, few=few)
    assert told(found.rows) == told(bag_difference(one, two))
    assert found.rows.count() > 0
    assert rows(tree_verdict(one, two)) == rows(golden_verdict(one, two))


def test_equal_bags_are_not_shuffled(spark):
    base = odd_rows(3, 300)
    one = spark.createDataFrame(base, KINDS)
    found = tree_difference(one, spark.createDataFrame(base[::-1], KINDS))
    assert found.levels == ((0, 0),) and found.rows.collect() == [] and found.rows.columns[-2:] == ["side", "copies"]
    assert tree_verdict(one, one).collect()[0].passed


def test_nulls_in_other_places_are_other_rows(spark):
    for one, two in (((None, "x"), ("x", None)), ((None, None), ("", None))):
        left, right = (spark.createDataFrame([x], "a string, b string") for x in (one, two))
        assert tree_difference(left, right).rows.count() == 2
    left, right = (spark.createDataFrame([(x,)], "c array<string>") for x in ([None, "a"], ["a", None]))
    assert tree_difference(left, right).rows.count() == 2


def test_finer_buckets_leave_out_most_rows(spark):
    many = spark.range(200_000).selectExpr("id", "id % 7 as b")
    other = many.where("id <> 77").unionAll(spark.sql("select -5L as id, 1L as b"))
    found = tree_difference(many, other, few=100)
    assert sorted(rows(found.rows)) == [(-5, 1, "only_in_expected", 1), (77, 0, "only_in_actual", 1)]
    assert len(found.levels) == 2 and found.levels[0][1] < 2000 and found.levels[1][1] < 20


def test_lines_as_registered(spark):
    lines = table(spark, SF_DIR, "lineitem")
    assert rows(tree_difference(lines, _changed(lines)).rows) == rows(bag_difference(lines, _changed(lines)))


def test_tree_on_empty_frames_and_other_columns(spark):
    none = spark.createDataFrame([], KINDS)
    some = spark.createDataFrame(odd_rows(4, 5), KINDS)
    assert tree_difference(none, none).rows.collect() == []
    assert told(tree_difference(none, some).rows) == told(bag_difference(none, some))
    with pytest.raises(TypeError, match="differ in their columns"):
        tree_difference(none, some.drop("a"))


def test_verdicts_by_key(spark):
    actual = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), ("c", 1)], "k string, v int")
    expected = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 4), ("d", 1), ("d", 1)], "k string, v int")
    found = {row.k: tuple(row[1:]) for row in golden_verdicts(actual, expected, ["k"]).collect()}
    # only in actual, only in expected, rows, passed
    assert found == {"a": (1, 0, 2, False), "b": (0, 0, 1, True), None: (0, 1, 1, False), "c": (1, 0, 1, False), "d": (0, 2, 0, False)}


def skewed(spark, rows=60_000):
    user = F.when(F.col("id") % 10 < 4, 7).when(F.col("id") % 10 == 4, None).otherwise(F.col("id") % 997)
    return spark.range(0, rows, 1, 6).select("id", user.cast("long").alias("user"), F.lit("x").alias("salt"))


def test_frequent_keys_are_found(spark):
    found = frequent_keys(skewed(spark), ["user"], 0.1, 1024)
    hot = spark.range(1).select(F.xxhash64(F.lit(7).cast("long")).alias("h")).first().h
    assert set(found) == {hot} and 24_000 <= found[hot] <= 24_000 + 60_000 * 4 / 1024
    assert frequent_keys(skewed(spark).where("user is null"), ["user"], 0.1, 1024) == {}
    with pytest.raises(ValueError, match="cannot tell"):
        frequent_keys(skewed(spark), ["user"], 0.001, 1024)


def test_salted_join_is_the_join_and_even(spark):
    fact = skewed(spark)
    users = spark.createDataFrame([(k, f"u{k}") for k in range(900)] + [(7, "again"), (None, "none")], "key long, name string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = enrich_skewed(fact, users, {"user": "key"}, ["name"])
        assert rows(found) == rows(enrich_join(fact, users, {"user": "key"}, ["name"]))

        def largest(df):
            per_task = [row.n for row in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
            return max(per_task) / sorted(per_task)[len(per_task) // 2]

        assert largest(enrich_join(fact, users, {"user": "key"}, ["name"])) > 5
        assert largest(found) < 3
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_salted_join_without_hot_keys_and_by_two_keys(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (2, None)] * 3, "k int, l string")
    side = spark.createDataFrame([(1, "a", 10), (1, "a", 11), (2, None, 12)], "k int, l string, v int")
    keys = {"k": "k", "l": "l"}
    assert rows(enrich_skewed(fact, side, keys, ["v"])) == rows(enrich_join(fact, side, keys, ["v"]))
    none = fact.limit(0)
    assert enrich_skewed(none, side, keys, ["v"]).collect() == []
    with pytest.raises(ValueError, match="already"):
        enrich_skewed(fact, side, {"k": "k"}, ["L"])


@pytest.fixture
def tables(spark, tmp_path):
    names = ["bucketed_a", "bucketed_b", "bucketed_c"]
    yield names, str(tmp_path)
    for name in names:
        spark.sql(f"drop table if exists {name}")


def test_bucketed_join_without_exchange(spark, tables):
    (a, b, c), root = tables
    left = spark.range(2000).selectExpr("id % 300 as k", "id as v")
    right = spark.range(250).selectExpr("id as m", "id * 2 as w")
    write_bucketed(left, a, ["k"], 4, f"{root}/a")
    write_bucketed(right, b, ["m"], 4, f"{root}/b")
    assert bucketing(spark, a) == (4, ("k",))
    joined = bucketed_join(spark, a, b, ["k"], ["m"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    # Grouping by the key needs none either.
    assert "Exchange" not in joined.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert rows(joined) == rows(left.join(right, left.k == right.m))
    write_bucketed(right, c, ["m"], 3)
    with pytest.raises(ValueError, match="4 buckets and .* has 3"):
        bucketed_join(spark, a, c, ["k"], ["m"])
    with pytest.raises(ValueError, match="bucketed by"):
        bucketed_join(spark, a, b, ["v"], ["m"])
    with pytest.raises(ValueError, match="needs keys"):
        write_bucketed(left, "none", [], 4)


def test_counts_from_footers(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.range(1000).selectExpr("id", "id * 0.5D as x", "cast(id as string) as t", "id % 3 as part")
    df.write.partitionBy("part").parquet(path)
    counted = footer_rows(spark, path, ["part"], extremes=["id", "x"])
    assert rows(counted) == [(0, 334, 0, 999, 0.0, 499.5), (1, 333, 1, 997, 0.5, 498.5), (2, 333, 2, 998, 1.0, 499.0)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)" in plan
    assert rows(footer_rows(spark, path)) == [(1000,)]
    with pytest.raises(ValueError, match="extremes of"):
        footer_rows(spark, path, extremes=["t"])
    # The session asked keeps its reader.
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    assert footer_reader(spark).conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
