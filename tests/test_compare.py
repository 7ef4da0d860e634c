from collections import Counter

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quayside.operators import bag_difference, except_all, golden_verdict, partition_profile

SCHEMA = "a int, b string, c double"

records = st.lists(
    st.tuples(
        st.sampled_from([None, 1, 2]),
        st.sampled_from([None, "", "x"]),
        st.sampled_from([None, 0.0, 1.5]),
    ),
    max_size=8,
)


def test_bag_semantics(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    right = spark.createDataFrame([(1,)], "v int")
    assert rows(except_all(left, right)) == [(1,), (2,)]
    assert rows(bag_difference(left, right)) == [
        (1, "only_in_actual", 1), (2, "only_in_actual", 1),
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=records, right=records)
def test_against_counters(spark, left, right):
    actual = spark.createDataFrame(left, SCHEMA)
    expected = spark.createDataFrame(right, SCHEMA)
    surplus, lacking = Counter(left) - Counter(right), Counter(right) - Counter(left)
    found = {(tuple(r)[:3], r.side): r.copies for r in bag_difference(actual, expected).collect()}
    assert found == {
        **{(row, "only_in_actual"): n for row, n in surplus.items()},
        **{(row, "only_in_expected"): n for row, n in lacking.items()},
    }
    assert Counter(rows(except_all(actual, expected))) == surplus
    verdict = golden_verdict(actual, expected).first()
    assert tuple(verdict) == (
        surplus.total(), lacking.total(), not surplus and not lacking,
    )


def test_column_order_does_not_matter_but_names_and_types_do(spark):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    assert golden_verdict(one, one.select("b", "a")).first().passed
    with pytest.raises(TypeError, match="a: int against bigint"):
        bag_difference(one, one.withColumn("a", one.a.cast("bigint")))
    with pytest.raises(TypeError, match="b: string against absent"):
        except_all(one, one.drop("b"))


def test_nested_columns(spark):
    one = spark.sql("SELECT array(1, 2) AS a, struct('x' AS n) AS s, map('k', 1, 'l', 2) AS m")
    other = spark.sql("SELECT array(2, 1) AS a, struct('x' AS n) AS s, map('k', 1, 'l', 2) AS m")
    assert golden_verdict(one, one).first().passed
    assert tuple(golden_verdict(one, other).first()) == (1, 1, False)


def test_a_row_repeated_very_often_is_one_record(spark):
    many = spark.range(0, 300000, 1, 8).selectExpr("'hot' AS v")
    few = spark.range(10).selectExpr("'hot' AS v")
    difference = bag_difference(many, few)
    assert rows(difference) == [("hot", "only_in_actual", 299990)]


def test_copies_beyond_one_piece_are_spread_over_tasks(spark):
    left = spark.range(0, 300000, 1, 8).selectExpr("'hot' AS v").union(
        spark.range(100).selectExpr("string(id) AS v")
    )
    right = spark.range(10).selectExpr("'hot' AS v")
    result = except_all(left, right)
    counts = {r.v: r["count"] for r in result.groupBy("v").count().collect()}
    assert counts.pop("hot") == 299990
    assert counts == {str(i): 1 for i in range(100)}
    per_task = [r.rows for r in partition_profile(result.where("v = 'hot'")).collect()]
    assert len(per_task) > 1 and max(per_task) < 299990
