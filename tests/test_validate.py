from helpers import rows
from pyspark.sql import functions as F

from quayside.operators import (
    column_difference,
    column_report,
    partition_profile,
    preview,
    row_count,
    schema_report,
)


def landing(spark):
    return spark.createDataFrame([(1, "x", None), (2, None, 0.5)], "a int, b string, c double")


def test_difference_sees_a_rename_although_counts_agree(spark):
    left = landing(spark)
    right = left.withColumnRenamed("b", "bb")
    assert rows(column_difference(left, right)) == [
        ("b", "landing", False), ("bb", "staging", False),
    ]
    assert rows(column_difference(left, right, ["bb"]))[1] == ("bb", "staging", True)
    assert rows(column_difference(left, left)) == []


def verdicts(report):
    return {r.column: (r.verdict, r.ok) for r in report.collect()}


def test_all_matched(spark):
    df = landing(spark)
    report = column_report("d", df, df.withColumn("extra", F.lit(1)))
    assert verdicts(report) == {c: ("records matched, datatype matched", True) for c in "abc"}
    first = report.first()
    assert (first.dataset, first.src_rows, first.dst_rows, first.rows_match) == ("d", 2, 2, True)


def test_four_ways_and_missing(spark):
    df = landing(spark)
    other = df.withColumn("c", F.col("c").cast("float")).drop("b")
    assert verdicts(column_report("d", df, other)) == {
        "a": ("records matched, datatype matched", True),
        "b": ("column not in staging", False),
        "c": ("records matched, datatype mismatched", False),
    }
    assert verdicts(column_report("d", df, other.limit(1))) == {
        "a": ("records mismatched, datatype matched", False),
        "b": ("column not in staging", False),
        "c": ("records mismatched, datatype mismatched", False),
    }


def test_rows_with_nulls_count(spark):
    df = landing(spark)
    report = column_report("d", df, df.where("b IS NOT NULL"))
    assert {(r.src_rows, r.dst_rows) for r in report.collect()} == {(2, 1)}


def test_expected_change_is_ok_but_still_reported(spark):
    df = landing(spark)
    staging = df.withColumn("c", F.col("c").cast("decimal(12,7)")).drop("b")
    report = column_report("d", df, staging, staging.schema)
    assert verdicts(report) == {
        "a": ("records matched, datatype matched", True),
        "b": ("column not in staging", True),
        "c": ("records matched, datatype mismatched", True),
    }
    wrong = df.withColumn("c", F.col("c").cast("string")).drop("b")
    assert verdicts(column_report("d", df, wrong, staging.schema))["c"][1] is False


def test_empty_staging(spark):
    df = landing(spark)
    report = column_report("d", df, df.limit(0))
    assert {(r.src_rows, r.dst_rows, r.ok) for r in report.collect()} == {(2, 0, False)}


def test_counting_reads_no_column(spark, tmp_path):
    landing(spark).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    plan = column_report("d", df, df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == 2
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_profile(spark):
    df = spark.range(0, 10, 1, 4)
    assert row_count(df).first().rows == 10
    assert sum(r.rows for r in partition_profile(df).collect()) == 10
    assert partition_profile(df).count() == 4
    assert rows(preview(df.orderBy(F.desc("id")), "id", 2)) == [(0,), (1,)]
    assert preview(df).count() == 5
    assert rows(schema_report(landing(spark))) == [
        (1, "a", "int", 2), (2, "b", "string", 2), (3, "c", "double", 2),
    ]
