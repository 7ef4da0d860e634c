"""Datasets whose files have drifted apart, read whole by scans, validation and loads."""

import pytest
from helpers import document, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.config import parse_config
from quayside.plans.pipeline import run_pipeline
from quayside.sinks import create_table, load_table, write_dataset
from quayside.sources import scan, staged
from quayside.sources.drift import DriftError, merge_schemas, wider, written_order


def add(df, path, part, fmt="parquet"):
    df.withColumn("part", F.lit(part)).write.mode("append").partitionBy("part").format(fmt).save(path)


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_added_and_widened_columns(spark, tmp_path, fmt):
    path = str(tmp_path / "drifted")
    add(spark.sql("select 1 a, cast(1.5 as float) f, cast(1.25 as decimal(5,2)) c, array(1, null) r, struct(1 as x) s"), path, "p", fmt)
    wide = "select 3000000000L a, 2.5D f, cast(123456.125 as decimal(12,4)) c, array(5000000000L) r, struct(2L as x, 'q' as y) s, 'new' extra"
    add(spark.sql(wide), path, "q", fmt)
    add(spark.sql("select 'other' b, 7 a"), path, "q", fmt)
    found = staged(spark, path, fmt)
    kinds = dict(found.dtypes)
    assert kinds["a"] == "bigint" and kinds["f"] == "double" and kinds["c"] == "decimal(12,4)" and kinds["r"] == "array<bigint>"
    assert kinds["s"] == "struct<x:bigint,y:string>" and found.columns[-1] == "part"
    assert sorted(row.a for row in found.collect()) == [1, 7, 3000000000]
    by_part = {(row.part, row.a): row for row in found.collect()}
    assert by_part["p", 1].extra is None and by_part["q", 3000000000].extra == "new" and by_part["q", 7].b == "other"
    assert by_part["p", 1].r == [1, None] and by_part["p", 1].s == (1, None) and by_part["q", 7].s is None
    # What one file says is all there is without the footers of the others.
    assert len(staged(spark, path, fmt, merge=False).columns) < len(found.columns)
    # The landing scan can merge too.
    assert scan(spark, str(tmp_path), "drifted", fmt, merge=True).columns == found.columns


def test_types_that_lose_values_raise(spark, tmp_path):
    path = str(tmp_path / "unsafe")
    add(spark.sql("select 1L a"), path, "p")
    add(spark.sql("select 1.5D a"), path, "q")
    with pytest.raises(DriftError, match="column a: bigint and double|column a: double and bigint"):
        staged(spark, path)


def test_other_errors_are_not_taken_for_drift(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        staged(spark, str(tmp_path / "absent"))
    (tmp_path / "empty").mkdir()
    assert staged(spark, str(tmp_path / "empty"), if_empty=T.StructType().add("a", T.IntegerType())).collect() == []


def test_nothing_changes_without_drift(spark, tmp_path):
    path = str(tmp_path / "same")
    add(spark.range(5), path, 1)
    add(spark.range(5), path, 2)
    plain, merged = staged(spark, path, merge=False), staged(spark, path)
    assert merged.schema == plain.schema and rows(merged) == rows(plain)


def test_type_pairs():
    byte, short, int_, long = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()
    assert wider(byte, long) == long and wider(int_, short) == int_
    assert wider(int_, T.DoubleType()) == T.DoubleType()
    assert wider(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.NullType(), long) == long and wider(long, T.NullType()) == long
    assert wider(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    assert wider(T.MapType(T.StringType(), int_), T.MapType(T.StringType(), long)).valueType == long
    for one, other in ((long, T.DoubleType()), (int_, T.StringType()), (T.DecimalType(38, 0), T.DecimalType(38, 2)), (T.FloatType(), int_)):
        with pytest.raises(DriftError):
            wider(one, other)
            wider(other, one)


def test_names_that_differ_in_case_raise():
    one, other = T.StructType().add("Id", T.IntegerType()), T.StructType().add("id", T.IntegerType())
    with pytest.raises(DriftError, match="differ in case"):
        merge_schemas([one, other])


def test_files_in_the_order_of_their_writing(spark, tmp_path):
    path = str(tmp_path / "ordered")
    for k in range(3):
        add(spark.range(1), path, 2 - k)
    assert [f.split("part=")[1][0] for f in written_order(spark, path)] == ["2", "1", "0"]


def test_validation_and_load_see_all_columns(spark, tmp_path):
    source, dest = tmp_path / "landing", tmp_path / "staging"
    dest.mkdir()
    body = document(source, dest, ("clicks",))
    inner = body["transformation-dataset"]
    inner["masking-cols"], inner["transformation-cols"], inner["partition-cols"] = {"mask": {}}, {}, ["day_part"]
    config = parse_config(body)
    first = spark.sql("select 1 id, 1 day")
    second = spark.sql("select 2L id, 2 day, 'x' extra")
    first.write.parquet(str(source / "clicks"))
    second.write.mode("append").parquet(str(source / "clicks"))
    run = run_pipeline(spark, config)
    lines = {line.column: line for line in run.report.collect()}
    assert set(lines) == {"id", "day", "extra"} and all(line.ok for line in lines.values())
    assert lines["id"].src_type == "bigint"

    # Two partial loads of unlike columns: the table gets both.
    path = write_dataset(first.withColumn("day_part", F.col("day")), str(dest), "loads", ["day_part"], overwrite="dynamic")
    write_dataset(second.withColumn("day_part", F.col("day")), str(dest), "loads", ["day_part"], overwrite="dynamic")
    create_table(spark, "drifted_loads", staged(spark, path).drop("day_part").schema)
    load_table(spark, "drifted_loads", path)
    assert rows(spark.table("drifted_loads")) == [(1, 1, None), (2, 2, "x")]
    spark.sql("drop table drifted_loads")
