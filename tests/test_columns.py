import hashlib
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from quayside.functions import bits, convert, epoch_nanos, id_text, month_text, named, pick
from quayside.operators import cast_columns, copy_partitions, join_arrays, mask_columns


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_mask_appends_hash_of_text_and_keeps_source(spark):
    df = spark.createDataFrame([("1", 5000), (None, None), ("é", 7)], "a string, b bigint")
    masked = mask_columns(df, ["a", "b"])
    assert masked.columns == ["a", "b", "masked_a", "masked_b"]
    assert [tuple(r) for r in masked.collect()] == [
        ("1", 5000, sha("1"), sha("5000")),
        (None, None, None, None),
        ("é", 7, sha("é"), sha("7")),
    ]
    assert sha("5000").startswith("0f8eb4b7")


def test_mask_can_drop_its_source(spark):
    df = spark.createDataFrame([("1", 2)], "a string, b int")
    assert mask_columns(df, ["a"], drop_source=True).columns == ["b", "masked_a"]


def test_mask_hashes_dates_binary_and_awkward_names(spark):
    df = spark.sql("SELECT date'2022-01-02' AS d, X'00FF' AS raw, 'x' AS `a.b`, 'y' AS `c``d`")
    row = mask_columns(df, ["d", "raw", "a.b", "c`d"]).first()
    assert row["masked_d"] == sha("2022-01-02")
    assert row["masked_raw"] == hashlib.sha256(b"\x00\xff").hexdigest()
    assert (row["masked_a.b"], row["masked_c`d"]) == (sha("x"), sha("y"))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cast_rounds_half_up_and_overflows_to_null(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame(
            [(-17.53461655,), (10.084638,), (200000.0,), (None,), (float("nan"),)], "v double"
        )
        result = cast_columns(df, [("v", "Decimal(12,7)")])
        assert [r.v for r in result.collect()] == [
            Decimal("-17.5346166"), Decimal("10.0846380"), None, None, None,
        ]
        assert result.schema["v"].dataType.simpleString() == "decimal(12,7)"
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_cast_at_the_edge_of_the_range(spark):
    doubles = spark.createDataFrame(
        [(99999.9999999,), (-99999.9999999,), (99999.99999999,), (100000.0,), (-1e300,),
         (float("inf"),), (float("nan"),)],
        "v double",
    )
    kept = Decimal("99999.9999999")
    assert [r.v for r in cast_columns(doubles, [("v", "decimal(12,7)")]).collect()] == [
        kept, -kept, None, None, None, None, None,
    ]
    whole = spark.createDataFrame([(99999, 2**63 - 1), (100000, -(2**63))], "v int, w bigint")
    narrow = cast_columns(whole, [("v", "decimal(12,7)"), ("w", "decimal(38,0)")])
    assert [tuple(r) for r in narrow.collect()] == [
        (Decimal(99999), Decimal(2**63 - 1)), (None, Decimal(-(2**63))),
    ]
    exact = spark.sql("SELECT 99999.99999995BD AS v UNION ALL SELECT 99999.99999994BD")
    assert rows(cast_columns(exact, [("v", "decimal(12,7)")])) == [(kept,), (None,)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_cast_names_column_and_value(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        fits = spark.createDataFrame([(1.5,), (None,)], "v double")
        assert rows(cast_columns(fits, [("v", "decimal(12,7)")], strict=True)) == [
            (Decimal("1.5000000"),), (None,),
        ]
        overflow = spark.createDataFrame([(200000.0,)], "v double")
        with pytest.raises(SparkRuntimeException, match=r"v: cannot convert 200000.0"):
            cast_columns(overflow, [("v", "decimal(12,7)")], strict=True).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_cast_takes_any_type_and_repeated_names_apply_in_turn(spark):
    df = spark.createDataFrame([("12.7", "2022-02-03", "x")], "n string, d string, z string")
    result = cast_columns(df, [("n", "double"), ("n", "int"), ("d", "date"), ("z", "int")])
    assert result.dtypes == [("n", "int"), ("d", "date"), ("z", "int")]
    row = result.first()
    assert (row.n, row.d.isoformat(), row.z) == (12, "2022-02-03", None)


def test_join_arrays_null_empty_and_separators(spark):
    df = spark.createDataFrame(
        [(["A", None, "C"], [1, 2], "s"), ([], None, None), (None, [], "t,u"), (["x,y"], [3], "")],
        "a array<string>, n array<int>, s string",
    )
    result = join_arrays(df, [("a", ","), ("n", "; "), ("s", ",")])
    assert result.columns == ["a", "n", "s"]
    assert [tuple(r) for r in result.collect()] == [
        ("A,C", "1; 2", "s"), ("", "", ""), ("", "", "t,u"), ("x,y", "3", ""),
    ]


def test_copies_go_last_and_own_columns_need_none(spark):
    df = spark.createDataFrame([("2", "x")], "month string, v string")
    result = copy_partitions(df, [("month_part", "month"), ("v", "v")])
    assert result.columns == ["month", "v", "month_part"]
    assert result.first().month_part == "2"


def test_one_projection_however_many_columns(spark):
    df = spark.range(3).select(*[F.col("id").alias(f"c{i}") for i in range(60)])
    plan = mask_columns(df, df.columns)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") <= 2


def test_scalar_functions(spark):
    df = spark.sql("SELECT timestamp_ntz'2022-03-27 02:30:00.000001' AS ts, 5L AS n, 1023L AS b")
    row = df.select(
        month_text("ts").alias("m"),
        epoch_nanos(F.col("ts")).alias("e"),
        id_text(F.col("n"), 5000).alias("i"),
        pick(F.col("n"), ["a", "b", "c"]).alias("w"),
        bits(F.col("b"), 2, 3).alias("x"),
        bits(F.col("b"), 8, 8).alias("y"),
    ).first()
    assert tuple(row) == ("3", 1648348200000001000, "5005", "c", 7, 3)


def test_epoch_nanos_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2022-07-01 00:00:00' AS ts")
        assert df.select(epoch_nanos(F.col("ts"))).first()[0] == 1656633600000000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_convert_and_named_on_dotted_columns(spark):
    df = spark.sql("SELECT '7' AS `a.b`")
    assert df.select(convert(named("a.b"), "int").alias("v")).first().v == 7
