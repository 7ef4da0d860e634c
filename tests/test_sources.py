import pytest
from helpers import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quayside.session import scratch_path
from quayside.sources import (
    join_path,
    normalise_golden,
    path_exists,
    require_apart,
    require_location,
    scan,
    staged,
    union_parts,
)
from quayside.sources.paths import split_location


@pytest.mark.parametrize(
    "location, name", [("s3a://b/data/", "x"), ("s3a://b/data", "x"), ("s3a://b/data//", "/x")]
)
def test_exactly_one_slash(location, name):
    assert join_path(location, name) == "s3a://b/data/x"


def test_split_location():
    assert split_location("s3://bucket/a/b.parquet") == ("bucket", "a/b.parquet")


def test_location_is_checked_before_the_read(spark, tmp_path):
    with pytest.raises(ValueError, match="source location not found"):
        scan(spark, str(tmp_path / "none"), "x")
    with pytest.raises(ValueError, match="dataset not found"):
        scan(spark, str(tmp_path), "x")
    assert path_exists(spark, str(tmp_path))
    require_location(spark, str(tmp_path), "folder")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_scan_honours_the_format(spark, tmp_path, fmt):
    schema = "id bigint, name string, v double"
    df = spark.createDataFrame([(1, "a,b", 0.5), (2, None, None)], schema)
    writer = df.write.option("header", "true") if fmt == "csv" else df.write
    writer.format(fmt).save(str(tmp_path / "data"))
    assert rows(scan(spark, str(tmp_path), "data", fmt, schema)) == rows(df)


@pytest.mark.parametrize(
    "source, target, overlaps",
    [
        ("a/x", "a/x", True),
        ("a/x", "a/x/inner", True),
        ("a/x/inner", "a/x", True),
        ("a/x", "a/y/../x", True),
        ("a/x", "a/xy", False),
        ("a/x", "b/x", False),
    ],
)
def test_overlap(spark, tmp_path, source, target, overlaps):
    paths = str(tmp_path / source), str(tmp_path) + "/" + target
    if overlaps:
        with pytest.raises(ValueError, match="overlaps"):
            require_apart(spark, [paths[0]], [paths[1]])
    else:
        require_apart(spark, [paths[0]], [paths[1]])


def test_overlap_through_a_link(spark, tmp_path):
    (tmp_path / "real").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "real")
    with pytest.raises(ValueError, match="overlaps"):
        require_apart(spark, [str(tmp_path / "real/x")], [f"file://{tmp_path}/link/x"])


def test_staged_read_types(spark, tmp_path):
    df = spark.createDataFrame([(1, "01", "2"), (2, "02", None)], "id int, p string, m string")
    path = str(tmp_path / "data")
    df.write.partitionBy("p", "m").parquet(path)
    assert staged(spark, path).dtypes == [("id", "int"), ("p", "int"), ("m", "int")]
    assert rows(staged(spark, path, schema=df.schema)) == rows(df)


def test_staged_read_without_files_is_empty(spark, tmp_path):
    (tmp_path / "data").mkdir()
    schema = spark.range(1).schema
    assert staged(spark, str(tmp_path / "data"), schema=schema).collect() == []
    assert staged(spark, str(tmp_path / "data"), if_empty=schema).columns == ["id"]
    with pytest.raises(AnalysisException):
        staged(spark, str(tmp_path / "data"))
    with pytest.raises(AnalysisException):
        staged(spark, str(tmp_path / "none"), if_empty=schema)


def test_union_aligns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2.0, 2), ("y", 2.0, 2)], "s string, v double, id int")
    assert rows(union_parts(a, b)) == rows(
        spark.createDataFrame(
            [(1, "x", None), (2, "y", 2.0), (2, "y", 2.0)], "id int, s string, v double"
        )
    )


def test_normalise_golden(spark):
    raw = spark.createDataFrame(
        [
            (" x ", "109 .1688030", "04-11-2022", None),
            (None, "-136312000", "2022-11-04", "junk"),
        ],
        "`id  ` string, v string, d string, _c3 string",
    )
    schema = spark.sql(
        "SELECT '' AS id, CAST(0 AS decimal(12,7)) AS v, current_date() AS d"
    ).schema
    result = normalise_golden(raw, schema, "dd-MM-yyyy")
    assert result.columns == ["id", "v", "d", "unreadable"]
    first, second = result.collect()
    assert (first.id, str(first.v), str(first.d), first.unreadable) == (
        "x", "109.1688030", "2022-11-04", "",
    )
    assert tuple(second) == (None, None, None, "v,d")
    with pytest.raises(ValueError, match="lacks the columns"):
        normalise_golden(raw.drop("v"), schema)
    with pytest.raises(ValueError, match="repeats the column id"):
        normalise_golden(raw.withColumn("id", F.lit("")), schema)


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(shared) and one != two
