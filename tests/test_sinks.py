import datetime
import os
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quayside.operators import cluster_for_write
from quayside.sinks import export_csv, export_parquet, require_success, write_dataset
from quayside.sources import golden_csv, staged


def files(path) -> list[Path]:
    return sorted(Path(path).rglob("part-*"))


def days(spark, numbers):
    return spark.createDataFrame([(n, n % 3) for n in numbers], "id int, day int")


def test_layout_and_overwrite(spark, tmp_path):
    path = write_dataset(days(spark, range(9)), str(tmp_path), "d", ["day"])
    assert sorted(p.name for p in Path(path).iterdir() if p.is_dir()) == ["day=0", "day=1", "day=2"]
    require_success(spark, path)
    assert write_dataset(days(spark, [1, 4]), str(tmp_path), "d", ["day"]) == path
    assert rows(staged(spark, path)) == [(1, 1), (4, 1)]


def test_same_run_twice_is_the_same_dataset(spark, tmp_path):
    for _ in range(2):
        path = write_dataset(days(spark, range(50)), str(tmp_path), "d", ["day"])
    assert rows(staged(spark, path)) == rows(days(spark, range(50)))


def test_dynamic_overwrite_keeps_other_days(spark, tmp_path):
    path = write_dataset(days(spark, range(9)), str(tmp_path), "d", ["day"])
    write_dataset(days(spark, [1]), str(tmp_path), "d", ["day"], overwrite="dynamic")
    assert rows(staged(spark, path).select("id")) == [(0,), (1,), (2,), (3,), (5,), (6,), (8,)]
    require_success(spark, path)


def test_failed_dynamic_overwrite_leaves_no_marker(spark, tmp_path):
    path = write_dataset(days(spark, range(9)), str(tmp_path), "d", ["day"])
    broken = days(spark, [1]).withColumn("id", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        write_dataset(broken, str(tmp_path), "d", ["day"], overwrite="dynamic")
    with pytest.raises(ValueError, match="success marker not found"):
        require_success(spark, path)
    assert staged(spark, path).count() == 9


def test_missing_destination_and_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError, match="destination location not found"):
        write_dataset(days(spark, [1]), str(tmp_path / "none"), "d")
    assert not (tmp_path / "none").exists()
    with pytest.raises(ValueError, match="static or dynamic"):
        write_dataset(days(spark, [1]), str(tmp_path), "d", overwrite="all")


@pytest.mark.parametrize("fmt", ["orc", "json", "csv"])
def test_destination_format(spark, tmp_path, fmt):
    path = write_dataset(days(spark, range(4)), str(tmp_path), "d", ["day"], fmt)
    assert all(f".{fmt}" in p.name for p in files(path))
    schema = days(spark, []).schema
    assert rows(staged(spark, path, fmt, schema)) == rows(days(spark, range(4)))


def test_null_and_empty_partition_values_come_back_as_null(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "id int, p string")
    path = write_dataset(df, str(tmp_path), "d", ["p"])
    assert rows(staged(spark, path)) == rows(
        spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, p string")
    )


def test_clustering_gives_one_file_per_small_folder(spark, tmp_path):
    df = spark.range(3000).repartition(6).withColumn("day", F.col("id") % 10)
    scattered = write_dataset(df, str(tmp_path), "scattered", ["day"])
    together = write_dataset(cluster_for_write(df, ["day"]), str(tmp_path), "together", ["day"])
    assert (len(files(scattered)), len(files(together))) == (60, 10)
    assert rows(staged(spark, together)) == rows(staged(spark, scattered))


def test_clustering_splits_a_hot_folder_over_tasks(spark, tmp_path):
    # Nine tenths of the rows on one day.
    df = (
        spark.range(0, 400000, 1, 8)
        .withColumn("day", F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id") % 7 + 1))
        .withColumn("text", F.sha2(F.col("id").cast("string"), 256))
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        path = write_dataset(cluster_for_write(df, ["day"]), str(tmp_path), "hot", ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = [os.path.getsize(p) for p in files(Path(path) / "day=0")]
    assert len(hot) >= 4 and max(hot) < 2 * sum(hot) / len(hot)
    assert staged(spark, path).count() == 400000


def test_no_clustering_without_adaptive_execution(spark):
    df = days(spark, range(9))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert cluster_for_write(df, ["day"]) is df
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert cluster_for_write(df, []) is df


def test_exports(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", ["F", "G"], datetime.date(2022, 11, 4)), ("2", None, None)],
        "id string, sources array<string>, day date",
    )
    export_csv(df, str(tmp_path / "csv"))
    assert rows(golden_csv(spark, str(tmp_path / "csv")).fillna("")) == [
        ("1", "F,G", "2022-11-04"), ("2", "", ""),
    ]
    export_parquet(df, str(tmp_path / "parquet"))
    assert rows(staged(spark, str(tmp_path / "parquet"))) == rows(df)
