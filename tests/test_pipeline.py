import dataclasses
from pathlib import Path

import pytest
from helpers import document, rows
from goldens import LANDING, landing, transformed
from pyspark.sql import functions as F

from quayside import Location, ValidationError, parse_config, run_pipeline, transform, validate
from quayside.sources import actives, staged

ALL = transformed("10") + transformed("20") + transformed("40")


def staged_rows(spark, config, name="actives"):
    return staged(spark, f"{config.dest.path}/{name}", config.dest.format)


def test_landing_to_staging(spark, landed):
    run = run_pipeline(spark, landed)
    assert run.written == {"actives": 70}
    back = staged_rows(spark, landed)
    assert back.columns[-2:] == ["month_part", "date_part"]
    assert rows(back.drop("month_part", "date_part")) == sorted(ALL, key=repr)
    assert back.where("month_part <> int(month) OR date_part <> date").isEmpty()
    report = {r.column: r for r in run.report.collect()}
    assert len(report) == 12 and all(r.ok and r.rows_match for r in report.values())
    changed = {c for c, r in report.items() if not r.type_match}
    assert changed == {"location_source", "user_latitude", "user_longitude"}
    folders = {p.name for p in (Path(landed.dest.path) / "actives").iterdir()}
    assert "month_part=2" in folders and "_SUCCESS" in folders


def test_data_files_hold_the_table_columns(spark, landed):
    run_pipeline(spark, landed)
    one = next((Path(landed.dest.path) / "actives").rglob("*.parquet"))
    assert len(spark.read.parquet(str(one)).columns) == 14


def test_running_twice_changes_nothing(spark, landed):
    run_pipeline(spark, landed)
    first = rows(staged_rows(spark, landed))
    run_pipeline(spark, landed, cluster=False)
    assert rows(staged_rows(spark, landed)) == first


def test_all_datasets_run_and_are_reported(spark, tmp_path):
    (tmp_path / "out").mkdir()
    for name, size in (("one", 30), ("two", 50)):
        actives(spark, size).write.parquet(str(tmp_path / "in" / name))
    config = parse_config(document(tmp_path / "in", tmp_path / "out", ["one", "two"]))
    run = run_pipeline(spark, config)
    assert run.written == {"one": 30, "two": 50}
    found = {(r.dataset, r.src_rows, r.dst_rows) for r in run.report.collect()}
    assert found == {("one", 30, 30), ("two", 50, 50)}


@pytest.mark.parametrize("overwrite", ["static", "dynamic"])
def test_empty_landing_gives_an_empty_dataset(spark, landed, overwrite):
    path = landed.source.path + "/actives"
    spark.createDataFrame([], LANDING).write.mode("overwrite").parquet(path)
    run = run_pipeline(spark, landed, overwrite=overwrite)
    assert run.written == {"actives": 0}
    assert {(r.src_rows, r.dst_rows, r.ok) for r in run.report.collect()} == {(0, 0, True)}


def test_nothing_is_written_if_one_dataset_is_wrong(spark, tmp_path):
    (tmp_path / "out").mkdir()
    actives(spark, 5).write.parquet(str(tmp_path / "in" / "one"))
    actives(spark, 5).drop("user_id").write.parquet(str(tmp_path / "in" / "two"))
    config = parse_config(document(tmp_path / "in", tmp_path / "out", ["one", "two"]))
    with pytest.raises(ValueError, match="user_id not present"):
        run_pipeline(spark, config)
    assert list((tmp_path / "out").iterdir()) == []


def test_destination_must_exist(spark, landed):
    away = dataclasses.replace(landed, dest=Location(landed.dest.path + "-none"))
    with pytest.raises(ValueError, match="destination location not found"):
        run_pipeline(spark, away)


def test_overwriting_the_source_is_refused(spark, landed):
    onto = dataclasses.replace(landed, dest=landed.source)
    with pytest.raises(ValueError, match="overlaps source"):
        run_pipeline(spark, onto)
    assert spark.read.parquet(landed.source.path + "/actives").count() == 70


@pytest.mark.parametrize("fmt", ["orc", "json", "csv"])
def test_destination_format_is_honoured(spark, landed, fmt):
    other = dataclasses.replace(landed, dest=Location(landed.dest.path, fmt))
    assert run_pipeline(spark, other).written == {"actives": 70}
    assert list((Path(landed.dest.path) / "actives").rglob(f"*.{fmt}"))


def test_options_reach_the_writer(spark, landed):
    run_pipeline(spark, landed, options={"compression": "zstd"})
    assert list((Path(landed.dest.path) / "actives").rglob("*.zstd.parquet"))


def test_masked_sources_can_be_dropped(spark, landed):
    run = run_pipeline(spark, landed, drop_masked=True)
    columns = staged_rows(spark, landed).columns
    assert "user_id" not in columns and "masked_user_id" in columns
    missing = {r.column for r in run.report.collect() if not r.in_staging}
    assert missing == {"user_id", "advertising_id"}


def test_dropped_source_may_not_be_a_partition(spark, landed):
    by_user = dataclasses.replace(landed, partitions=(("user_part", "user_id"),))
    with pytest.raises(ValueError, match="partition values"):
        run_pipeline(spark, by_user, drop_masked=True)


def test_strict_run_fails_on_overflow_and_lenient_nulls(spark, tmp_path):
    (tmp_path / "out").mkdir()
    df = actives(spark, 5).withColumn("user_latitude", F.lit(200000.0))
    df.write.parquet(str(tmp_path / "in" / "actives"))
    config = parse_config(document(tmp_path / "in", tmp_path / "out"))
    with pytest.raises(Exception, match="user_latitude: cannot convert 200000.0"):
        run_pipeline(spark, config, strict=True)
    run_pipeline(spark, config)
    assert staged_rows(spark, config).where("user_latitude IS NULL").count() == 5


def test_partial_load_replaces_and_counts_its_days_only(spark, landed):
    run_pipeline(spark, landed)
    records = landing("10") + landing("20") + landing("40")
    march = [record for record in records if record[-1] == "3"]
    # March lands again, with one record twice.
    again = spark.createDataFrame(march + march[:1], LANDING)
    again.write.mode("overwrite").parquet(landed.source.path + "/actives")
    count = len(march) + 1
    run = run_pipeline(spark, landed, overwrite="dynamic")
    assert run.written == {"actives": count}
    assert {(r.src_rows, r.dst_rows, r.ok) for r in run.report.collect()} == {(count, count, True)}
    assert staged_rows(spark, landed).count() == 71


def test_partial_load_with_null_and_empty_partition_values(spark, tmp_path):
    (tmp_path / "out").mkdir()
    month = F.expr("CASE WHEN int(user_id) % 3 = 0 THEN '' WHEN int(user_id) % 3 = 1 THEN month END")
    df = actives(spark, 30).withColumn("month", month)
    df.write.parquet(str(tmp_path / "in" / "actives"))
    config = parse_config(document(tmp_path / "in", tmp_path / "out"))
    run = run_pipeline(spark, config, overwrite="dynamic")
    assert {(r.src_rows, r.dst_rows) for r in run.report.collect()} == {(30, 30)}


def test_partition_by_the_column_itself(spark, landed):
    plain = dataclasses.replace(landed, partitions=(("month", "month"),))
    run = run_pipeline(spark, plain)
    assert all(r.ok for r in run.report.collect())


def test_validation_fails_on_lost_rows(spark, landed):
    run_pipeline(spark, landed)
    next((Path(landed.dest.path) / "actives").rglob("*.parquet")).unlink()
    report = validate(spark, landed)
    assert not any(r.ok for r in report.collect())


def test_validation_fails_on_a_changed_type(spark, landed):
    run_pipeline(spark, landed)
    path = landed.dest.path + "/actives"
    wrong = staged(spark, path).withColumn("user_latitude", F.col("user_latitude").cast("string"))
    wrong.write.partitionBy("month_part", "date_part").parquet(landed.dest.path + "/copy/actives")
    report = validate(spark, dataclasses.replace(landed, dest=Location(landed.dest.path + "/copy")))
    assert [r.column for r in report.collect() if not r.ok] == ["user_latitude"]


def test_validation_raises_on_a_column_nobody_configured(spark, landed):
    run_pipeline(spark, landed)
    less = dataclasses.replace(landed, mask=("user_id",))
    with pytest.raises(ValidationError, match="masked_advertising_id"):
        validate(spark, less)


def test_pruned_read(spark, landed):
    run_pipeline(spark, landed)
    one_day = staged_rows(spark, landed).where(F.col("date_part") == F.lit("2022-11-04").cast("date"))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_part" in plan
    expected = [r for r in ALL if str(r[10]) == "2022-11-04"]
    assert rows(one_day.drop("month_part", "date_part")) == sorted(expected, key=repr)


def test_transform_is_one_stage_of_native_code(spark, landed):
    df = transform(spark.read.parquet(landed.source.path + "/actives"), landed)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("*(1)") == plan.count("*(") and plan.count("Project") == 1
