import pytest
from goldens import LANDING

from quayside.operators import check_columns, missing_columns


def test_complete_frame_passes(spark, actives_config):
    assert check_columns(spark.createDataFrame([], LANDING), actives_config) is True


def test_all_misses_in_one_error(spark, actives_config):
    df = spark.createDataFrame([], LANDING).drop("user_id", "user_latitude", "date")
    with pytest.raises(ValueError) as error:
        check_columns(df, actives_config)
    for name in ("mask: column user_id", "to_decimal: column user_latitude", "partition: column date"):
        assert name in str(error.value)


def test_names_are_case_sensitive(spark, actives_config):
    df = spark.createDataFrame([], LANDING).withColumnRenamed("user_id", "User_Id")
    with pytest.raises(ValueError, match="column user_id not present"):
        check_columns(df, actives_config)
    assert missing_columns(df, ["User_Id", "user_id"]) == ["user_id"]


def test_types_are_checked(spark, actives_config):
    schema = LANDING.replace("location_source array<string>", "location_source bigint")
    df = spark.createDataFrame([], schema.replace("user_id string", "user_id array<string>"))
    with pytest.raises(ValueError) as error:
        check_columns(df, actives_config)
    assert "location_source" in str(error.value) and "user_id" in str(error.value)


def test_no_job_is_started(spark, actives_config):
    df = spark.createDataFrame([], LANDING)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("check", "check")
    check_columns(df, actives_config)
    assert list(tracker.getJobIdsForGroup("check")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
