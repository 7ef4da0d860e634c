import pytest
from helpers import document

from quayside.config import Location, parse_config, read_config


def test_all_sections(spark, write_json):
    content = document("s3a://landing/data/", "s3a://staging/data/")
    content["transformation-dataset"]["unit_datasets"] = ["10.csv", "20.csv"]
    config = read_config(spark, write_json(content))
    assert config.source == Location("s3a://landing/data/", "parquet")
    assert config.dest == Location("s3a://staging/data/", "parquet")
    assert config.datasets == ("actives",)
    assert config.mask == ("advertising_id", "user_id")
    assert config.casts == (
        ("user_latitude", "Decimal(12,7)"),
        ("user_longitude", "Decimal(12,7)"),
    )
    assert config.join_arrays == (("location_source", ","),)
    assert config.partitions == (("month_part", "month"), ("date_part", "date"))
    assert config.goldens == ("10.csv", "20.csv")


def test_entries_in_key_order_and_null_entries_vanish():
    content = document("a", "b")
    content["transformation-dataset"]["masking-cols"]["mask"] = {
        "col2": {"name": "second"},
        "col10": {"name": "tenth"},
        "col3": None,
        "col1": {"name": "first"},
    }
    assert parse_config(content).mask == ("first", "tenth", "second")


def test_partition_sources_can_be_named():
    content = document("a", "b")
    body = content["transformation-dataset"]
    body["partition-cols"] = ["day", "state_part", "month"]
    body["partition-sources"] = {"day": "date"}
    assert parse_config(content).partitions == (
        ("day", "date"), ("state_part", "state"), ("month", "month"),
    )


def test_sections_may_be_empty():
    content = document("a", "b")
    content["transformation-dataset"] |= {
        "masking-cols": {}, "transformation-cols": {"to_comma": {}}, "partition-cols": [],
    }
    config = parse_config(content)
    assert (config.mask, config.casts, config.join_arrays, config.partitions) == ((), (), (), ())


@pytest.mark.parametrize(
    ("section", "wrong"),
    [(None, "mask-cols"), ("masking-cols", "masks"), ("transformation-cols", "to_decimals")],
)
def test_unknown_keys_are_named(section, wrong):
    content = document("a", "b")
    body = content["transformation-dataset"]
    (body[section] if section else body)[wrong] = {"col1": {"name": "user_id"}}
    with pytest.raises(ValueError, match=wrong):
        parse_config(content)


def test_job_paths_are_known():
    content = document("a", "b")
    content["transformation-dataset"]["spark_job_path"] = ["job.py"]
    assert parse_config(content).datasets == ("actives",)


def test_no_datasets():
    with pytest.raises(ValueError, match="datasets"):
        parse_config(document("a", "b", datasets=()))


@pytest.mark.parametrize(
    "key",
    ["source", "destination", "datasets", "masking-cols", "transformation-cols", "partition-cols"],
)
def test_missing_section_is_named(key):
    content = document("a", "b")
    del content["transformation-dataset"][key]
    with pytest.raises(ValueError, match=key):
        parse_config(content)


def test_entry_without_target_is_named():
    content = document("a", "b")
    del content["transformation-dataset"]["transformation-cols"]["to_comma"]["col1"]["to"]
    with pytest.raises(ValueError, match="to_comma.to"):
        parse_config(content)
