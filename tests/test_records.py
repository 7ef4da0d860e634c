"""JSON columns and damaged records: what cannot be read is kept aside and counted."""

import dataclasses

import pytest
from helpers import document, rows
from pyspark.sql import functions as F

from quayside.config import parse_config
from quayside.operators import malformed_counts, parse_json
from quayside.operators.checks import check_columns
from quayside.plans.pipeline import run_pipeline, validate
from quayside.plans.records import land_records, rejects_path, scan_records
from quayside.sources import join_path, staged


def test_json_is_read_or_kept_aside(spark):
    texts = [
        '{"k": 1, "s": "a", "more": [1]}', '  {"k": 2}', "{}", '{"k": null}', None,
        "", " ", "null", "[]", '[{"k": 1}]', '{"k": 1', '{"k": "x"}', '{"k": 99999999999}', '{"k": 1.5}', "k: 1", '{"s": {"t": 1}}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    found = {row.id: row for row in parse_json(df, [("j", "k int, s string")]).collect()}
    assert [None if found[k].j is None else tuple(found[k].j) for k in range(5)] == [(1, "a"), (2, None), (None, None), (None, None), None]
    assert all(found[k].malformed_j is None for k in range(5))
    # A struct is text to a string field, as it stands.
    assert tuple(found[15].j) == (None, '{"t":1}') and found[15].malformed_j is None
    for k in range(5, 15):
        assert found[k].j is None and found[k].malformed_j == texts[k], texts[k]


def test_json_in_place_with_nested_types_and_counts(spark):
    df = spark.createDataFrame([('{"a": [1, 2], "b": {"c": "x"}}', "{}", 1), ("{", None, 2)], "j string, `odd.name` string, last int")
    parsed = parse_json(df, [("j", "a array<int>, b struct<c: string>"), ("odd.name", "z date")])
    assert parsed.columns == ["j", "odd.name", "last", "malformed_j", "malformed_odd.name"]
    assert parsed.select("j.a", "j.b.c").collect()[0] == ([1, 2], "x")
    assert rows(malformed_counts(parsed, ["j", "odd.name"])) == [("j", 2, 1), ("odd.name", 2, 0)]
    assert malformed_counts(parsed, []).collect() == []


def test_json_name_clashes(spark):
    df = spark.createDataFrame([("{}", "x")], "j string, malformed_j string")
    with pytest.raises(ValueError, match="already"):
        parse_json(df, [("j", "a int")])


@pytest.fixture
def files(spark, tmp_path):
    def write(name, *lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return str(tmp_path / name)

    return write


def test_csv_records(spark, files, tmp_path):
    path = files("in.csv", "id,n,day", '1,2,2024-01-01', '2,x,2024-01-01', '3,4', '4,5,2024-13-01', '5,6,2024-01-02,more', ',,', '"6 ",7,2024-01-03')
    landed = land_records(spark, path, "csv", "id string, n int, day date", str(tmp_path), "landed")
    assert (landed.read, landed.accepted_rows, landed.rejected_rows) == (7, 3, 4)
    assert [row.id for row in landed.accepted.orderBy("id").collect()] == [None, "1", "6 "]
    assert landed.accepted.columns == ["id", "n", "day"]
    assert sorted(row.damaged_record for row in landed.rejects.collect()) == ["2,x,2024-01-01", "3,4", "4,5,2024-13-01", "5,6,2024-01-02,more"]
    assert all(row.damaged_file.endswith("in.csv") for row in landed.rejects.collect())
    # The counts hold for what was written, whatever columns are read.
    assert landed.accepted.select("id").count() == 3 and landed.rejects.select("damaged_file").count() == 4
    assert staged(spark, rejects_path(landed)).count() == 4


def test_json_records(spark, files, tmp_path):
    path = files("in.json", '{"id": 1, "n": 2}', '{"id": 2, "n": "x"}', '{"id": 3', "[]", '{"id": 4}')
    landed = land_records(spark, path, "json", "id int, n int", str(tmp_path), "landed")
    assert landed.read == landed.accepted.count() + landed.rejects.count()
    assert sorted(row.id for row in landed.accepted.where("id is not null").collect()) == [1, 4]
    assert {row.damaged_record for row in landed.rejects.collect()} >= {'{"id": 2, "n": "x"}', '{"id": 3'}


def test_damage_in_columns_that_are_not_asked_for(spark, files):
    path = files("in.csv", "id,n", "1,2", "2,x")
    found = scan_records(spark, path, "csv", "id int, n int")
    assert found.select("id", F.col("damaged_record").isNotNull().alias("bad")).orderBy("id").collect() == [(1, False), (2, True)]


def test_no_records(spark, files, tmp_path):
    landed = land_records(spark, files("in.csv", "id,n"), "csv", "id int, n int", str(tmp_path), "landed")
    assert (landed.read, landed.accepted.count(), landed.rejects.count()) == (0, 0, 0)


def test_formats_and_names(spark, files):
    path = files("in.csv", "id")
    with pytest.raises(ValueError, match="only csv and json"):
        scan_records(spark, path, "parquet", "id int")
    with pytest.raises(ValueError, match="would stand beside"):
        scan_records(spark, path, "csv", "id int, rejected boolean")
    with pytest.raises(ValueError, match="not found"):
        scan_records(spark, path + "x", "csv", "id int")


def test_json_columns_of_a_configuration(spark, tmp_path):
    source, dest = tmp_path / "landing", tmp_path / "staging"
    dest.mkdir()
    body = document(source, dest, ("events",))
    inner = body["transformation-dataset"]
    inner["masking-cols"], inner["transformation-cols"], inner["partition-cols"] = {"mask": {"col1": {"name": "props"}}}, {}, ["day_part"]
    inner["json-columns"] = {"props": "k int"}
    config = parse_config(body)
    landed = spark.createDataFrame([("a", '{"k": 1}'), ("b", "{k"), ("a", None)], "day string, props string")
    landed.write.parquet(str(source / "events"))
    for footers in (False, True):
        run = run_pipeline(spark, config, footers=footers)
        lines = {line.column: line for line in run.report.collect()}
        assert lines["props"].dst_type == "struct<k:int>" and all(line.ok and line.src_rows == 3 for line in lines.values())
    staged_rows = staged(spark, str(dest / "events"))
    assert staged_rows.columns == ["day", "props", "masked_props", "malformed_props", "day_part"]
    assert rows(staged_rows.select("props.k", "malformed_props")) == [(1, None), (None, "{k"), (None, None)]
    assert staged_rows.where("masked_props is not null").count() == 2
    inner["json-columns"] = {"day": "k int", "absent": "k int"}
    wrong = spark.createDataFrame([(1, "x")], "day int, props string")
    with pytest.raises(ValueError, match="json: column absent not present; json: column day is no text"):
        check_columns(wrong, parse_config(body))


def test_validation_by_footers_sees_lost_rows(spark, landed):
    run_pipeline(spark, landed)
    assert all(line.ok and line.dst_rows == 70 for line in validate(spark, landed, footers=True).collect())
    path = join_path(landed.dest.path, "actives")
    fewer = staged(spark, path).limit(60).select("*").collect()
    schema = staged(spark, path).schema
    spark.createDataFrame(fewer, schema).write.mode("overwrite").partitionBy("month_part", "date_part").parquet(path + "-fewer")
    shorter = dataclasses.replace(landed, datasets=("actives-fewer",))
    spark.read.parquet(join_path(landed.source.path, "actives")).write.parquet(join_path(landed.source.path, "actives-fewer"))
    report = validate(spark, shorter, footers=True).collect()
    assert {(line.src_rows, line.dst_rows, line.ok) for line in report} == {(70, 60, False)}
