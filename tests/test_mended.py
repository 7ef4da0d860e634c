"""Cases that went wrong once: text partitions, CSV text, names, masks, partial loads, tables."""

from __future__ import annotations

import hmac
import json
import logging
import random

import pytest
from helpers import document, rows
from goldens import LANDING, landing

from quayside import run_pipeline
from quayside.__main__ import main
from quayside.config import parse_config
from quayside.operators import (
    bag_difference,
    decrypt_columns,
    encrypt_columns,
    enrich_join,
    except_all,
    join_arrays,
    mask_columns,
    pii_scan,
)
from quayside.operators.columns import cluster_for_write
from quayside.sinks import create_table, create_table_from_ddl, export_csv, load_table, write_dataset
from quayside.sinks.tables import table_location
from quayside.sources import golden_csv, scan

TEXTS = ["  x ", "", None, "plain", 'say "so"', "a\\", "\\", '"', ",", " ", "ends \\\"", "#no comment", "é\t中"]


def test_text_partitions_stay_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "007"), (2, "042"), (3, None)], "id int, code string")
    path = write_dataset(df, str(tmp_path), "codes", ["code"])
    create_table(spark, "codes_table", df.schema, ["code"], str(tmp_path / "table"))
    load_table(spark, "codes_table", path)
    assert rows(spark.table("codes_table")) == rows(df)


@pytest.mark.parametrize("columns", ["a string, b string", "a string"])
def test_csv_gives_back_texts(spark, tmp_path, columns):
    count = columns.count(",") + 1
    df = spark.createDataFrame([(text, "z")[:count] for text in TEXTS] + [("z", text)[:count] for text in TEXTS], columns)
    write_dataset(df, str(tmp_path), "texts", fmt="csv")
    assert rows(scan(spark, str(tmp_path), "texts", "csv", df.schema)) == rows(df)
    export_csv(df, str(tmp_path / "export"))
    assert rows(golden_csv(spark, str(tmp_path / "export"))) == rows(df)


@pytest.mark.parametrize("text", ["a\nb", "a\rb", "\u0001"])
def test_csv_refuses_what_it_cannot_give_back(spark, tmp_path, text):
    df = spark.createDataFrame([(text, 1)], "a string, b int")
    with pytest.raises(Exception, match="column a holds the end of a record"):
        write_dataset(df, str(tmp_path), "texts", fmt="csv")


def test_csv_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 1), ("c\r\nd", 2), ("\n", 3), ("", 4)], "a string, b int")
    records = {"lineSep": "\u001e"}
    write_dataset(df, str(tmp_path), "texts", fmt="csv", options=records)
    assert rows(scan(spark, str(tmp_path), "texts", "csv", df.schema, records)) == rows(df)


def test_csv_staging_keeps_empty_text(spark, tmp_path):
    source, dest = tmp_path / "landing", tmp_path / "staging"
    dest.mkdir()
    spark.createDataFrame(landing("10"), LANDING).write.parquet(str(source / "actives"))
    content = document(source, dest)
    content["transformation-dataset"]["destination"]["file-format"] = "csv"
    run = run_pipeline(spark, parse_config(content))
    assert run.report.where("not ok").count() == 0


@pytest.mark.parametrize("name", ["piece", "copy", "balance", "side", "copies", "PIECE", "Copies"])
def test_any_name_in_a_bag_difference(spark, name):
    left = spark.createDataFrame([(7, "a")] * 3 + [(8, "b")], f"`{name}` int, other string")
    right = spark.createDataFrame([(7, "a")], f"`{name}` int, other string")
    found = except_all(left, right)
    assert found.columns == [name, "other"]
    assert rows(found) == [(7, "a"), (7, "a"), (8, "b")]
    if name.lower() in ("side", "copies"):
        with pytest.raises(ValueError, match=name):
            bag_difference(left, right)
    else:
        assert bag_difference(left, right).columns == [name, "other", "side", "copies"]


def test_few_copies_are_not_dealt_out(spark, monkeypatch):
    monkeypatch.setattr("quayside.operators.compare.PIECE", 4)
    left = spark.createDataFrame([(1,)] * 11 + [(2,)] * 4 + [(3,)] * 5, "n int")
    assert rows(except_all(left, left.limit(0))) == rows(left)


def test_first_separator_wins(spark):
    df = spark.createDataFrame([(["a", "b"],)], "x array<string>")
    assert rows(join_arrays(df, [("x", ","), ("x", "|")])) == [("a,b",)]


def test_keyed_mask(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "id int, secret string")
    for key in (b"k", b"long" * 40):
        found = dict(mask_columns(df, ["id"], key=key).select("id", "masked_id").collect())
        assert found == {1: hmac.new(key, b"1", "sha256").hexdigest(), None: None}
    plan = mask_columns(df, ["id"], key=b"not to be seen")._jdf.queryExecution().toString()
    assert "not to be seen" not in plan
    assert b"not to be seen".hex() not in plan.lower()


def test_encryption_goes_both_ways(spark):
    df = spark.createDataFrame([(1, "x", 2.5), (2, None, None), (3, "x", 2.5)], "id int, a string, b double")
    key = random.Random(1).randbytes(32)
    hidden = encrypt_columns(df, ["a", "b"], key)
    values = [row.a for row in hidden.collect()]
    assert values[1] is None
    assert "x" not in values
    assert values[0] != values[2]
    assert rows(decrypt_columns(hidden, [("a", "string"), ("b", "double")], key)) == rows(df)
    with pytest.raises(Exception, match="(?i)decrypt|tag|aes"):
        decrypt_columns(hidden, [("a", "string")], bytes(32)).collect()


def test_partition_null_throughout(spark, tmp_path):
    content = document(tmp_path / "landing", tmp_path / "staging", ["x"])
    (tmp_path / "staging").mkdir()
    content["transformation-dataset"] |= {
        "masking-cols": {}, "transformation-cols": {}, "partition-cols": ["day_part", "region_part"],
    }
    df = spark.createDataFrame([(1, 1, None), (2, 2, None), (3, None, None)], "id int, day int, region string")
    run = run_pipeline(spark, parse_config(content), frames={"x": df}, overwrite="dynamic")
    assert {(row.src_rows, row.dst_rows) for row in run.report.collect()} == {(3, 3)}
    run = run_pipeline(spark, parse_config(content), frames={"x": df.where("day = 2")}, overwrite="dynamic")
    assert {(row.src_rows, row.dst_rows) for row in run.report.collect()} == {(1, 1)}
    with pytest.raises(ValueError, match="nobody configured"):
        run_pipeline(spark, parse_config(content), frames={"y": df})


def test_tables_without_a_location(spark):
    spark.createDataFrame([(1,)], "id int").createOrReplaceTempView("seen_only")
    with pytest.raises(ValueError, match="no location"):
        table_location(spark, "seen_only")


def test_quoted_texts_of_ddl_stay(spark, tmp_path, write_json):
    statement = f"CREATE TABLE told (id bigint, name varchar COMMENT 'varchar using here') LOCATION '{tmp_path / 'told'}'"
    create_table_from_ddl(spark, write_json({"schema": statement}))
    columns = {column.name: column for column in spark.catalog.listColumns("told")}
    assert columns["name"].dataType == "string"
    assert columns["name"].description == "varchar using here"


def test_no_clustering_is_logged(spark, caplog):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with caplog.at_level(logging.WARNING):
            df = spark.range(3)
            assert cluster_for_write(df, ["id"]) is df
        assert "not clustered" in caplog.text
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_personal_data(spark):
    texts = [("mail a.b@x.example.org or c@d.org",), ("+1 (017) 555-7713 and 10.0.0.1",), (None,), ("nothing",)]
    df = spark.createDataFrame(texts, "text string")
    found = {row.pattern: (row.rows, row.hits) for row in pii_scan(df).collect()}
    assert found == {"email": (1, 2), "phone": (1, 1), "ipv4": (1, 1), "card": (0, 0)}
    assert pii_scan(df.limit(0)).where("hits > 0").count() == 0
    assert pii_scan(df, []).count() == 0


def test_enrichment_with_a_hot_key(spark):
    fact = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 7, id) as key", "if(id = 5, null, id % 4) as part")
    dimension = spark.createDataFrame([(7, 0, "hot"), (8, 0, "eight"), (None, 1, "none")], "k long, p int, name string")
    found = enrich_join(fact, dimension, {"key": "k", "part": "p"}, ["name"])
    assert found.columns == ["id", "key", "part", "name"]
    assert found.count() == 3000
    assert found.where("name = 'hot'").count() == fact.where("key = 7 and part = 0").count()
    assert found.where("id = 5 and name is null").count() == 1
    with pytest.raises(ValueError, match="key"):
        enrich_join(fact, dimension.withColumnRenamed("name", "KEY"), {"key": "k"}, ["KEY"])


def test_command_line(spark, tmp_path, capsys):
    """The session of the tests is the one that the job gets."""
    source, dest = tmp_path / "landing", tmp_path / "staging"
    dest.mkdir()
    records = landing("10") + landing("20") + landing("40")
    spark.createDataFrame(records, LANDING).write.parquet(str(source / "actives"))
    config = tmp_path / "config.json"
    config.write_text(json.dumps(document(source, dest)))
    assert main([str(config), "--drop-masked"]) == 0
    staged = spark.read.parquet(str(dest / "actives"))
    assert staged.count() == 70
    assert "user_id" not in staged.columns
    assert main([str(config), "--dynamic", "--strict"]) == 0
    assert capsys.readouterr().out == ""


def test_command_line_tells_failure(spark, landed, tmp_path, monkeypatch):
    from quayside.plans.pipeline import ValidationError

    def fail(*_, **__):
        raise ValidationError("actives.user_id: records mismatched")

    config = tmp_path / "config.json"
    config.write_text(json.dumps(document(landed.source.path, landed.dest.path)))
    monkeypatch.setattr("quayside.__main__.run_pipeline", fail)
    assert main([str(config)]) == 1
