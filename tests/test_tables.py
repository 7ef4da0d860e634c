import json
import uuid

import pytest
from helpers import rows
from pyspark.sql import types as T

from quayside.sinks import (
    append,
    create_table,
    create_table_from_ddl,
    load_table,
    write_dataset,
)

SCHEMA = T.StructType().add("id", "long").add("name", "string").add("odd name", "integer")


@pytest.fixture
def table(spark):
    name = "t_" + uuid.uuid4().hex
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def frame(spark, *ids):
    rows = [(5, str(i), i) for i in ids]
    return spark.createDataFrame(rows, "`odd name` int, name string, id bigint")


def test_created_once_and_appended_by_name(spark, table):
    create_table(spark, table, SCHEMA)
    append(frame(spark, 1, 2), table)
    create_table(spark, table, SCHEMA)
    append(frame(spark, 2), table)
    assert rows(spark.table(table)) == [(1, "1", 5), (2, "2", 5), (2, "2", 5)]


def test_ddl_document(spark, table, tmp_path):
    ddl = f"create table IF not EXISTS {table} (id VARCHAR,code varchar(3),at decimal(12,7),date date)"
    path = tmp_path / "ddl.json"
    path.write_text(json.dumps({"schema": ddl}))
    for _ in range(2):
        create_table_from_ddl(spark, str(path))
    assert spark.table(table).dtypes == [
        ("id", "string"), ("code", "string"), ("at", "decimal(12,7)"), ("date", "date"),
    ]


def test_load_needs_a_committed_dataset(spark, table, tmp_path):
    create_table(spark, table, SCHEMA)
    path = write_dataset(frame(spark, 1, 2), str(tmp_path), "d", ["name"])
    load_table(spark, table, path)
    (tmp_path / "d" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="success marker not found"):
        load_table(spark, table, path)
    assert spark.table(table).count() == 2


def test_loading_a_dataset_without_files(spark, table, tmp_path):
    create_table(spark, table, SCHEMA)
    load_table(spark, table, write_dataset(frame(spark), str(tmp_path), "d", ["name"]))
    assert spark.table(table).count() == 0


def test_partition_columns_outside_the_table_are_left_out(spark, table, tmp_path):
    create_table(spark, table, SCHEMA)
    df = frame(spark, 1, 2).selectExpr("*", "id AS part")
    load_table(spark, table, write_dataset(df, str(tmp_path), "d", ["part"]))
    assert rows(spark.table(table)) == [(1, "1", 5), (2, "2", 5)]


def test_repeated_load_replaces_itself_only(spark, table):
    create_table(spark, table, T.StructType(list(SCHEMA)).add("load_id", "string"), ["load_id"])
    append(frame(spark, 1, 2), table, "monday")
    append(frame(spark, 3), table, "tuesday")
    append(frame(spark, 1, 2), table, "monday")
    assert rows(spark.table(table)) == [
        (1, "1", 5, "monday"), (2, "2", 5, "monday"), (3, "3", 5, "tuesday"),
    ]


def test_load_id_is_checked(spark, table):
    create_table(spark, table, SCHEMA)
    with pytest.raises(ValueError, match="letters, digits"):
        append(frame(spark, 1), table, "x') SELECT 1 --")
    with pytest.raises(ValueError, match="no column load_id"):
        append(frame(spark, 1), table, "monday")


def test_value_out_of_range_fails_the_load(spark, table):
    create_table(spark, table, T.StructType().add("id", "integer"))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        append(spark.createDataFrame([(2**40,)], "id bigint"), table)
