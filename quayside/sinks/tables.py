"""Catalog tables: create if absent, append, load again without duplicates."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayside.functions import named
from quayside.sinks.datasets import require_success
from quayside.sources.datasets import staged
from quayside.sources.drift import file_schema
from quayside.sources.paths import refuse_mixing

LOAD_ID = "load_id"

# File formats that do not keep the column types.
UNTYPED = ("csv", "json", "text")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partitioned_by: Sequence[str] = (),
    location: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Create the table if it is absent; an existing one stays as it is."""
    columns = ", ".join(
        f"{_quoted(field.name)} {field.dataType.simpleString()}" for field in schema
    )
    statement = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}"
    if partitioned_by:
        statement += f" PARTITIONED BY ({', '.join(map(_quoted, partitioned_by))})"
    if location:
        escaped = location.replace("\\", "\\\\").replace("'", "\\'")
        statement += f" LOCATION '{escaped}'"
    spark.sql(statement)


def create_table_from_ddl(spark: SparkSession, path: str) -> None:
    """Run the CREATE TABLE statement under the key ``schema`` of a JSON file.

    Spark's VARCHAR needs a length, so one without becomes STRING.
    """
    statement = json.loads(spark.read.text(path, wholetext=True).first()[0])["schema"]
    # Quoted names and texts, at the odd places, stay as they are.
    parts = re.split(r"""('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`(?:[^`]|``)*`)""", statement)
    for k in range(0, len(parts), 2):
        parts[k] = re.sub(r"\bvarchar\b(?!\s*\()", "STRING", parts[k], flags=re.IGNORECASE)
    statement = "".join(parts).rstrip().rstrip(";")
    bare = "".join(part if k % 2 == 0 else "_" * len(part) for k, part in enumerate(parts))
    if not re.search(r"\busing\s+\w+", bare, flags=re.IGNORECASE):
        # The format stands right behind the column list.
        end, depth = len(statement), 0
        for place, sign in enumerate(bare):
            depth += (sign == "(") - (sign == ")")
            if sign == ")" and depth == 0:
                end = place + 1
                break
        statement = statement[:end] + " USING parquet" + statement[end:]
    spark.sql(statement)


def append(df: DataFrame, table: str, load_id: str | None = None) -> None:
    """Append the rows, columns matched by name.

    A ``load_id`` makes the load repeatable: the table is partitioned by the column
    ``load_id``, and loading the same id again replaces its rows instead of adding copies.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    refuse_mixing(spark, table_location(spark, table), stream=False)
    if load_id is None:
        # insertInto goes by position.
        df.select(*[named(name) for name in columns]).write.insertInto(table)
        return
    if not re.fullmatch(r"[\w.:-]+", load_id):
        raise ValueError(f"load id {load_id!r} may hold letters, digits and _ . : - only")
    if LOAD_ID not in columns:
        raise ValueError(f"table {table} has no column {LOAD_ID} to be loaded repeatably")
    rows = df.select(*[named(name) for name in columns if name != LOAD_ID])
    # A fixed partition: the overwrite is limited to it, whatever the session's overwrite mode.
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD_ID} = '{load_id}') SELECT * FROM {{rows}}",
        rows=rows,
    )


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a table's files; a view, or a table without files, raises."""
    # The details stand behind a heading; a column may have the same name.
    lines = [tuple(line) for line in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    heading = next((k for k, line in enumerate(lines) if line[0].startswith("# Detailed")), len(lines))
    found = [value for name, value, *_ in lines[heading:] if name == "Location" and value]
    if not found:
        raise ValueError(f"{table} has no location: it is a view, or keeps no files")
    return found[-1]


def load_table(
    spark: SparkSession,
    table: str,
    path: str,
    fmt: str = "parquet",
    load_id: str | None = None,
) -> None:
    """Load a staged dataset, provided that the job writing it has committed.

    Folder names carry no types, so a partition column takes that of the table: the text '007'
    stays text. Columns that only the files have keep their types there, merged over all files.
    """
    require_success(spark, path)
    wanted = {field.name: field for field in spark.table(table).schema if field.name != LOAD_ID}
    if_empty = T.StructType(list(wanted.values()))
    inside = T.StructType() if fmt.lower() in UNTYPED else file_schema(spark, path, fmt) or T.StructType()
    in_files = {field.name: field for field in inside}
    folders = [field for field in staged(spark, path, fmt, if_empty=if_empty, merge=False).schema if field.name not in in_files]
    typed = [*inside, *[wanted.get(field.name) or field for field in folders]]
    append(staged(spark, path, fmt, T.StructType(typed)), table, load_id)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
