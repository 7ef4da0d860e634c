"""Landing against staging: which columns differ, and a verdict per column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIFFERENCE_SCHEMA = "column string, side string, expected boolean"


def unshared_columns(
    landing: DataFrame, staging: DataFrame, expected: Iterable[str] = ()
) -> list[tuple[str, str, bool]]:
    """Column names on one side only: name, side, and whether ``expected`` announces it."""
    expected = set(expected)
    left, right = landing.columns, staging.columns
    only_left = [(name, "landing", name in expected) for name in left if name not in set(right)]
    only_right = [(name, "staging", name in expected) for name in right if name not in set(left)]
    return only_left + only_right


def column_difference(
    landing: DataFrame, staging: DataFrame, expected: Iterable[str] = ()
) -> DataFrame:
    """The columns on one side only, as a frame."""
    rows = unshared_columns(landing, staging, expected)
    return landing.sparkSession.createDataFrame(rows, DIFFERENCE_SCHEMA)


def column_report(
    dataset: str,
    landing: DataFrame,
    staging: DataFrame,
    expected: T.StructType | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Per landing column: is it staged, do the types agree, do the row counts agree.

    ``ok`` is the verdict: rows agree and the staged type is that of ``expected``, by default
    the landing type. Two counting scans that read no column; the rest is the schema.
    ``counts`` are those made elsewhere: one row of ``src_rows`` and ``dst_rows``.
    """
    types = {field.name: field.dataType.simpleString() for field in staging.schema}
    wanted = {
        field.name: field.dataType.simpleString() for field in (expected or landing.schema)
    }
    lines = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(field.name).alias("column"),
            F.lit(field.name in types).alias("in_staging"),
            F.lit(field.dataType.simpleString()).alias("src_type"),
            F.lit(types.get(field.name)).cast("string").alias("dst_type"),
            F.lit(types.get(field.name) == field.dataType.simpleString()).alias("type_match"),
            F.lit(types.get(field.name) == wanted.get(field.name)).alias("as_expected"),
        )
        for field in landing.schema
    ]
    rows = F.count(F.lit(1))
    unknown = F.lit(None).cast("bigint")
    if counts is None:
        # Both counts on one row, without a join.
        counts = (
            landing.agg(rows.alias("src_rows"))
            .select("src_rows", unknown.alias("dst_rows"))
            .union(staging.agg(rows.alias("dst_rows")).select(unknown, "dst_rows"))
            .agg(F.max("src_rows").alias("src_rows"), F.max("dst_rows").alias("dst_rows"))
        )
    rows_match = F.col("src_rows") == F.col("dst_rows")
    verdict = F.when(~F.col("in_staging"), F.lit("column not in staging")).otherwise(
        F.concat(
            F.lit("records "), F.when(rows_match, "matched").otherwise("mismatched"),
            F.lit(", datatype "), F.when(F.col("type_match"), "matched").otherwise("mismatched"),
        )
    )
    return counts.select("src_rows", "dst_rows", F.inline(F.array(*lines))).select(
        "dataset", "column", "in_staging", "src_type", "dst_type", "type_match",
        "src_rows", "dst_rows", rows_match.alias("rows_match"),
        verdict.alias("verdict"), (rows_match & F.col("as_expected")).alias("ok"),
    )
