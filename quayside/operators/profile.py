"""Looking at a frame: counts, partitions, first rows, schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import named


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per Spark partition; empty partitions do not appear."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def preview(df: DataFrame, key: str | None = None, rows: int = 5) -> DataFrame:
    """The first rows; by ``key`` if given, else any."""
    ordered = df.orderBy(named(key)) if key else df
    return ordered.limit(rows)


def schema_report(df: DataFrame) -> DataFrame:
    """One line per column: position, name, type, and the row count of the frame."""
    columns = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
        )
        for position, field in enumerate(df.schema, start=1)
    ]
    counted = row_count(df).select(F.inline(F.array(*columns)), "rows")
    return counted.select("position", "column", "type", "rows")
