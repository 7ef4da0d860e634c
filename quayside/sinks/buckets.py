"""Bucketed tables: written once by key, joined as often as wanted without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from quayside.functions import named
from quayside.sinks.tables import table_location


def write_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, location: str | None = None, fmt: str = "parquet"
) -> None:
    """Write a new table whose files each hold one bucket of ``keys``, sorted by them.

    Rows are brought together by bucket first, so there is one file for each bucket and not one for each
    bucket and task. All rows of a key are in one file: choose keys without heavy hitters.
    """
    if not keys or buckets < 1:
        raise ValueError("a bucketed table needs keys and at least one bucket")
    rows = df.repartition(buckets, *[named(key) for key in keys])
    writer = rows.write.format(fmt).bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:])
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def bucketing(spark: SparkSession, table: str) -> tuple[int, tuple[str, ...]]:
    """Number of buckets and their columns; a table without buckets raises."""
    table_location(spark, table)
    lines = {row[0]: row[1] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" not in lines:
        raise ValueError(f"table {table} has no buckets")
    columns = lines["Bucket Columns"].strip("[]").split(", ")
    return int(lines["Num Buckets"]), tuple(column.strip("`") for column in columns)


def bucketed_join(spark: SparkSession, left: str, right: str, keys: Sequence[str], right_keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two bucketed tables by all their bucket columns, bucket by bucket: neither side is shuffled.

    Raises if the tables' buckets do not go together, as the join would then cost two shuffles.
    """
    for table, wanted in ((left, keys), (right, right_keys)):
        if bucketing(spark, table)[1] != tuple(wanted):
            raise ValueError(f"table {table} is bucketed by {bucketing(spark, table)[1]}, not by {tuple(wanted)}")
    numbers = bucketing(spark, left)[0], bucketing(spark, right)[0]
    if numbers[0] != numbers[1]:
        raise ValueError(f"{left} has {numbers[0]} buckets and {right} has {numbers[1]}")
    one, other = spark.table(left), spark.table(right)
    same = [one[key] == other[match] for key, match in zip(keys, right_keys, strict=True)]
    # Either side may be too large to be sent round.
    return one.hint("merge").join(other.hint("merge"), same, how)
