"""Row counts and extremes of Parquet datasets from their footers, without reading a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import named

# Formats that keep the reader which has no aggregate push-down.
_V1 = "spark.sql.sources.useV1SourceList"
_PUSH = "spark.sql.parquet.aggregatePushdown"


def footer_reader(spark: SparkSession) -> SparkSession:
    """A session beside this one, with its settings, whose Parquet scans push aggregates down to the footers."""
    beside = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            beside.conf.set(key, value)
    listed = [name for name in spark.conf.get(_V1).split(",") if name and name != "parquet"]
    beside.conf.set(_V1, ",".join(listed))
    beside.conf.set(_PUSH, "true")
    return beside


def footer_rows(
    spark: SparkSession, path: str, by: Sequence[str] = (), schema: T.StructType | None = None, extremes: Sequence[str] = ()
) -> DataFrame:
    """Rows of a Parquet dataset, and the least and greatest of ``extremes``, by folder columns ``by``.

    Counts are those that the files state, so a scan that counts rows stays the independent check. Least
    and greatest come from the footers for whole numbers, floats, booleans and dates; other types raise, as
    their footers may hold cut values.
    """
    reader = footer_reader(spark).read
    df = (reader.schema(schema) if schema is not None else reader).parquet(path)
    exact = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType)
    wrong = sorted(name for name in extremes if not isinstance(df.schema[name].dataType, exact))
    if wrong:
        raise ValueError(f"footers do not state the extremes of {wrong}")
    found = [F.count(F.lit(1)).alias("rows")]
    for name in extremes:
        found += [F.min(named(name)).alias(f"least_{name}"), F.max(named(name)).alias(f"greatest_{name}")]
    return df.groupBy(*[named(name) for name in by]).agg(*found) if by else df.agg(*found)
