from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from quayside.sources.csv_text import read_options
from quayside.sources.drift import FOOTERS, drifted_schema, merged_or_none
from quayside.sources.paths import join_path, require_location


def scan(
    spark: SparkSession,
    location: str,
    name: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    merge: bool = False,
) -> DataFrame:
    """The dataset ``name`` below ``location``, in the configured format.

    Give a schema for csv and json: without one json is read once more to guess it, and of csv
    only the header, so that all columns are text. ``merge`` looks for columns in every file of
    parquet and orc, as ``staged`` does; without it they are those of one file.
    """
    require_location(spark, location, "source location")
    path = join_path(location, name)
    require_location(spark, path, "dataset")
    reader = spark.read.format(fmt).options(**read_options(fmt, options))
    if schema is not None:
        return reader.schema(schema).load(path)
    found = reader.load(path)
    if merge and fmt.lower() in FOOTERS:
        return _with_schema(reader, path, found, drifted_schema(spark, path, fmt, found.schema))
    return found


def _with_schema(reader: DataFrameReader, path: str, found: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame as it is, or read anew where its files have other columns."""
    same = [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in schema]
    return found if same else reader.schema(schema).load(path)


def staged(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
    if_empty: T.StructType | None = None,
    merge: bool = True,
) -> DataFrame:
    """A partitioned dataset read back; filters on partition columns prune folders.

    With ``schema`` (data and partition columns) nothing is inferred: a text partition '01'
    stays text. Without it Spark infers the partition types from the folder names, and a
    dataset without files is an empty frame of the columns ``if_empty``.

    Files of parquet and orc may have drifted apart: a column of some is null in the others, and a
    type is as wide as all need. Types that no other keeps whole raise ``DriftError``. That takes a
    job over all footers; ``merge=False`` trusts that one file has the columns of all.
    """
    reader = spark.read.format(fmt).options(**read_options(fmt, options))
    if schema is not None:
        return reader.schema(schema).load(path)
    merge = merge and fmt.lower() in FOOTERS
    if merge:
        # One job, unless types differ.
        merged = spark.read.format(fmt).options(**read_options(fmt, options)).option("mergeSchema", "true")
        found = merged_or_none(merged, path)
        if found is not None:
            return found
    try:
        found = reader.load(path)
    except AnalysisException as error:
        if if_empty is None or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return reader.schema(if_empty).load(path)
    return _with_schema(reader, path, found, drifted_schema(spark, path, fmt, found.schema)) if merge else found


def union_parts(*parts: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing in a part is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
