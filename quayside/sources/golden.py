"""Golden CSV files: read as text, then brought to the types of the frame under test."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import named
from quayside.sources.csv_text import read_options

UNREADABLE = "unreadable"


def golden_csv(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """All columns as text, names from the header line."""
    return spark.read.options(**read_options("csv", options)).csv(path)


def normalise_golden(
    raw: DataFrame, schema: T.StructType, date_format: str | None = None
) -> DataFrame:
    """Trim names and values, drop columns not in ``schema``, convert to its types.

    ``unreadable`` lists the columns whose text could not be converted, so that a damaged
    cell never passes for a null.
    """
    found: dict[str, str] = {}
    for name in raw.columns:
        if name.strip() in found:
            raise ValueError(f"golden file repeats the column {name.strip()}")
        found[name.strip()] = name
    missing = [field.name for field in schema if field.name not in found]
    if missing:
        raise ValueError(f"golden file lacks the columns {missing}")

    values, damaged = [], []
    for field in schema:
        text = F.trim(named(found[field.name]))
        value = _read(text, field.dataType, date_format)
        values.append(value.alias(field.name))
        damaged.append(F.when(text.isNotNull() & value.isNull(), F.lit(field.name)))
    return raw.select(*values, F.concat_ws(",", *damaged).alias(UNREADABLE))


def _read(text: Column, dtype: T.DataType, date_format: str | None) -> Column:
    if isinstance(dtype, T.NumericType):
        # Hand-edited files hold blanks inside numbers.
        return F.regexp_replace(text, r"\s+", "").try_cast(dtype)
    if isinstance(dtype, T.DateType) and date_format:
        return F.try_to_date(text, date_format)
    return text.try_cast(dtype)
