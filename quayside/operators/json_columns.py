"""Text columns that hold JSON, read by a schema; what does not fit it is kept aside."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import named

MALFORMED_PREFIX = "malformed_"
_RECORD = "malformed_record"


def parse_json(df: DataFrame, columns: Iterable[tuple[str, T.StructType | str]]) -> DataFrame:
    """Replace JSON texts in place by structs, and append ``malformed_<name>`` with what could not be read.

    A null text gives a null struct and is not malformed. Malformed are texts that are no JSON object, blank
    ones included, and objects with a field that does not fit its type: ``malformed_<name>`` then has the
    whole text, and the struct is null, so that no half-read value passes for a whole one. Fields that the
    schema does not name are left out, absent ones are null. Of text behind the object nothing is read.
    """
    for name, schema in columns:
        wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        text = named(name)
        if any(field.name.lower() == _RECORD for field in wanted):
            raise ValueError(f"the schema of column {name} may not name a field {_RECORD}")
        if MALFORMED_PREFIX + name.lower() in {column.lower() for column in df.columns}:
            raise ValueError(f"there is a column {MALFORMED_PREFIX + name} already")
        parsed, whole = _parsed(text, wanted)
        malformed = text.isNotNull() & ~whole
        df = df.select(
            *[
                F.when(whole, F.struct(*[parsed[f.name].alias(f.name) for f in wanted])).alias(name) if column == name else named(column)
                for column in df.columns
            ],
            F.when(malformed, text).alias(MALFORMED_PREFIX + name),
        )
    return df


def _parsed(text: Column, wanted: T.StructType) -> tuple[Column, Column]:
    """The struct that Spark reads, and whether it has read all of it."""
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in wanted], T.StructField(_RECORD, T.StringType())])
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RECORD})
    # A list is read as its first object otherwise, and a blank text as no record at all.
    whole = F.coalesce(F.ltrim(text, F.lit(" \t\r\n")).startswith("{") & parsed.isNotNull() & parsed[_RECORD].isNull(), F.lit(False))
    return parsed, whole


def malformed_counts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """(column, rows, malformed): for each column that ``parse_json`` has read, in one pass."""
    names = list(names)
    lines = [
        F.struct(F.lit(name).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(named(MALFORMED_PREFIX + name)).alias("malformed"))
        for name in names
    ]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, rows long, malformed long")
    return df.agg(F.array(*lines).alias("found")).select(F.inline("found"))
