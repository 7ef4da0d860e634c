"""CSV that comes back as it was written: nulls, empty and blank-edged text, quotes, backslashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import named

# What a null cell is to the reader; a written text may not be equal to it.
NULL_TEXT = "\u0001"
_BOTH = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_options(fmt: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options of a format. In CSV an unquoted empty cell is null, a quoted one empty text."""
    own = {**_BOTH, "nullValue": NULL_TEXT, "emptyValue": ""} if fmt.lower() == "csv" else {}
    return own | dict(options or {})


def write_options(df: DataFrame, fmt: str, partitions: Sequence[str] = (), options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Writer options of a format."""
    own = {**_BOTH, "emptyValue": '""'} if fmt.lower() == "csv" else {}
    if own and len(df.columns) - len(partitions) == 1:
        own |= {"nullValue": NULL_TEXT, "quoteAll": "true"}  # a blank line would not be read
    return own | dict(options or {})


def writable(df: DataFrame, fmt: str, partitions: Sequence[str] = (), options: Mapping[str, str] | None = None) -> DataFrame:
    """The frame, its texts checked while they are written: what CSV cannot give back raises.

    That is the null marker, and the end of a record. Records end at line breaks, or at the
    sign given as ``lineSep`` to writer and reader, which lets texts hold line breaks.
    """
    if fmt.lower() != "csv":
        return df
    ends = (options or {}).get("lineSep")
    checked = {}
    for field in df.schema:
        if not isinstance(field.dataType, T.StringType) or field.name in partitions:
            continue
        text = named(field.name)
        broken = text.contains(ends) if ends else text.rlike("[\r\n]")
        message = f"csv: a text in column {field.name} holds the end of a record or is the null marker"
        checked[field.name] = F.when(broken | (text == NULL_TEXT), F.raise_error(F.lit(message))).otherwise(text)
    return df.withColumns(checked) if checked else df
