"""Checks on the schema alone; none of them starts a job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quayside.config import PipelineConfig


def missing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Names the frame lacks; upper and lower case differ."""
    present = set(df.columns)
    return [name for name in names if name not in present]


def column_problems(df: DataFrame, config: PipelineConfig) -> list[tuple[str, str, str]]:
    """Configured columns that are missing or unusable: group, column, problem."""
    groups = {
        "mask": config.mask,
        "to_decimal": [name for name, _ in config.casts],
        "to_comma": [name for name, _ in config.join_arrays],
        "partition": config.partition_sources,
        "json": [name for name, _ in config.json],
    }
    problems = [
        (group, name, "not present")
        for group, names in groups.items()
        for name in missing_columns(df, names)
    ]
    present = set(df.columns)
    for name in config.mask:
        if name in present and not isinstance(df.schema[name].dataType, T.AtomicType):
            problems.append(("mask", name, "is no plain value"))
    for name in groups["to_comma"]:
        if name in present and not _joinable(df.schema[name].dataType):
            problems.append(("to_comma", name, "is neither an array of plain values nor a string"))
    for name in groups["json"]:
        if name in present and not isinstance(df.schema[name].dataType, T.StringType):
            problems.append(("json", name, "is no text"))
    return problems


def check_columns(df: DataFrame, config: PipelineConfig) -> bool:
    """True if every configured column exists with a usable type; else one error naming all."""
    if problems := column_problems(df, config):
        raise ValueError("; ".join(f"{group}: column {name} {what}" for group, name, what in problems))
    return True


def _joinable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return isinstance(dtype.elementType, T.AtomicType)
    return isinstance(dtype, T.StringType)
