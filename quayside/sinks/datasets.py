from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayside.operators.columns import join_arrays
from quayside.sources.csv_text import writable, write_options
from quayside.sources.paths import (
    create_file,
    delete_file,
    join_path,
    refuse_mixing,
    require_location,
)

SUCCESS = "_SUCCESS"


def write_dataset(
    df: DataFrame,
    location: str,
    name: str,
    partitions: Sequence[str] = (),
    fmt: str = "parquet",
    overwrite: str = "static",
    options: Mapping[str, str] | None = None,
) -> str:
    """Replace the dataset ``name`` below ``location``, one folder per partition value.

    ``overwrite="dynamic"`` replaces only the partitions that ``df`` holds. Returns the path.
    """
    if overwrite not in ("static", "dynamic"):
        raise ValueError(f"overwrite must be static or dynamic, not {overwrite}")
    spark = df.sparkSession
    require_location(spark, location, "destination location")
    path = join_path(location, name)
    marker = join_path(path, SUCCESS)
    if overwrite == "dynamic":
        refuse_mixing(spark, path, stream=False)
        # A static overwrite removes and sets the marker itself; a dynamic one does neither.
        delete_file(spark, marker)
    (
        writable(df, fmt, partitions, options)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .options(**write_options(df, fmt, partitions, options))
        .partitionBy(*partitions)
        .format(fmt)
        .save(path)
    )
    if overwrite == "dynamic":
        create_file(spark, marker)
    return path


def require_success(spark: SparkSession, path: str) -> None:
    """Raise unless the job that wrote ``path`` has committed."""
    require_location(spark, join_path(path, SUCCESS), "success marker")


def export_csv(
    df: DataFrame, path: str, separator: str = ",", options: Mapping[str, str] | None = None
) -> None:
    """CSV with a header; array columns become delimited text, as CSV has no arrays.

    A text with a line break raises, unless ``options`` name another ``lineSep``.
    """
    arrays = [field.name for field in df.schema if isinstance(field.dataType, T.ArrayType)]
    flat = join_arrays(df, [(name, separator) for name in arrays])
    rows = writable(flat, "csv", (), options)
    rows.write.mode("overwrite").options(**write_options(flat, "csv", (), options)).csv(path)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
