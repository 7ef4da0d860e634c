"""Files of one dataset whose columns have drifted: added columns, and types that became wider."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

#: Formats that keep a schema in every file.
FOOTERS = ("parquet", "orc")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class DriftError(ValueError):
    """Columns of the same name whose types have no common one that keeps every value."""


def wider(one: T.DataType, other: T.DataType, name: str = "value") -> T.DataType:
    """The type that holds all values of both without loss; raises ``DriftError`` if there is none.

    Whole numbers widen to longer ones, those up to 32 bits and floats to double, decimals to more digits
    before and behind the point. Structs are merged by field, arrays and maps by element. What only text
    could hold, or what a double would round, does not widen.
    """
    if one == other:
        return one
    if isinstance(one, T.NullType) or isinstance(other, T.NullType):
        return other if isinstance(one, T.NullType) else one
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return merge_schemas([one, other], name + ".")
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        element = wider(one.elementType, other.elementType, name + "[]")
        return T.ArrayType(element, one.containsNull or other.containsNull)
    if isinstance(one, T.MapType) and isinstance(other, T.MapType):
        key, value = wider(one.keyType, other.keyType, name + ".key"), wider(one.valueType, other.valueType, name + ".value")
        return T.MapType(key, value, one.valueContainsNull or other.valueContainsNull)
    if isinstance(one, _WHOLE) and isinstance(other, _WHOLE):
        return max(one, other, key=lambda x: _WHOLE.index(type(x)))
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        scale = max(one.scale, other.scale)
        digits = max(one.precision - one.scale, other.precision - other.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    kinds = {type(one), type(other)}
    if T.DoubleType in kinds and kinds <= {T.DoubleType, T.FloatType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    raise DriftError(f"column {name}: {one.simpleString()} and {other.simpleString()} have no type that keeps both")


def merge_schemas(schemas: Sequence[T.StructType], prefix: str = "") -> T.StructType:
    """All columns in the order in which they first occur, each as wide as any of its files needs.

    Every column may be null. Names that differ in nothing but case raise, as Spark would mix them up.
    """
    types: dict[str, T.DataType] = {}
    spelled: dict[str, str] = {}
    for schema in schemas:
        for field in schema:
            known = spelled.setdefault(field.name.lower(), field.name)
            if known != field.name:
                raise DriftError(f"columns {prefix}{known} and {prefix}{field.name} differ in case only")
            before = types.get(field.name)
            types[field.name] = field.dataType if before is None else wider(before, field.dataType, prefix + field.name)
    return T.StructType([T.StructField(name, dtype) for name, dtype in types.items()])


def file_schema(spark: SparkSession, path: str, fmt: str) -> T.StructType | None:
    """The merged schema of all files below ``path``, without folder names; None if there are no files.

    Spark reads the footers as one distributed job. Only if types differ does the driver list the files;
    it halves them, in the order in which they were written, until the files of a part agree: some jobs
    for every change of type, not one for each file.
    """

    def footers(files: Sequence[str]) -> T.StructType:
        reader = spark.read.format(fmt).options(mergeSchema="true", recursiveFileLookup="true")
        return reader.load(list(files)).schema

    try:
        return merge_schemas([footers([path])])
    except (PySparkException, Py4JJavaError) as error:
        if isinstance(error, AnalysisException) and error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        if not _conflict(error):
            raise
    return merge_schemas(_agreeing(written_order(spark, path), footers))


def merged_or_none(reader: DataFrameReader, path: str) -> DataFrame | None:
    """The dataset with the columns of all its files as Spark merges them; None if it cannot, or has no files."""
    try:
        found = reader.load(path)
    except (PySparkException, Py4JJavaError) as error:
        if _conflict(error) or isinstance(error, AnalysisException) and error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
    merge_schemas([found.schema])  # raises if names differ in case only
    return found


def written_order(spark: SparkSession, path: str) -> list[str]:
    """Data files below a folder, the oldest first; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return [row.path for row in files.select("path", "modificationTime").orderBy("modificationTime", "path").collect()]


def _agreeing(files: Sequence[str], footers: Callable[[Sequence[str]], T.StructType]) -> list[T.StructType]:
    """Schemas of runs of files that Spark can merge by itself."""
    found, waiting = [], [list(files)]
    while waiting:
        some = waiting.pop()
        try:
            found.append(footers(some))
        except (PySparkException, Py4JJavaError) as error:
            if len(some) == 1 or not _conflict(error):
                raise
            half = len(some) // 2
            waiting += [some[half:], some[:half]]
    return found


def _conflict(error: Exception) -> bool:
    """Whether Spark could not merge the schemas of files; tasks and the driver say it alike."""
    return any(condition in str(error) for condition in ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE"))


def drifted_schema(spark: SparkSession, path: str, fmt: str, found: T.StructType) -> T.StructType:
    """The schema that reads a dataset whole: the merged columns of its files, then those of its folders.

    ``found`` is what Spark infers for the dataset; the types of folder columns are taken from it.
    """
    inside = file_schema(spark, path, fmt)
    if inside is None:
        return found
    names = set(inside.names)
    return T.StructType([*inside, *[field for field in found if field.name not in names]])
