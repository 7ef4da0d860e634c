"""Text files whose records may be damaged: one scan, split into accepted rows and rejects."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import named
from quayside.sinks.datasets import write_dataset
from quayside.sources.csv_text import read_options
from quayside.sources.datasets import staged
from quayside.sources.paths import join_path, require_location

#: Columns beside those of the schema: the text of a damaged record, and its file.
RECORD = "damaged_record"
FILE = "damaged_file"
REJECTED = "rejected"


@dataclass(frozen=True)
class LandedRecords:
    """What became of the records of a scan; ``read == accepted_rows + rejected_rows``."""

    path: str
    accepted: DataFrame
    rejects: DataFrame
    accepted_rows: int
    rejected_rows: int

    @property
    def read(self) -> int:
        return self.accepted_rows + self.rejected_rows


def scan_records(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """The records of csv or json files by ``schema``, and beside them the text and file of damaged ones.

    Damaged is a record that is no record of the format, has too few or too many cells, or a value that
    does not fit its type; the cells that could be read are there. All cells of a record are read whatever
    columns a query wants, since Spark would otherwise not see damage in the others.
    """
    if fmt.lower() not in ("csv", "json"):
        raise ValueError(f"{fmt} files are read whole or not at all: only csv and json have single damaged records")
    require_location(spark, path, "dataset")
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    clash = sorted(f.name for f in wanted if f.name.lower() in (RECORD, FILE, REJECTED))
    if clash:
        raise ValueError(f"columns {clash} would stand beside those of damaged records")
    whole = T.StructType([*[T.StructField(f.name, f.dataType) for f in wanted], T.StructField(RECORD, T.StringType())])
    reader = spark.read.format(fmt).schema(whole).options(**read_options(fmt, options))
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).load(path)
    # Nothing of the cells, but so that the record's text needs all of them.
    cells = [named(f.name) if isinstance(f.dataType, T.AtomicType) else F.to_json(F.struct(named(f.name))) for f in wanted]
    nothing = F.left(F.xxhash64(*cells).cast("string"), F.lit(0))
    rows = rows.withColumn(RECORD, F.concat(named(RECORD), nothing))
    return rows.withColumn(FILE, F.when(named(RECORD).isNotNull(), F.input_file_name()))


def land_records(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str,
    location: str,
    name: str,
    options: Mapping[str, str] | None = None,
) -> LandedRecords:
    """Scan once, and write accepted rows and rejects as two folders of the dataset ``name`` below ``location``.

    The counts are taken while the rows are written, after no shuffle, so each record counts once. Accepted
    rows have the columns of the schema; rejects have the record's text and file besides, and no row is
    lost or in both. An earlier dataset of that name is replaced.
    """
    seen = Observation()
    rows = scan_records(spark, path, fmt, schema, options)
    marked = rows.withColumn(REJECTED, named(RECORD).isNotNull())
    damaged = named(REJECTED)
    counted = marked.observe(
        seen,
        F.count_if(~damaged).alias("accepted"),
        F.count_if(damaged).alias("rejected"),
    )
    target = write_dataset(counted, location, name, [REJECTED])
    found = staged(spark, target, schema=T.StructType([*rows.schema, T.StructField(REJECTED, T.BooleanType())]))
    accepted = found.where(~named(REJECTED)).drop(RECORD, FILE, REJECTED)
    rejects = found.where(named(REJECTED)).drop(REJECTED)
    return LandedRecords(target, accepted, rejects, seen.get["accepted"], seen.get["rejected"])


def rejects_path(records: LandedRecords) -> str:
    """The folder of the rejects alone."""
    return join_path(records.path, f"{REJECTED}=true")
