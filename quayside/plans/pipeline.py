"""The configured job: scan, check, mask, cast, join arrays, partitioned write, validate."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.config import PipelineConfig
from quayside.functions import named
from quayside.operators.checks import check_columns
from quayside.operators.columns import (
    MASK_PREFIX,
    cast_columns,
    cluster_for_write,
    copy_partitions,
    join_arrays,
    mask_columns,
)
from quayside.operators.footers import footer_rows
from quayside.operators.json_columns import MALFORMED_PREFIX, parse_json
from quayside.operators.validate import column_report, unshared_columns
from quayside.sinks.datasets import write_dataset
from quayside.sinks.tables import UNTYPED
from quayside.sinks.versions import publish
from quayside.sources.datasets import scan, staged
from quayside.sources.paths import join_path, require_apart, require_location

log = logging.getLogger(__name__)


class ValidationError(Exception):
    """The staged data is not what the landing data should have become."""


@dataclass(frozen=True)
class PipelineRun:
    written: dict[str, int]
    report: DataFrame | None


def transform(
    df: DataFrame,
    config: PipelineConfig,
    strict: bool = False,
    drop_masked: bool = False,
    mask_key: bytes | None = None,
) -> DataFrame:
    """Mask, cast, join arrays, read JSON texts, copy partition columns: a projection, no shuffle.

    The mask hashes the value as it landed, before any cast, under ``mask_key`` if there is one.
    ``drop_masked`` removes the clear columns behind the masks.
    """
    if drop_masked:
        exposed = sorted(set(config.mask) & set(config.partition_sources))
        if exposed:
            raise ValueError(f"masked columns would show as partition values: {exposed}")
    result = (
        df.transform(mask_columns, config.mask, key=mask_key)
        .transform(cast_columns, config.casts, strict)
        .transform(join_arrays, config.join_arrays)
        .transform(parse_json, config.json)
        .transform(copy_partitions, config.partitions)
    )
    return result.drop(*[named(name) for name in config.mask]) if drop_masked else result


def run_pipeline(
    spark: SparkSession,
    config: PipelineConfig,
    *,
    schemas: Mapping[str, T.StructType | str] | None = None,
    frames: Mapping[str, DataFrame] | None = None,
    strict: bool = False,
    drop_masked: bool = False,
    mask_key: bytes | None = None,
    overwrite: str = "static",
    cluster: bool = True,
    check: bool = True,
    options: Mapping[str, str] | None = None,
    footers: bool = False,
) -> PipelineRun:
    """Run every dataset: one job that scans it once, then the counts of the validation.

    All datasets are checked before the first one is written. ``cluster`` shuffles the rows
    by output folder, which keeps files few; turn it off if they land already grouped that
    way. ``frames`` are datasets at hand already, in landing shape, which are not scanned from
    the landing zone. ``options`` go to the writer, ``footers`` to the validation, see ``validate``. Raises
    ``ValidationError`` if the staged data does not match.
    """
    landings = _landings(spark, config, schemas, frames)
    for landing in landings.values():
        check_columns(landing, config)
    require_location(spark, config.dest.path, "destination location")
    require_apart(
        spark,
        [join_path(config.source.path, name) for name in config.datasets if name not in (frames or {})],
        [join_path(config.dest.path, name) for name in config.datasets],
    )

    written = {}
    for name, landing in landings.items():
        # The shuffle comes before the masks: they are long and do not compress. The count
        # comes after it: a stage repeated because an executor is lost may not count twice.
        seen = Observation()
        rows = cluster_for_write(landing, config.partition_sources) if cluster else landing
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        result = transform(rows, config, strict, drop_masked, mask_key)
        write_dataset(
            result,
            config.dest.path,
            name,
            config.partition_names,
            config.dest.format,
            overwrite,
            options,
        )
        written[name] = seen.get["rows"]
        log.info("%s: %d rows written", name, written[name])

    if not check:
        return PipelineRun(written, None)
    # The same frames: files that have landed since then are not part of this run.
    scanned = [name for name in landings if name not in (frames or {})]
    report = _reports(spark, config, landings, drop_masked, overwrite == "dynamic", scanned if footers else None)
    lines = report.collect()
    wrong = [f"{line.dataset}.{line.column}: {line.verdict}" for line in lines if not line.ok]
    if wrong:
        raise ValidationError("; ".join(wrong))
    return PipelineRun(written, spark.createDataFrame(lines, report.schema))


def publish_run(
    spark: SparkSession,
    config: PipelineConfig,
    *,
    schemas: Mapping[str, T.StructType | str] | None = None,
    frames: Mapping[str, DataFrame] | None = None,
    strict: bool = False,
    drop_masked: bool = False,
    mask_key: bytes | None = None,
    cluster: bool = True,
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Run every dataset into a new version of it, and publish the version if it passes its validation.

    Unlike ``run_pipeline``, which replaces staged data before it is validated, readers of
    ``read_published`` keep the version before until the new one has been written whole and its report
    is right. All datasets are checked before the first is written; each is published for itself.
    Returns the versions. Raises ``AuditError`` if a version's validation finds anything.
    """
    landings = _landings(spark, config, schemas, frames)
    for landing in landings.values():
        check_columns(landing, config)
    require_location(spark, config.dest.path, "destination location")
    require_apart(
        spark,
        [join_path(config.source.path, name) for name in config.datasets if name not in (frames or {})],
        [join_path(config.dest.path, name) for name in config.datasets],
    )
    versions = {}
    for name, landing in landings.items():

        def audit(written: DataFrame, name: str = name, landing: DataFrame = landing) -> list[str]:
            expected = transform(landing, config, drop_masked=drop_masked).schema
            added = _added(config, landing, written, drop_masked)
            lines = column_report(name, landing, written, expected).where("not ok").collect()
            wrong = [f"{line.column}: {line.verdict}" for line in lines]
            return wrong + ([f"columns that nobody configured: {added}"] if added else [])

        rows = cluster_for_write(landing, config.partition_sources) if cluster else landing
        result = transform(rows, config, strict, drop_masked, mask_key)
        versions[name] = publish(
            result, config.dest.path, name, config.partition_names, config.dest.format, [audit], options
        )
        log.info("%s: version %s published", name, versions[name])
    return versions


def _added(config: PipelineConfig, landing: DataFrame, staging: DataFrame, drop_masked: bool) -> list[str]:
    """Columns in staging that the configuration does not announce."""
    announced = [MASK_PREFIX + column for column in config.mask] + config.partition_names
    announced += [MALFORMED_PREFIX + column for column, _ in config.json]
    announced += config.mask if drop_masked else ()
    return [
        column
        for column, side, known in unshared_columns(landing, staging, announced)
        if side == "staging" and not known
    ]


def validate(
    spark: SparkSession,
    config: PipelineConfig,
    *,
    schemas: Mapping[str, T.StructType | str] | None = None,
    drop_masked: bool = False,
    only_landed: bool = False,
    footers: bool = False,
) -> DataFrame:
    """The column report of all datasets, landing against staging.

    Raises at once if staging has columns that the configuration does not announce.
    ``only_landed`` counts only the partitions present in landing, for partial loads. Rows are counted
    by scans that read no column, or with ``footers``, of Parquet datasets, as their footers state them.
    """
    landings = _landings(spark, config, schemas)
    return _reports(spark, config, landings, drop_masked, only_landed, list(landings) if footers else None)


def _landings(
    spark: SparkSession,
    config: PipelineConfig,
    schemas: Mapping[str, T.StructType | str] | None,
    frames: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    schemas, frames = schemas or {}, frames or {}
    unknown = sorted(set(frames) - set(config.datasets))
    if unknown:
        raise ValueError(f"frames of datasets that nobody configured: {unknown}")
    return {
        name: frames[name]
        if name in frames
        else scan(spark, config.source.path, name, config.source.format, schemas.get(name), merge=True)
        for name in config.datasets
    }


def _reports(
    spark: SparkSession,
    config: PipelineConfig,
    landings: Mapping[str, DataFrame],
    drop_masked: bool,
    only_landed: bool,
    stated: Sequence[str] | None = None,
) -> DataFrame:
    """``stated`` names the landing datasets whose footers give the counts; None asks no footers at all."""
    reports = []
    for name, landing in landings.items():
        expected = transform(landing, config, drop_masked=drop_masked).schema
        staging = _staged(spark, config, name, landing, expected)
        added = _added(config, landing, staging, drop_masked)
        if added:
            raise ValidationError(f"{name}: columns in staging that nobody configured: {added}")
        counted = _counts_where_landed(landing, staging, config, expected) if only_landed else None
        if stated is not None and not only_landed:
            counted = _stated_counts(spark, config, name, landing, staging, name in stated)
        reports.append(column_report(name, landing, staging, expected, counted))
    return reduce(DataFrame.unionByName, reports)


def _staged(
    spark: SparkSession,
    config: PipelineConfig,
    name: str,
    landing: DataFrame,
    expected: T.StructType,
) -> DataFrame:
    """The staged dataset with the types of its files.

    Folder names carry no types: partition columns that landed as such take the expected ones.
    """
    path = join_path(config.dest.path, name)
    if config.dest.format.lower() in UNTYPED:
        return staged(spark, path, config.dest.format, expected)
    found = staged(spark, path, config.dest.format, if_empty=expected)
    landed = set(config.partition_names) & set(landing.columns)
    if not landed:
        return found
    typed = [expected[field.name] if field.name in landed else field for field in found.schema]
    return staged(spark, path, config.dest.format, T.StructType(typed))


def _stated_counts(
    spark: SparkSession, config: PipelineConfig, name: str, landing: DataFrame, staging: DataFrame, scanned: bool
) -> DataFrame:
    """One row of both counts, from the footers of the sides that are Parquet files."""
    sides = ((config.source, landing, scanned), (config.dest, staging, True))
    counts = [
        footer_rows(spark, join_path(place.path, name)).first()["rows"] if files and place.format.lower() == "parquet" else rows.count()
        for place, rows, files in sides
    ]
    return spark.createDataFrame([tuple(counts)], "src_rows long, dst_rows long")


def _counts_where_landed(
    landing: DataFrame, staging: DataFrame, config: PipelineConfig, expected: T.StructType
) -> DataFrame:
    """Landed rows, and staged rows of the partitions that ``landing`` holds: one row.

    Both sides are counted per partition in one pass each, and only the counts meet.
    """
    rows = F.count(F.lit(1))
    names = config.partition_names
    if not names:
        # One row each.
        return landing.agg(rows.alias("src_rows")).crossJoin(staging.agg(rows.alias("dst_rows")))
    keys = [f"landed_{place}" for place, _ in enumerate(names)]
    # As the folder names are read back: an empty text is null. A column that is null throughout
    # comes back without a type, and takes the expected one.
    types = {name: expected[name].dataType.simpleString() if dtype == "void" else dtype for name, dtype in staging.dtypes}
    landed = (
        transform(landing, config)
        .select(
            *[
                F.nullif(named(name).cast("string"), F.lit("")).cast(types[name]).alias(key)
                for name, key in zip(names, keys, strict=True)
            ]
        )
        .groupBy(*keys)
        .agg(rows.alias("n"))
    )
    present = staging.select(*[named(name).cast(types[name]).alias(name) for name in names])
    present = present.groupBy(*[named(name) for name in names]).agg(rows.alias("m"))
    same = [named(name).eqNullSafe(F.col(key)) for name, key in zip(names, keys, strict=True)]
    found = landed.join(present, same, "left")
    total = [F.coalesce(F.sum(x), F.lit(0)).alias(name) for x, name in (("n", "src_rows"), ("m", "dst_rows"))]
    return found.agg(*total)
