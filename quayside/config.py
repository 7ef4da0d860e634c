"""The pipeline configuration: one JSON document, parsed to a dataclass."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

# The keys of the configuration document.
ROOT = "transformation-dataset"
SOURCE = "source"
DESTINATION = "destination"
LOCATION = "data-location"
FORMAT = "file-format"
DATASETS = "datasets"
GOLDENS = "unit_datasets"
MASKING = "masking-cols"
MASK = "mask"
TRANSFORMATION = "transformation-cols"
TO_COMMA = "to_comma"
TO_DECIMAL = "to_decimal"
PARTITIONS = "partition-cols"
JOB_PATHS = "spark_job_path"

# Optional keys of our own: {partition name: source column}, {column of JSON texts: DDL of its fields}.
PARTITION_SOURCES = "partition-sources"
JSON_COLUMNS = "json-columns"
PARTITION_SUFFIX = "_part"

# Job paths are for whoever submits the job.
KEYS = (
    SOURCE, DESTINATION, DATASETS, GOLDENS, MASKING, TRANSFORMATION, PARTITIONS, JOB_PATHS,
    PARTITION_SOURCES, JSON_COLUMNS,
)


@dataclass(frozen=True)
class Location:
    path: str
    format: str = "parquet"


@dataclass(frozen=True)
class PipelineConfig:
    source: Location
    dest: Location
    datasets: tuple[str, ...]
    mask: tuple[str, ...] = ()
    casts: tuple[tuple[str, str], ...] = ()
    join_arrays: tuple[tuple[str, str], ...] = ()
    partitions: tuple[tuple[str, str], ...] = ()
    goldens: tuple[str, ...] = ()
    json: tuple[tuple[str, str], ...] = ()

    @property
    def partition_names(self) -> list[str]:
        return [name for name, _ in self.partitions]

    @property
    def partition_sources(self) -> list[str]:
        return [source for _, source in self.partitions]


def parse_config(document: Mapping) -> PipelineConfig:
    """Build the configuration from the decoded JSON document.

    The sections of masks, transforms and partitions must be there, if empty, and unknown keys
    raise: a mistyped section would otherwise stage clear columns without a word.
    """
    body = _need(document, ROOT, "")
    _known(document, (ROOT,), "")
    _known(body, KEYS, ROOT)
    _known(_need(body, MASKING, ROOT), (MASK,), MASKING)
    _known(_need(body, TRANSFORMATION, ROOT), (TO_COMMA, TO_DECIMAL), TRANSFORMATION)
    if not _need(body, DATASETS, ROOT):
        raise ValueError(f"configuration names no {DATASETS}")
    overrides = body.get(PARTITION_SOURCES) or {}
    return PipelineConfig(
        source=_location(body, SOURCE),
        dest=_location(body, DESTINATION),
        datasets=tuple(_need(body, DATASETS, ROOT)),
        mask=tuple(
            _need(entry, "name", MASK) for entry in _entries(body, MASKING, MASK)
        ),
        casts=tuple(
            (_need(entry, "name", TO_DECIMAL), _need(entry, "to", TO_DECIMAL))
            for entry in _entries(body, TRANSFORMATION, TO_DECIMAL)
        ),
        join_arrays=tuple(
            (_need(entry, "name", TO_COMMA), _need(entry, "to", TO_COMMA))
            for entry in _entries(body, TRANSFORMATION, TO_COMMA)
        ),
        partitions=tuple(
            (name, overrides.get(name) or name.removesuffix(PARTITION_SUFFIX))
            for name in _need(body, PARTITIONS, ROOT)
        ),
        goldens=tuple(body.get(GOLDENS) or ()),
        json=tuple(sorted((body.get(JSON_COLUMNS) or {}).items())),
    )


def read_config(spark: SparkSession, path: str) -> PipelineConfig:
    """Read the document at ``path`` with Spark, so any configured file system works."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"no configuration document at {path}")
    return parse_config(json.loads(text[0]))


def _location(body: Mapping, key: str) -> Location:
    section = _need(body, key, ROOT)
    return Location(_need(section, LOCATION, key), section.get(FORMAT) or "parquet")


def _entries(body: Mapping, section: str, group: str) -> list[Mapping]:
    """Entries of a column group in key order (col1, col10, col2); null entries vanish."""
    entries = body[section].get(group) or {}
    return [entries[key] for key in sorted(entries) if entries[key] is not None]


def _known(section: Mapping, keys: Iterable[str], where: str) -> None:
    unknown = sorted(set(section) - set(keys))
    if unknown:
        raise ValueError(f"configuration has unknown keys{' in ' + where if where else ''}: {unknown}")


def _need(section: Mapping, key: str, where: str):
    if section.get(key) is None:
        raise ValueError(f"configuration lacks {where + '.' if where else ''}{key}")
    return section[key]
