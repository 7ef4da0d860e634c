"""Write, audit, publish: a dataset is replaced at once, or not at all, under readers that go on reading.

Below the dataset's folder, ``versions`` has one folder for each version, never changed once written, and
``manifests`` numbered files that name a version. The manifest of the highest number says which version
is read. Publishing is the rename of one small file, so a reader sees the version before or the one
after, whole; a version that is not written to its end, or fails its audit, is never named.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.sinks.datasets import require_success, write_dataset
from quayside.sources.datasets import staged
from quayside.sources.paths import delete_folder, file_names, join_path, make_folder, path_exists, rename_new, write_text

VERSIONS, MANIFESTS = "versions", "manifests"
#: Digits of a manifest's number, so that names are in the order of numbers.
_DIGITS = 12

#: Given a version as it was written; returns what is wrong with it, or nothing.
Audit = Callable[[DataFrame], Iterable[str]]


class AuditError(Exception):
    """A version was written, but not published: its audit found something."""


class ConcurrentPublishError(Exception):
    """Another version was published meanwhile; this one was not."""


def publish(
    df: DataFrame,
    location: str,
    name: str,
    partitions: Sequence[str] = (),
    fmt: str = "parquet",
    audits: Sequence[Audit] = (),
    options: Mapping[str, str] | None = None,
) -> str:
    """Write ``df`` as a new version of a dataset, audit what was written, and make it the one that is read.

    The written version must have committed and hold as many rows as went into it; ``audits`` may ask for
    more. Raises ``AuditError`` if anything is wrong, and ``ConcurrentPublishError`` if somebody else has
    published since this call began; either way readers keep the version they have. Returns the version.
    """
    spark = df.sparkSession
    root = make_folder(spark, join_path(location, name))
    folder, manifests = (make_folder(spark, join_path(root, x)) for x in (VERSIONS, MANIFESTS))
    number = _last_manifest(spark, root) + 1
    version = uuid.uuid4().hex
    seen = Observation()
    path = write_dataset(df.observe(seen, F.count(F.lit(1)).alias("rows")), folder, version, partitions, fmt, options=options)
    rows = seen.get["rows"]
    require_success(spark, path)
    written = staged(spark, path, fmt, if_empty=df.schema)
    count = written.count()
    problems = [f"{rows} rows were written, {count} can be read"] if count != rows else []
    for audit in audits:
        problems += list(audit(written))
    if problems:
        raise AuditError(f"{name}: version {version} was not published: " + "; ".join(problems))
    _name(spark, manifests, number, {"version": version, "format": fmt, "rows": rows})
    return version


def read_published(spark: SparkSession, location: str, name: str) -> DataFrame:
    """The version that is published when this is called; later ones do not change the frame."""
    manifest = current_manifest(spark, location, name)
    return staged(spark, version_path(location, name, manifest["version"]), manifest["format"])


def current_manifest(spark: SparkSession, location: str, name: str) -> dict:
    """The manifest of the version that is read."""
    root = join_path(location, name)
    number = _last_manifest(spark, root)
    if not number:
        raise ValueError(f"no version of {name} has been published below {location}")
    return _manifest(spark, root, number)


def version_path(location: str, name: str, version: str) -> str:
    return join_path(join_path(join_path(location, name), VERSIONS), version)


def roll_back(spark: SparkSession, location: str, name: str) -> str:
    """Publish the version again that was read before the present one; returns it."""
    root = join_path(location, name)
    number = _last_manifest(spark, root)
    present = current_manifest(spark, location, name)
    for earlier in range(number - 1, 0, -1):
        manifest = _manifest(spark, root, earlier)
        if manifest["version"] != present["version"] and path_exists(spark, version_path(location, name, manifest["version"])):
            _name(spark, join_path(root, MANIFESTS), number + 1, manifest)
            return manifest["version"]
    raise ValueError(f"{name} has no earlier version")


def expire(spark: SparkSession, location: str, name: str, keep: int = 2) -> list[str]:
    """Delete all versions but the ``keep`` last published ones; returns the deleted.

    Unpublished ones go too, so no publication may be under way, and no reader may still use an old version.
    """
    if keep < 1:
        raise ValueError("the published version stays, so keep is at least 1")
    root = join_path(location, name)
    kept: list[str] = []
    for number in range(_last_manifest(spark, root), 0, -1):
        version = _manifest(spark, root, number)["version"]
        if version not in kept and len(kept) < keep:
            kept.append(version)
    gone = sorted(set(file_names(spark, join_path(root, VERSIONS))) - set(kept))
    for version in gone:
        delete_folder(spark, version_path(location, name, version))
    return gone


def _last_manifest(spark: SparkSession, root: str) -> int:
    """The highest manifest number, 0 if there is none."""
    names = file_names(spark, join_path(root, MANIFESTS))
    return max((int(x.removesuffix(".json")) for x in names if x.endswith(".json") and not x.startswith(".")), default=0)


def _manifest(spark: SparkSession, root: str, number: int) -> dict:
    path = join_path(join_path(root, MANIFESTS), f"{number:0{_DIGITS}d}.json")
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _name(spark: SparkSession, manifests: str, number: int, manifest: dict) -> None:
    """Write a manifest under a hidden name, and rename it to its number unless that is taken."""
    draft = join_path(manifests, f".{uuid.uuid4().hex}")
    write_text(spark, draft, json.dumps(manifest))
    try:
        rename_new(spark, draft, join_path(manifests, f"{number:0{_DIGITS}d}.json"))
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error):
            raise
        raise ConcurrentPublishError(f"manifest {number} was published by somebody else") from None
