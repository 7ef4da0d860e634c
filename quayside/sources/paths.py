"""Locations on any file system that Spark's Hadoop configuration knows.

The checks ask Hadoop through the session's JVM, so they need a classic session, not Spark Connect.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

# Different schemes that reach the same objects.
_SAME_STORE = {"s3a": "s3", "s3n": "s3"}

# Where Spark's file sink keeps the list of its files.
STREAM_LOG = "_spark_metadata"


def join_path(location: str, name: str) -> str:
    """Location and name joined by exactly one slash."""
    return location.rstrip("/") + "/" + name.lstrip("/")


def split_location(uri: str) -> tuple[str, str]:
    """Container and key of ``scheme://container/key``."""
    parts = urlsplit(uri)
    return parts.netloc, parts.path.lstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.exists(hadoop_path)


def require_location(spark: SparkSession, path: str, what: str) -> None:
    if not path_exists(spark, path):
        raise ValueError(f"{what} not found: {path}")


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.getContentSummary(hadoop_path).getLength()


def make_folder(spark: SparkSession, path: str) -> str:
    file_system, hadoop_path = _resolve(spark, path)
    file_system.mkdirs(hadoop_path)
    return path


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file, unless one is there."""
    file_system, hadoop_path = _resolve(spark, path)
    if not file_system.exists(hadoop_path):
        file_system.create(hadoop_path).close()


def delete_file(spark: SparkSession, path: str) -> None:
    """Delete one file if it is there; never a folder with content."""
    file_system, hadoop_path = _resolve(spark, path)
    file_system.delete(hadoop_path, False)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    file_system, hadoop_path = _resolve(spark, path)
    file_system.delete(hadoop_path, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of files and folders right below a folder; none if it is not there."""
    file_system, hadoop_path = _resolve(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; one that is there raises."""
    file_system, hadoop_path = _resolve(spark, path)
    stream = file_system.create(hadoop_path, False)
    stream.write(bytearray(text.encode()))
    stream.close()


def rename_new(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file; raises if the target is there. One step where the file system's rename is one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source = _resolve(spark, path)[0].makeQualified(hadoop.Path(path))
    none = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    none[0] = hadoop.Options.Rename.NONE
    hadoop.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration()).rename(source, hadoop.Path(target), none)


def refuse_mixing(spark: SparkSession, path: str, stream: bool) -> None:
    """Raise where batch and stream would write the same files.

    A stream keeps a log of its files, and readers then see no others: batch rows beside the
    log would be lost from sight without an error.
    """
    logged = path_exists(spark, join_path(path, STREAM_LOG))
    if logged and not stream:
        raise ValueError(f"{path} is written by a stream; rows added otherwise would not be seen")
    if stream and not logged and _holds_anything(spark, path):
        raise ValueError(f"{path} holds rows that a stream did not write and would hide")


def require_apart(spark: SparkSession, sources: Iterable[str], targets: Iterable[str]) -> None:
    """Raise if a target equals, contains or lies in a source.

    An overwrite deletes its target before the source is read, so overlap loses the data.
    """
    read = [(path, _canonical(spark, path)) for path in sources]
    for target in targets:
        written = _canonical(spark, target)
        for source, origin in read:
            if written.startswith(origin) or origin.startswith(written):
                raise ValueError(f"destination {target} overlaps source {source}")


def _holds_anything(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.exists(hadoop_path) and file_system.listStatusIterator(hadoop_path).hasNext()


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _canonical(spark: SparkSession, path: str) -> str:
    file_system, hadoop_path = _resolve(spark, path)
    parts = urlsplit(file_system.makeQualified(hadoop_path).toString())
    scheme = _SAME_STORE.get(parts.scheme, parts.scheme)
    body = os.path.realpath(parts.path) if scheme == "file" else parts.path
    return f"{scheme}://{parts.netloc}{body.rstrip('/')}/"
