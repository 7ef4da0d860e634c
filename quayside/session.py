"""Session settings the library relies on, and the shared folder for intermediate data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from quayside.sources.paths import join_path

# AQE splits hot partitions of the clustered write and merges small ones.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, the folder all executors share.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quayside-")
    return join_path(root, f"quayside-{label}-{uuid.uuid4().hex}")
