"""Micro-batches that each own a partition: a batch delivered again replaces what it wrote before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayside.config import PipelineConfig
from quayside.operators.columns import cluster_for_write
from quayside.plans.pipeline import transform
from quayside.sinks.datasets import SUCCESS, write_dataset
from quayside.sources.paths import join_path, make_folder, path_exists, refuse_mixing, require_apart, require_location
from quayside.streaming.arrivals import arrivals, triggered

#: The partition column of a batch; folders are named by it.
BATCH = "batch_id"


def write_batch(df: DataFrame, target: str, batch: int, partitions: list[str], fmt: str = "parquet") -> str:
    """Replace the rows of one batch below ``target``; other batches stay. Returns the batch's folder."""
    if BATCH in {name.lower() for name in df.columns}:
        raise ValueError(f"the rows have a column {BATCH} of their own")
    return write_dataset(df, target, f"{BATCH}={batch}", partitions, fmt)


def stream_batches(
    spark: SparkSession,
    config: PipelineConfig,
    dataset: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    files_per_batch: int | None = None,
    bytes_per_batch: int | str | None = None,
    every: str | None = None,
    cluster: bool = True,
) -> StreamingQuery:
    """Stage arriving files, each micro-batch as the partition ``batch_id`` of its number.

    Spark delivers a batch again after a failure, with the same rows and number; the batch then replaces
    its own partition, so every row is there once. The checkpoint gives the numbers: a dataset belongs to
    one checkpoint, and a new one would write over batches of the same numbers, so it refuses to start
    beside them. Unlike ``stream_dataset``, the result is a plain dataset that batch jobs may read by
    folder, delete old batches from, and load.
    """
    require_location(spark, config.dest.path, "destination location")
    target = join_path(config.dest.path, dataset)
    require_apart(spark, [join_path(config.source.path, dataset)], [target])
    refuse_mixing(spark, target, stream=False)
    _same_checkpoint(spark, target, checkpoint)
    landing = arrivals(spark, config, dataset, schema, files_per_batch, bytes_per_batch)

    def stage(rows: DataFrame, batch: int) -> None:
        if cluster:
            rows = cluster_for_write(rows, config.partition_sources)
        write_batch(transform(rows, config), target, batch, config.partition_names, config.dest.format)

    return triggered(landing.writeStream.foreachBatch(stage), checkpoint, every).start()


def _same_checkpoint(spark: SparkSession, target: str, checkpoint: str) -> None:
    """Remember the checkpoint a dataset belongs to, in a hidden file; another one raises."""
    owner = join_path(make_folder(spark, target), "_checkpoint")
    known = {row[0] for row in spark.read.text(owner).collect()} if path_exists(spark, join_path(owner, SUCCESS)) else set()
    if known and known != {checkpoint}:
        raise ValueError(f"{target} belongs to the checkpoint {sorted(known)[0]}, whose batches this one would replace")
    if not known:
        # A folder whose name begins with _ is not part of the dataset.
        spark.createDataFrame([(checkpoint,)], "value string").coalesce(1).write.mode("overwrite").text(owner)


def batch_counts(df: DataFrame) -> DataFrame:
    """Rows of each batch of a dataset that ``stream_batches`` wrote."""
    return df.groupBy(BATCH).agg(F.count(F.lit(1)).alias("rows"))
