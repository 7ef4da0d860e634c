"""Files arriving in the landing zone, transformed and staged or loaded exactly once.

The transform keeps no state, so each micro-batch is the batch job over the new files. The
file sink's commit log makes a repeated batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from quayside.config import PipelineConfig
from quayside.functions import named
from quayside.operators.checks import check_columns
from quayside.operators.columns import cluster_for_write
from quayside.plans.pipeline import transform
from quayside.sinks.tables import table_location
from quayside.sources.csv_text import read_options
from quayside.sources.datasets import scan
from quayside.sources.paths import join_path, refuse_mixing, require_apart, require_location


def arrivals(
    spark: SparkSession,
    config: PipelineConfig,
    dataset: str,
    schema: T.StructType | None = None,
    files_per_batch: int | None = None,
    bytes_per_batch: int | str | None = None,
) -> DataFrame:
    """The stream of one landing dataset; without ``schema``, that of the files there.

    A micro-batch takes at most so many files, or files of so many bytes together; not both.
    """
    if files_per_batch and bytes_per_batch:
        raise ValueError("a micro-batch is bounded by files or by bytes, not by both")
    if schema is None:
        schema = scan(spark, config.source.path, dataset, config.source.format).schema
    require_location(spark, config.source.path, "source location")
    reader = spark.readStream.schema(schema).format(config.source.format)
    reader = reader.options(**read_options(config.source.format))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    landing = reader.load(join_path(config.source.path, dataset))
    check_columns(landing, config)
    return landing


def stream_dataset(
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
    """Stage arriving files as a partitioned dataset.

    Takes all files present and ends, or runs on and looks again at the interval ``every``.
    ``cluster`` shuffles each micro-batch by output folder, as the batch job does.
    """
    require_location(spark, config.dest.path, "destination location")
    target = join_path(config.dest.path, dataset)
    require_apart(spark, [join_path(config.source.path, dataset)], [target])
    refuse_mixing(spark, target, stream=True)
    landing = arrivals(spark, config, dataset, schema, files_per_batch, bytes_per_batch)
    if cluster:
        landing = cluster_for_write(landing, config.partition_sources)
    writer = (
        transform(landing, config)
        .writeStream.format(config.dest.format)
        .option("path", target)
        .partitionBy(*config.partition_names)
    )
    return triggered(writer, checkpoint, every).start()


def stream_to_table(
    spark: SparkSession,
    config: PipelineConfig,
    dataset: str,
    table: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    files_per_batch: int | None = None,
    bytes_per_batch: int | str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append arriving files to an existing table, columns matched by name.

    The table must be the stream's own: empty at the first start, and not loaded by batches.
    Each micro-batch is shuffled by the table's partition columns, if it has any.
    """
    refuse_mixing(spark, table_location(spark, table), stream=True)
    landing = arrivals(spark, config, dataset, schema, files_per_batch, bytes_per_batch)
    rows = transform(landing, config).select(*[named(name) for name in spark.table(table).columns])
    folders = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    writer = cluster_for_write(rows, folders).writeStream.outputMode("append")
    return triggered(writer, checkpoint, every).toTable(table)


def triggered(writer: DataStreamWriter, checkpoint: str, every: str | None) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every)
    return writer.trigger(availableNow=True)
