"""The events table in the shape of the landing dataset, with its pipeline configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import PipelineConfig, parse_config
from quayside.functions import epoch_nanos, month_text
from quayside.session import scratch_path
from quayside.sources.paths import join_path, make_folder

DATASET = "events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


def landing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids as text, an array, a double to become a decimal, a date and its month as text."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.array("event_type", "props").alias("location_source"),
        epoch_nanos(F.col("ts")).alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        "value",
        F.to_date("ts").alias("date"),
        month_text(F.col("ts")).alias("month"),
    )


def events_document(source: str, dest: str, dataset: str = DATASET) -> dict:
    """The JSON configuration of the events pipeline."""
    # The keys of the configuration document.
    return {
        "transformation-dataset": {
            "source": {"data-location": source, "file-format": "parquet"},
            "destination": {"data-location": dest, "file-format": "parquet"},
            "datasets": [dataset],
            "masking-cols": {"mask": {"col1": {"name": "event_id"}, "col2": {"name": "user_id"}}},
            "transformation-cols": {
                "to_comma": {"col1": {"name": "location_source", "to": ","}},
                "to_decimal": {"col1": {"name": "value", "to": "Decimal(12,7)"}},
            },
            "partition-cols": ["month_part", "date_part"],
        }
    }


def events_config(source: str = "landing", dest: str = "staging") -> PipelineConfig:
    return parse_config(events_document(source, dest))


def land_events(
    spark: SparkSession, sf_dir: str, label: str, rows_per_file: int | None = None
) -> PipelineConfig:
    """Write the landing dataset to the shared folder; returns the configuration for it.

    Every task writes its own files, each of at most ``rows_per_file`` rows.
    """
    root = scratch_path(spark, label)
    landing = make_folder(spark, join_path(root, "landing"))
    staging = make_folder(spark, join_path(root, "staging"))
    writer = landing_events(spark, sf_dir).write
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(join_path(landing, DATASET))
    return events_config(landing, staging)


def staging_config(spark: SparkSession, label: str) -> PipelineConfig:
    """The configuration for events that are given as a frame: there is only a staging zone."""
    root = scratch_path(spark, label)
    return events_config(join_path(root, "landing"), make_folder(spark, join_path(root, "staging")))
