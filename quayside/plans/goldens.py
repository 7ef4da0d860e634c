"""The configured golden files against the transform of the landing data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import PipelineConfig
from quayside.functions import named
from quayside.operators.checks import check_columns
from quayside.operators.compare import golden_verdict
from quayside.plans.pipeline import transform
from quayside.sources.datasets import scan
from quayside.sources.golden import UNREADABLE, golden_csv, normalise_golden
from quayside.sources.paths import join_path


def compare_goldens(
    spark: SparkSession, config: PipelineConfig, location: str, date_format: str | None = None
) -> DataFrame:
    """One verdict per golden file below ``location``; nothing is written.

    Golden files belong to the datasets in order; a single dataset is held against each of
    them. Partition copies are not part of a golden.
    """
    datasets = config.datasets
    if len(datasets) == 1:
        datasets = datasets * len(config.goldens)
    if not config.goldens or len(datasets) != len(config.goldens):
        raise ValueError(f"{len(config.goldens)} golden files for {len(datasets)} datasets")
    copies = [named(name) for name, source in config.partitions if name != source]
    verdicts = []
    for dataset, golden in zip(datasets, config.goldens):
        landing = scan(spark, config.source.path, dataset, config.source.format)
        check_columns(landing, config)
        actual = transform(landing, config).drop(*copies)
        raw = golden_csv(spark, join_path(location, golden))
        expected = normalise_golden(raw, actual.schema, date_format)
        verdict = golden_verdict(actual.withColumn(UNREADABLE, F.lit("")), expected)
        verdicts.append(
            verdict.select(F.lit(dataset).alias("dataset"), F.lit(golden).alias("golden"), "*")
        )
    return reduce(DataFrame.union, verdicts)
