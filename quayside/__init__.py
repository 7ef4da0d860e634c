"""Spark-native tabular ETL: landing zone to staging zone, loaded and validated."""

from quayside.config import Location, PipelineConfig, parse_config, read_config
from quayside.plans.goldens import compare_goldens
from quayside.plans.pipeline import ValidationError, run_pipeline, transform, validate

__all__ = [
    "Location",
    "PipelineConfig",
    "ValidationError",
    "compare_goldens",
    "parse_config",
    "read_config",
    "run_pipeline",
    "transform",
    "validate",
]
