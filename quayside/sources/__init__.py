"""Scans: landing datasets, staged datasets, golden files, generated rows."""

from quayside.sources.datasets import scan, staged, union_parts
from quayside.sources.golden import golden_csv, normalise_golden
from quayside.sources.paths import join_path, path_exists, require_apart, require_location
from quayside.sources.synthetic import actives, actives_for

__all__ = [
    "actives",
    "actives_for",
    "golden_csv",
    "join_path",
    "normalise_golden",
    "path_exists",
    "require_apart",
    "require_location",
    "scan",
    "staged",
    "union_parts",
]
