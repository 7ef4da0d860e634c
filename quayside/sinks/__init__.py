"""Sinks: partitioned datasets, exports, catalog tables."""

from quayside.sinks.datasets import (
    export_csv,
    export_parquet,
    require_success,
    write_dataset,
)
from quayside.sinks.tables import append, create_table, create_table_from_ddl, load_table
from quayside.sinks.versions import publish, read_published

__all__ = [
    "append",
    "create_table",
    "create_table_from_ddl",
    "export_csv",
    "export_parquet",
    "load_table",
    "publish",
    "read_published",
    "require_success",
    "write_dataset",
]
