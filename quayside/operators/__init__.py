"""DataFrame to DataFrame operators; use the transforms with ``DataFrame.transform``."""

from quayside.operators.checks import check_columns, missing_columns
from quayside.operators.columns import (
    cast_columns,
    cluster_for_write,
    copy_partitions,
    decrypt_columns,
    encrypt_columns,
    join_arrays,
    mask_columns,
)
from quayside.operators.compare import bag_difference, except_all, golden_verdict, golden_verdicts
from quayside.operators.enrich import enrich_join
from quayside.operators.json_columns import malformed_counts, parse_json
from quayside.operators.pii import pii_scan
from quayside.operators.profile import (
    partition_profile,
    preview,
    row_count,
    schema_report,
)
from quayside.operators.validate import column_difference, column_report

__all__ = [
    "bag_difference",
    "cast_columns",
    "check_columns",
    "cluster_for_write",
    "column_difference",
    "column_report",
    "copy_partitions",
    "decrypt_columns",
    "encrypt_columns",
    "enrich_join",
    "except_all",
    "golden_verdict",
    "golden_verdicts",
    "join_arrays",
    "malformed_counts",
    "mask_columns",
    "missing_columns",
    "parse_json",
    "partition_profile",
    "pii_scan",
    "preview",
    "row_count",
    "schema_report",
]
