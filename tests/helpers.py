"""What several test modules call; fixtures are in conftest.py, which tests may not import."""

from __future__ import annotations


def document(source, dest, datasets=("actives",)) -> dict:
    # The keys of the configuration document.
    return {
        "transformation-dataset": {
            "source": {"data-location": str(source), "file-format": "parquet"},
            "destination": {"data-location": str(dest), "file-format": "parquet"},
            "datasets": list(datasets),
            "masking-cols": {
                "mask": {"col1": {"name": "advertising_id"}, "col2": {"name": "user_id"}}
            },
            "transformation-cols": {
                "to_comma": {"col1": {"name": "location_source", "to": ","}},
                "to_decimal": {
                    "col1": {"name": "user_latitude", "to": "Decimal(12,7)"},
                    "col2": {"name": "user_longitude", "to": "Decimal(12,7)"},
                },
            },
            "partition-cols": ["month_part", "date_part"],
        }
    }


def rows(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
