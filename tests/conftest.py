from __future__ import annotations

import json

import pytest
from goldens import LANDING, landing
from helpers import document

from quayside.config import parse_config
from quayside.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def actives_config():
    return parse_config(document("landing", "staging"))


@pytest.fixture
def landed(spark, tmp_path):
    """The 70 golden records as a landing dataset, an empty staging, and the configuration."""
    source, dest = tmp_path / "landing", tmp_path / "staging"
    dest.mkdir()
    rows = landing("10") + landing("20") + landing("40")
    spark.createDataFrame(rows, LANDING).repartition(3).write.parquet(str(source / "actives"))
    return parse_config(document(source, dest))


@pytest.fixture
def write_json(tmp_path):
    def write(content, name="config.json") -> str:
        path = tmp_path / name
        path.write_text(json.dumps(content, indent=2))
        return str(path)

    return write
