"""Every registered query against its SQL, on the smallest scale."""

from pathlib import Path

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, duck, name):
    assert differences(spark, duck, name, SF_DIR) == []


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1000
    assert df.columns[-4:] == ["masked_event_id", "masked_user_id", "month_part", "date_part"]
