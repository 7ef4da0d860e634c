"""The 70 golden records, as frames and as files, right and damaged."""

import dataclasses
from decimal import Decimal

import pytest
from goldens import LANDING, SETS, TRANSFORMED, landing, transformed
from pyspark.sql import functions as F

from quayside import compare_goldens
from quayside.operators import bag_difference, golden_verdict
from quayside.plans.pipeline import transform
from quayside.sources import golden_csv, normalise_golden
from quayside.sources.golden import UNREADABLE


@pytest.fixture
def produce(spark, actives_config):
    """The output of the transform for a set, without the partition copies."""
    def run(name):
        df = transform(spark.createDataFrame(landing(name), LANDING), actives_config)
        return df.drop("month_part", "date_part")
    return run


@pytest.mark.parametrize("name, count", [("10", 10), ("20", 20), ("40", 40)])
def test_transform_gives_the_goldens(spark, produce, name, count):
    expected = spark.createDataFrame(transformed(name), TRANSFORMED)
    actual = produce(name)
    assert expected.count() == count
    assert actual.dtypes == expected.dtypes
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()
    assert tuple(golden_verdict(actual, expected).first()) == (0, 0, True)


def test_known_hashes():
    first = transformed("10")[0]
    assert first[12] == "6b86b273ff34fce19d6b804eff5a3f5747ada4eaa22f1d49c01e52ddb7875b4b"
    assert first[13] == "0f8eb4b72b6e0c9e88b388eb967b49e067ef1004bf07bffc22c3acb13b43580a"


def write_golden(path, records):
    """A golden file as hand editing leaves it.

    Padded headers, six empty columns, trailing blanks, dates day first, decimals without
    trailing zeros and with blanks inside.
    """
    names = [column.split(" ")[0] for column in TRANSFORMED.split(", ")]
    lines = [",".join([*names[:12], names[12] + "    ", "", "", "", "", "", "", names[13] + " "])]
    for number, record in enumerate(records):
        cells = [cell.normalize() if isinstance(cell, Decimal) else cell for cell in record]
        cells[4] = f'"{cells[4]}  "'
        cells[9] = str(cells[9]).replace(".", " .") if number % 2 else cells[9]
        cells[10] = cells[10].strftime("%d-%m-%Y")
        lines.append(",".join(map(str, [*cells[:13], "", "", "", "", "", "", str(cells[13]) + "   "])))
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def compare(spark, produce, tmp_path):
    """Difference between a set's output and a golden file with the given records."""
    def run(name, records, *columns):
        raw = golden_csv(spark, write_golden(tmp_path / f"{name}.csv", records))
        assert len(raw.columns) == 20
        actual = produce(name)
        expected = normalise_golden(raw, actual.schema, "dd-MM-yyyy")
        actual = actual.withColumn(UNREADABLE, F.lit(""))
        if columns:
            actual, expected = actual.select(*columns), expected.select(*columns)
        return golden_verdict(actual, expected).first(), bag_difference(actual, expected)
    return run


@pytest.mark.parametrize("name", SETS)
def test_golden_file_passes_once_normalised(compare, name):
    verdict, difference = compare(name, transformed(name))
    assert verdict.passed and difference.isEmpty()


def changed(record, position, value):
    return (*record[:position], value, *record[position + 1:])


def test_one_wrong_longitude_fails(compare):
    records = transformed("10")
    records[9] = changed(records[9], 9, records[8][9])
    assert tuple(compare("10", records)[0]) == (1, 1, False)
    assert compare("10", records, "advertising_id", "user_latitude")[0].passed
    _, difference = compare("10", records, "advertising_id", "user_longitude")
    assert {row.advertising_id for row in difference.collect()} == {"10"}


def test_six_wrong_longitudes_fail(compare):
    records = transformed("20")
    for number in (0, 1, 3, 13, 15, 16):
        records[number] = changed(records[number], 9, -records[number][9])
    assert tuple(compare("20", records)[0]) == (6, 6, False)


def test_a_cell_beyond_its_type_is_no_null(compare):
    records = transformed("20")
    records[1] = changed(records[1], 9, Decimal("-136312000"))
    verdict, difference = compare("20", records)
    assert tuple(verdict) == (1, 1, False)
    assert {r.unreadable for r in difference.collect()} == {"", "user_longitude"}


def test_latitude_copied_from_longitude_and_hashes_one_line_down_fail(compare):
    records = transformed("40")
    records[1] = changed(records[1], 8, records[1][9])
    assert tuple(compare("40", records, "advertising_id", "user_latitude")[0]) == (1, 1, False)
    hashes = ["", *[record[13] for record in records]]
    shifted = [changed(record, 13, hashes[number]) for number, record in enumerate(records)]
    assert tuple(compare("40", shifted, "advertising_id", "masked_user_id")[0]) == (40, 40, False)
    assert compare("40", shifted, "advertising_id", "masked_advertising_id")[0].passed


def test_a_missing_or_doubled_record_fails(compare):
    records = transformed("10")
    assert tuple(compare("10", records[1:])[0]) == (1, 0, False)
    assert tuple(compare("10", records + records[:1])[0]) == (0, 1, False)


def test_configured_golden_files(spark, landed, tmp_path):
    (tmp_path / "goldens").mkdir()
    everything = transformed("10") + transformed("20") + transformed("40")
    write_golden(tmp_path / "goldens" / "all.csv", everything)
    write_golden(tmp_path / "goldens" / "10.csv", transformed("10"))
    config = dataclasses.replace(landed, goldens=("all.csv", "10.csv"))
    report = compare_goldens(spark, config, str(tmp_path / "goldens"), "dd-MM-yyyy")
    assert [tuple(r) for r in report.orderBy("golden").collect()] == [
        ("actives", "10.csv", 60, 0, False), ("actives", "all.csv", 0, 0, True),
    ]
    assert list((tmp_path / "staging").iterdir()) == []
    with pytest.raises(ValueError, match="golden files"):
        compare_goldens(spark, landed, str(tmp_path))
