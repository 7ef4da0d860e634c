"""Write, audit, publish; micro-batches that replace themselves."""

import pytest
from helpers import document, rows
from pyspark.sql import functions as F

from quayside.__main__ import main
from quayside.plans import pipeline
from quayside.plans.events import DATASET, land_events, landing_events
from quayside.plans.pipeline import publish_run, transform
from quayside.sinks import publish, read_published
from quayside.sinks.versions import AuditError, ConcurrentPublishError, current_manifest, expire, roll_back
from quayside.sources import join_path, staged
from quayside.sources.paths import delete_file, file_names
from quayside.streaming import stream_batches, stream_dataset
from quayside.streaming.batches import batch_counts, write_batch

SF_DIR = "/root/testdata/sf0.001"


def numbers(spark, first, last):
    return spark.range(first, last).selectExpr("id", "id % 3 as part")


def test_a_failed_audit_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    first = publish(numbers(spark, 0, 10), root, "d", ["part"])
    reading = read_published(spark, root, "d")
    with pytest.raises(AuditError, match="too few; too odd"):
        publish(numbers(spark, 0, 2), root, "d", ["part"], audits=[lambda df: ["too few"] if df.count() < 5 else [], lambda df: ["too odd"]])
    assert current_manifest(spark, root, "d")["version"] == first
    assert read_published(spark, root, "d").count() == 10
    second = publish(numbers(spark, 0, 20), root, "d", ["part"], audits=[lambda df: ()])
    assert second != first and read_published(spark, root, "d").count() == 20
    # A frame that was made before goes on reading the version it was made of.
    assert reading.count() == 10


def test_a_job_that_dies_while_writing(spark, tmp_path):
    root = str(tmp_path)
    publish(numbers(spark, 0, 10), root, "d")
    with pytest.raises(Exception, match="boom"):
        publish(numbers(spark, 0, 5).selectExpr("assert_true(id < 3, 'boom') as x"), root, "d")
    assert read_published(spark, root, "d").count() == 10


def test_two_publishers_at_once(spark, tmp_path):
    root = str(tmp_path)
    publish(numbers(spark, 0, 1), root, "d")

    def another(df):
        publish(numbers(spark, 0, 7), root, "d")
        return ()

    with pytest.raises(ConcurrentPublishError, match="manifest 2"):
        publish(numbers(spark, 0, 3), root, "d", audits=[another])
    assert read_published(spark, root, "d").count() == 7


def test_rolling_back_and_expiring(spark, tmp_path):
    root = str(tmp_path)
    versions = [publish(numbers(spark, 0, n), root, "d") for n in (1, 2, 3, 4)]
    assert roll_back(spark, root, "d") == versions[2] and read_published(spark, root, "d").count() == 3
    assert sorted(expire(spark, root, "d", keep=2)) == sorted(versions[:2])
    assert sorted(file_names(spark, join_path(join_path(root, "d"), "versions"))) == sorted(versions[2:])
    assert roll_back(spark, root, "d") == versions[3]
    with pytest.raises(ValueError, match="at least 1"):
        expire(spark, root, "d", keep=0)
    expire(spark, root, "d", keep=1)
    with pytest.raises(ValueError, match="no earlier version"):
        roll_back(spark, root, "d")


def test_nothing_published(spark, tmp_path):
    with pytest.raises(ValueError, match="no version"):
        read_published(spark, str(tmp_path), "d")
    empty = spark.createDataFrame([], "id long")
    publish(empty, str(tmp_path), "d")
    assert read_published(spark, str(tmp_path), "d").collect() == []


def test_a_batch_replaces_itself_only(spark, tmp_path):
    target = str(tmp_path)
    for batch, df in ((0, numbers(spark, 0, 5)), (1, numbers(spark, 5, 9)), (0, numbers(spark, 0, 5)), (0, numbers(spark, 0, 2))):
        write_batch(df, target, batch, ["part"])
    assert rows(batch_counts(staged(spark, target))) == [(0, 2), (1, 4)]
    with pytest.raises(ValueError, match="column batch_id"):
        write_batch(numbers(spark, 0, 1).withColumnRenamed("part", "Batch_Id"), target, 0, [])


def test_a_stream_that_dies_before_its_commit(spark, tmp_path):
    config = land_events(spark, SF_DIR, "died", rows_per_file=200)
    landing = landing_events(spark, SF_DIR)
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        stream_batches(spark, config, DATASET, checkpoint, landing.schema, files_per_batch=1).awaitTermination()

    target = join_path(config.dest.path, DATASET)
    expected = rows(transform(landing, config).drop("month_part", "date_part"))
    run()
    found = staged(spark, target)
    assert rows(found.drop("batch_id", "month_part", "date_part")) == expected
    counts = rows(batch_counts(found))
    assert len(counts) >= 5
    for _ in range(2):
        delete_file(spark, join_path(join_path(checkpoint, "commits"), str(counts[-1][0])))
        run()
        again = staged(spark, target)
        assert rows(batch_counts(again)) == counts and rows(again.drop("batch_id", "month_part", "date_part")) == expected
    # Another checkpoint would begin with batch 0 again, and the file sink would hide the batches.
    with pytest.raises(ValueError, match="belongs to the checkpoint"):
        stream_batches(spark, config, DATASET, str(tmp_path / "other"), landing.schema)
    with pytest.raises(ValueError, match="did not write"):
        stream_dataset(spark, config, DATASET, str(tmp_path / "third"), landing.schema)


def test_a_run_is_published_if_it_passes(spark, landed, monkeypatch):
    versions = publish_run(spark, landed)
    published = read_published(spark, landed.dest.path, "actives")
    assert published.count() == 70 and "masked_user_id" in published.columns
    assert current_manifest(spark, landed.dest.path, "actives")["version"] == versions["actives"]
    # A column that nobody configured: readers keep the version they have.
    right = pipeline.transform

    def wrong(df, *arguments, **options):
        out = right(df, *arguments, **options)
        return out.withColumn("more", F.lit(2))

    monkeypatch.setattr(pipeline, "transform", wrong)
    with pytest.raises(AuditError, match="nobody configured: .*more"):
        publish_run(spark, landed)
    monkeypatch.undo()
    assert current_manifest(spark, landed.dest.path, "actives")["version"] == versions["actives"]
    again = publish_run(spark, landed, cluster=False, drop_masked=True)
    assert again != versions and "user_id" not in read_published(spark, landed.dest.path, "actives").columns


def test_command_line_publishes(spark, landed, write_json, monkeypatch):
    monkeypatch.setattr("quayside.__main__.build_session", lambda app: spark)
    path = write_json(document(landed.source.path, landed.dest.path))
    assert main([path, "--publish"]) == 0
    assert read_published(spark, landed.dest.path, "actives").count() == 70
    monkeypatch.setattr("quayside.__main__.publish_run", lambda *a, **b: (_ for _ in ()).throw(AuditError("no")))
    assert main([path, "--publish"]) == 1
