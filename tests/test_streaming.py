import dataclasses
from pathlib import Path

import pytest
from helpers import document, rows

from quayside import Location, parse_config, run_pipeline, transform
from quayside.operators import cluster_for_write
from quayside.sinks import append, create_table
from quayside.sources import actives, staged
from quayside.streaming import stream_dataset, stream_to_table


@pytest.fixture
def arriving(spark, tmp_path):
    (tmp_path / "out").mkdir()
    source = str(tmp_path / "in" / "actives")
    df = actives(spark, 1000)
    df.repartition(4).write.parquet(source)
    config = parse_config(document(tmp_path / "in", tmp_path / "out"))
    return dataclasses.replace(config, partitions=(("month_part", "month"),)), df, source


def test_every_file_once_over_several_runs(spark, arriving, tmp_path):
    config, df, source = arriving
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        query = stream_dataset(spark, config, "actives", checkpoint, df.schema, files_per_batch=1)
        query.awaitTermination()
        return staged(spark, config.dest.path + "/actives", schema=transform(df, config).schema)

    assert rows(run()) == rows(transform(df, config))
    assert len(list((Path(checkpoint) / "commits").glob("[0-9]*"))) == 4
    assert run().count() == 1000
    df.limit(10).coalesce(1).write.mode("append").parquet(source)
    assert run().count() == 1010


def test_one_file_per_folder_and_batch(spark, arriving, tmp_path):
    config, df, _ = arriving
    counts = {}
    for cluster in (False, True):
        target = tmp_path / f"out-{cluster}"
        target.mkdir()
        one = dataclasses.replace(config, dest=Location(str(target)))
        checkpoint = str(tmp_path / f"checkpoint-{cluster}")
        stream_dataset(
            spark, one, "actives", checkpoint, df.schema, cluster=cluster
        ).awaitTermination()
        counts[cluster] = len(list((target / "actives").rglob("*.parquet")))
    assert counts[True] == 12 < counts[False]


def test_no_clustering_without_adaptive_streaming(spark, arriving):
    config, df, source = arriving
    stream = spark.readStream.schema(df.schema).parquet(source)
    switch = "spark.sql.adaptive.streaming.stateless.enabled"
    spark.conf.set(switch, "false")
    try:
        assert cluster_for_write(stream, ["month"]) is stream
    finally:
        spark.conf.unset(switch)
    assert cluster_for_write(stream, ["month"]) is not stream


def test_schema_of_the_files_by_default(spark, arriving, tmp_path):
    config, df, _ = arriving
    stream_dataset(spark, config, "actives", str(tmp_path / "checkpoint")).awaitTermination()
    assert staged(spark, config.dest.path + "/actives").count() == 1000


def test_into_a_table(spark, arriving, tmp_path):
    config, df, _ = arriving
    expected = transform(df, config).drop("month_part")
    create_table(spark, "arrivals_table", expected.schema, location=str(tmp_path / "table"))
    for _ in range(2):
        stream_to_table(
            spark, config, "actives", "arrivals_table", str(tmp_path / "checkpoint"), df.schema
        ).awaitTermination()
    assert rows(spark.table("arrivals_table")) == rows(expected)
    spark.sql("DROP TABLE arrivals_table")


def test_checks_come_before_the_start(spark, arriving, tmp_path):
    config, df, _ = arriving
    with pytest.raises(ValueError, match="user_id not present"):
        stream_dataset(spark, config, "actives", str(tmp_path / "c"), df.drop("user_id").schema)


def test_batch_and_stream_do_not_share_a_table(spark, arriving, tmp_path):
    config, df, _ = arriving
    rows_ = transform(df, config)
    for name, first in (("streamed", "stream"), ("loaded", "batch")):
        create_table(spark, name, rows_.drop("month_part").schema, location=str(tmp_path / name))
        checkpoint = str(tmp_path / f"checkpoint-{name}")
        if first == "batch":
            append(rows_, name)
            with pytest.raises(ValueError, match="would hide"):
                stream_to_table(spark, config, "actives", name, checkpoint, df.schema)
        else:
            stream_to_table(
                spark, config, "actives", name, checkpoint, df.schema
            ).awaitTermination()
            with pytest.raises(ValueError, match="written by a stream"):
                append(rows_, name)
        assert spark.table(name).count() == 1000
        spark.sql(f"DROP TABLE {name}")


def test_batch_and_stream_do_not_share_a_dataset(spark, arriving, tmp_path):
    config, df, _ = arriving
    checkpoint = str(tmp_path / "checkpoint")
    run_pipeline(spark, config)
    with pytest.raises(ValueError, match="would hide"):
        stream_dataset(spark, config, "actives", checkpoint, df.schema)
    (tmp_path / "out2").mkdir()
    other = dataclasses.replace(config, dest=Location(str(tmp_path / "out2")))
    stream_dataset(spark, other, "actives", checkpoint, df.schema).awaitTermination()
    with pytest.raises(ValueError, match="written by a stream"):
        run_pipeline(spark, other, overwrite="dynamic")
    run_pipeline(spark, other)
    assert staged(spark, other.dest.path + "/actives").count() == 1000
