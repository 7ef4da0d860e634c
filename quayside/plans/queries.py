"""Queries over the given tables, one per operator. Each reads its tables whole."""

from __future__ import annotations

import dataclasses
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import PipelineConfig, parse_config, read_config
from quayside.functions import date_from, digest, epoch_nanos, hex_draw, id_text, month_text, pick
from quayside.operators import (
    bag_difference,
    cast_columns,
    column_difference,
    column_report,
    copy_partitions,
    decrypt_columns,
    encrypt_columns,
    enrich_join,
    except_all,
    golden_verdict,
    golden_verdicts,
    join_arrays,
    mask_columns,
    partition_profile,
    pii_scan,
    preview,
    row_count,
    schema_report,
)
from quayside.operators.checks import column_problems
from quayside.plans.events import (
    DATASET,
    events_config,
    events_document,
    land_events,
    landing_events,
    staging_config,
    table,
)
from quayside.plans.goldens import compare_goldens
from quayside.plans.pipeline import run_pipeline, transform
from quayside.plans.registry import query, query_named
from quayside.session import scratch_path
from quayside.sinks import (
    create_table,
    create_table_from_ddl,
    export_csv,
    export_parquet,
    load_table,
    write_dataset,
)
from quayside.sources import (
    actives_for,
    golden_csv,
    join_path,
    normalise_golden,
    require_apart,
    require_location,
    scan,
    staged,
    union_parts,
)
from quayside.sources.paths import folder_bytes, make_folder, split_location
from quayside.streaming import stream_dataset, stream_to_table

# Scans


@query
def scan_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "events.parquet")


def _through_format(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """The orders table written in a format and scanned back."""
    orders = table(spark, sf_dir, "orders")
    root = make_folder(spark, scratch_path(spark, fmt))
    write_dataset(orders, root, "orders", fmt=fmt)
    return scan(spark, root, "orders", fmt, orders.schema)


@query
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_format(spark, sf_dir, "csv")


@query
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_format(spark, sf_dir, "json")


@query
def scan_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_format(spark, sf_dir, "orc")


@query
def golden_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through a hand-edited looking CSV: all text, then trimmed and typed again."""
    events = transform(landing_events(spark, sf_dir), events_config()).drop("month_part", "date_part")
    texts = [name for name in events.columns if name != "date"]
    padded = events.select(
        *[F.concat(F.lit(" "), F.col(name).cast("string"), F.lit("  ")).alias(name) for name in texts],
        F.date_format("date", "dd-MM-yyyy").alias("date"),
    )
    path = scratch_path(spark, "golden")
    export_csv(padded, path)
    if golden_csv(spark, path).where("event_type = trim(event_type)").limit(1).count():
        raise ValueError("the padding has been lost on the way, so nothing is tested")
    return normalise_golden(golden_csv(spark, path), events.schema, "dd-MM-yyyy")


@query
def staged_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All part files of the staged events, partition types inferred from the folders."""
    return _staged_events(spark, sf_dir, "staged")


@query
def pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the staged events; only its folder is read."""
    day = F.col("date_part") == F.lit("2024-01-15").cast("date")
    return _staged_events(spark, sf_dir, "pruned").where(day)


@query_named("union_parts")
def union_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose columns have drifted: one lacks ``props``, the other ``value``."""
    events = table(spark, sf_dir, "events")
    paid = events.where(F.col("event_type") == "purchase").drop("props")
    other = events.where(F.col("event_type") != "purchase").drop("value")
    return union_parts(paid, other)


@query
def synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated record per event id, its sources flattened."""
    records = actives_for(table(spark, sf_dir, "events"), "event_id")
    return join_arrays(records, [("location_source", ",")])


# Column transforms


@query
def mask_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return mask_columns(events, ["event_id", "user_id"])


@query
def mask_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clear column leaves with the mask."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return mask_columns(customers, ["c_name"], drop_source=True)


@query
def cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return cast_columns(events, [("value", "Decimal(12,7)")])


@query
def cast_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of six digits do not fit decimal(12,7) and become null."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return cast_columns(orders, [("o_totalprice", "Decimal(12,7)")])


@query
def join_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays with null elements and null arrays, by the customer's balance."""
    customers = table(spark, sf_dir, "customer")
    debt = F.col("c_acctbal") < 0
    names = F.array("c_mktsegment", F.when(~debt, F.col("c_name")), F.col("c_nationkey").cast("string"))
    rows = customers.select(
        "c_custkey", names.alias("labels"), F.when(~debt, names).alias("maybe_labels")
    )
    return join_arrays(rows, [("labels", ","), ("maybe_labels", " | ")])


@query
def partition_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = landing_events(spark, sf_dir).select("event_id", "date", "month")
    return copy_partitions(events, [("month_part", "month"), ("date_part", "date")])


@query
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month text, epoch nanoseconds, id text, and draws from a hash, over the events."""
    events = table(spark, sf_dir, "events").withColumn("hex", digest(F.col("event_id")))
    return events.select(
        "event_id",
        month_text(F.col("ts")).alias("month"),
        epoch_nanos(F.col("ts")).alias("nanos"),
        id_text(F.col("event_id"), 5000).alias("id_text"),
        pick(hex_draw(F.col("hex"), 1, 8), ["urban", "rural", "suburban"]).alias("word"),
        date_from(hex_draw(F.col("hex"), 9, 8), "2022-01-01", 365).alias("day"),
    )


@query
def pipeline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked, typed, flattened events with partition columns: the flagship query."""
    return transform(landing_events(spark, sf_dir), events_config())


# Pipeline, sinks, warehouse, stream


def _staged_path(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Folder of the staged events; the landing rows are taken as they are read, not written first."""
    config = staging_config(spark, label)
    run_pipeline(spark, config, frames={DATASET: landing_events(spark, sf_dir)}, check=False)
    return join_path(config.dest.path, DATASET)


def _staged_events(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return staged(spark, _staged_path(spark, sf_dir, label))


@query
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _staged_events(spark, sf_dir, "counts")
        .groupBy("month_part", "date_part")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def overwrite_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years from 1997 on replaced by their open orders; the earlier years stay."""
    root = make_folder(spark, scratch_path(spark, "days"))
    orders = table(spark, sf_dir, "orders").withColumn("year_part", F.year("o_orderdate"))
    write_dataset(orders, root, "orders", ["year_part"])
    late = orders.where(F.col("year_part") >= 1997).where(F.col("o_orderstatus") == "O")
    path = write_dataset(late, root, "orders", ["year_part"], overwrite="dynamic")
    return staged(spark, path).groupBy("year_part", "o_orderstatus").agg(F.count(F.lit(1)).alias("rows"))


@query
def pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation report of a configured run over a landing zone."""
    return run_pipeline(spark, land_events(spark, sf_dir, "report")).report


@query
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays flattened for CSV, read back as text."""
    path = scratch_path(spark, "export-csv")
    export_csv(landing_events(spark, sf_dir), path)
    return golden_csv(spark, path)


@query
def parquet_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export-parquet")
    export_parquet(actives_for(table(spark, sf_dir, "orders"), "o_orderkey"), path)
    return join_arrays(staged(spark, path), [("location_source", ",")])


def _new_table(spark: SparkSession, schema, partitioned_by=()) -> str:
    location = scratch_path(spark, "table")
    name = "quayside_" + location.rsplit("-", 1)[1]
    create_table(spark, name, schema, partitioned_by, location)
    create_table(spark, name, schema, partitioned_by, location)
    return name


@query_named("load_table")
def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged events loaded twice by plain appends: every row is there twice."""
    path = _staged_path(spark, sf_dir, "append")
    schema = staged(spark, path).drop("month_part", "date_part").schema
    name = _new_table(spark, schema)
    load_table(spark, name, path)
    load_table(spark, name, path)
    return spark.table(name)


@query
def load_repeatable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load repeated under its id: every row is there once."""
    path = _staged_path(spark, sf_dir, "repeat")
    schema = staged(spark, path).drop("month_part", "date_part").schema
    name = _new_table(spark, schema.add("load_id", "string"), ["load_id"])
    load_table(spark, name, path, load_id="first")
    load_table(spark, name, path, load_id="second")
    load_table(spark, name, path, load_id="second")
    return spark.table(name).groupBy("load_id", "event_type").agg(F.count(F.lit(1)).alias("rows"))


def _landed_for_stream(spark: SparkSession, sf_dir: str, label: str) -> tuple[PipelineConfig, int]:
    """A landing zone of several files, and the bytes of about a third of it."""
    rows = table(spark, sf_dir, "events").count()
    config = land_events(spark, sf_dir, label, rows_per_file=max(1, rows // 8))
    return config, max(1, folder_bytes(spark, join_path(config.source.path, DATASET)) // 3)


@query
def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files taken by their size into several micro-batches, staged, and read back."""
    config, size = _landed_for_stream(spark, sf_dir, "stream")
    schema = landing_events(spark, sf_dir).schema
    checkpoint = scratch_path(spark, "stream-checkpoint")
    stream_dataset(spark, config, DATASET, checkpoint, schema, bytes_per_batch=size).awaitTermination()
    return staged(spark, join_path(config.dest.path, DATASET))


@query
def stream_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files appended to a table; a second run finds nothing new."""
    config, size = _landed_for_stream(spark, sf_dir, "stream-table")
    landing = landing_events(spark, sf_dir)
    name = _new_table(spark, transform(landing, config).drop("date_part").schema, ["month_part"])
    checkpoint = scratch_path(spark, "stream-checkpoint")
    for _ in range(2):
        stream_to_table(
            spark, config, DATASET, name, checkpoint, landing.schema, bytes_per_batch=size
        ).awaitTermination()
    return spark.table(name).drop("month_part")


# Inspection, validation, comparison


@query_named("row_count")
def rows_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


@query
def rows_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile summed up: all rows are in some partition, and no partition is there twice."""
    profile = partition_profile(table(spark, sf_dir, "lineitem"))
    partitions = F.count(F.lit(1))
    return profile.agg(
        F.sum("rows").alias("rows"),
        (partitions == F.count_distinct("partition")).alias("each_once"),
        (F.min("rows") > 0).alias("none_empty"),
    )


@query
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "events"), "event_id")


@query_named("schema_report")
def schema_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_report(table(spark, sf_dir, "events"))


@query
def columns_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that staging has beyond landing, with the rows that hold a value there."""
    landing = landing_events(spark, sf_dir)
    staging = transform(landing, events_config())
    announced = ["masked_event_id", "masked_user_id", "month_part", "date_part"]
    difference = column_difference(landing, staging, announced)
    filled = staging.agg(*[F.count(name).alias(name) for name in announced]).unpivot(
        [], announced, "column", "filled"
    )
    return difference.join(filled, "column")


@query_named("column_report")
def column_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing events against staged ones: two columns change type, by configuration."""
    landing = landing_events(spark, sf_dir)
    staging = transform(landing, events_config())
    return column_report(DATASET, landing, staging, staging.schema)


@query
def lost_rows_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging that lost rows, a column and a type: every verdict occurs."""
    orders = table(spark, sf_dir, "orders")
    staging = (
        orders.where(F.col("o_orderstatus") != "P")
        .drop("o_orderpriority")
        .withColumn("o_totalprice", F.col("o_totalprice").cast("float"))
    )
    return column_report("orders", orders, staging)


@query
def dataset_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two datasets run by one configuration and validated together."""
    root = scratch_path(spark, "datasets")
    document = events_document(join_path(root, "landing"), make_folder(spark, join_path(root, "staging")))
    document["transformation-dataset"]["datasets"] = ["clicks", "others"]
    click = F.col("event_type") == "click"
    events = landing_events(spark, sf_dir)
    frames = {"clicks": events.where(click), "others": events.where(~click)}
    return run_pipeline(spark, parse_config(document), frames=frames).report


def _perturbed(events: DataFrame) -> DataFrame:
    """Errors have another value, views are there twice, clicks are gone."""
    kind = F.col("event_type")
    value = F.when(kind == "error", F.col("value") + 1).otherwise(F.col("value"))
    changed = events.withColumn("value", value)
    copies = F.when(kind == "view", 2).when(kind == "click", 0).otherwise(1)
    return changed.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("copy")


@query
def golden_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return bag_difference(events, _perturbed(events))


@query
def golden_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written pipeline output against the transform of the landing rows, by event type."""
    expected = transform(landing_events(spark, sf_dir), events_config()).drop("month_part", "date_part")
    actual = _staged_events(spark, sf_dir, "golden").drop("month_part", "date_part")
    return golden_verdicts(actual, expected, ["event_type"])


@query
def golden_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return golden_verdict(events, _perturbed(events))


@query
def golden_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A right golden file passes, one without the clicks fails."""
    config = land_events(spark, sf_dir, "goldens")
    # Golden files are held against what has landed.
    events = transform(landing_events(spark, sf_dir), config).drop("month_part", "date_part")
    location = scratch_path(spark, "golden-files")
    export_csv(events, join_path(location, "all.csv"))
    export_csv(events.where(F.col("event_type") != "click"), join_path(location, "no_clicks.csv"))
    config = dataclasses.replace(config, goldens=("all.csv", "no_clicks.csv"))
    return compare_goldens(spark, config, location)


@query
def bag_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines by flag, status and supplier, less one of each kind; no name is special."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("piece"), F.col("l_linestatus").alias("copy"), "l_suppkey"
    )
    return except_all(lines, lines.distinct())


# Configuration, locations, checks


@query
def config_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events staged by a document read from a file; the masks stand in the keys' order."""
    root = scratch_path(spark, "config")
    document = events_document(join_path(root, "landing"), make_folder(spark, join_path(root, "staging")))
    document["transformation-dataset"]["masking-cols"]["mask"] = {
        "col2": {"name": "value"}, "col10": {"name": "user_id"}, "col1": {"name": "event_id"},
    }
    path = join_path(root, "document")
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(path)
    config = read_config(spark, path)
    run_pipeline(spark, config, frames={DATASET: landing_events(spark, sf_dir)}, check=False)
    events = staged(spark, join_path(config.dest.path, DATASET))
    masks = [name for name in events.columns if name.startswith("masked_")]
    order = F.lit(",".join(masks)).alias("masks")
    return events.select("event_id", order, F.sha2(F.concat_ws(",", *masks), 256).alias("in_order"))


@query
def column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a configuration asks of columns that the events lack or that cannot serve."""
    document = events_document("landing", "staging")
    body = document["transformation-dataset"]
    body["masking-cols"]["mask"] |= {"col3": {"name": "User_id"}, "col4": {"name": "location_source"}}
    body["transformation-cols"]["to_comma"]["col2"] = {"name": "value", "to": ","}
    body["transformation-cols"]["to_decimal"]["col2"] = {"name": "price", "to": "Decimal(12,7)"}
    body["partition-cols"].append("region_part")
    events = landing_events(spark, sf_dir)
    problems = column_problems(events, parse_config(document))
    lines = F.array(*[
        F.struct(*[F.lit(x).alias(name) for x, name in zip(problem, ("group", "column", "problem"))])
        for problem in problems
    ])
    return row_count(events).select(F.inline(lines), "rows").select("group", "column", "problem", "rows")


@query
def location_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders written and scanned, and what a run says to places that are missing or overlap."""
    orders = table(spark, sf_dir, "orders")
    root = make_folder(spark, scratch_path(spark, "places"))
    present = write_dataset(orders, root, "present")

    def outcome(check, *arguments) -> str:
        try:
            check(*arguments)
        except ValueError as error:
            return "overlaps" if "overlaps" in str(error) else "not found" if "not found" in str(error) else str(error)
        return "ok"

    _, key = split_location(present)
    lines = [
        ("source", outcome(require_location, spark, present, "source")),
        ("missing source", outcome(require_location, spark, join_path(root, "absent"), "source")),
        ("destination apart", outcome(require_apart, spark, [present], [join_path(root, "other")])),
        ("destination in source", outcome(require_apart, spark, [present], [join_path(present, "inner")])),
        ("missing destination", outcome(write_dataset, orders, join_path(root, "absent"), "x")),
        ("key", "ends with its name" if key.endswith("/present") else key),
    ]
    found = spark.createDataFrame(lines, "place string, outcome string")
    return found.crossJoin(F.broadcast(row_count(scan(spark, root, "present"))))


@query
def ddl_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers loaded into a table that a JSON document describes."""
    root = make_folder(spark, scratch_path(spark, "ddl"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = write_dataset(customers, root, "customer")
    name = "quayside_" + root.rsplit("-", 1)[1]
    statement = (
        f"CREATE TABLE IF NOT EXISTS {name} (c_custkey bigint, c_name varchar COMMENT 'a varchar, not using it', "
        f"c_acctbal double) LOCATION '{join_path(root, 'table')}'"
    )
    document = join_path(root, "schema")
    spark.createDataFrame([(json.dumps({"schema": statement}),)], "value string").coalesce(1).write.text(document)
    create_table_from_ddl(spark, document)
    load_table(spark, name, path)
    return spark.table(name)


@query
def load_text_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers staged by a text of three digits: the table has the same texts."""
    root = make_folder(spark, scratch_path(spark, "text-partitions"))
    code = F.lpad(F.col("c_nationkey").cast("string"), 3, "0")
    customers = table(spark, sf_dir, "customer").withColumn("code", code)
    path = write_dataset(customers, root, "customer", ["code"])
    name = _new_table(spark, customers.schema, ["code"])
    load_table(spark, name, path)
    return spark.table(name).select("c_custkey", "code")


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through CSV as they are, beside odd texts made of them: nulls, blank edges, quotes, line breaks."""
    text, kind = F.col("text"), F.col("doc_id") % 6
    odd = (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.concat(F.lit("  "), text, F.lit(" ")))
        .when(kind == 3, F.concat(F.lit('"'), text, F.lit('\\"\r\n,x\\')))
        .otherwise(text)
    )
    documents = table(spark, sf_dir, "documents").withColumn("odd", odd)
    root = make_folder(spark, scratch_path(spark, "round-trip"))
    records = {"lineSep": "\u001e"}
    write_dataset(documents, root, "documents", fmt="csv", options=records)
    return scan(spark, root, "documents", "csv", documents.schema, records)


@query
def partial_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the orders, the second replacing its years; one partition is null throughout."""
    root = scratch_path(spark, "partial")
    document = events_document(join_path(root, "landing"), make_folder(spark, join_path(root, "staging")), "orders")
    body = document["transformation-dataset"]
    body["masking-cols"]["mask"] = {"col1": {"name": "o_custkey"}}
    body["transformation-cols"] = {"to_decimal": {"col1": {"name": "o_totalprice", "to": "Decimal(12,2)"}}}
    body["partition-cols"] = ["year_part", "region_part"]
    config = parse_config(document)
    orders = table(spark, sf_dir, "orders").select(
        "*", F.year("o_orderdate").alias("year"), F.lit(None).cast("string").alias("region")
    )
    run_pipeline(spark, config, frames={"orders": orders}, overwrite="dynamic")
    late = orders.where("year >= 1997 and o_orderstatus = 'O'")
    return run_pipeline(spark, config, frames={"orders": late}, overwrite="dynamic").report


# Personal data, secrets, enrichment


@query_named("pii_scan")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_scan(table(spark, sf_dir, "documents"), ["text", "source"])


@query
def mask_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks under a new key each run: one for each id, none of them the plain digest."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    masked = mask_columns(events, ["user_id"], key=os.urandom(32))
    return masked.agg(
        F.count_distinct("user_id").alias("ids"),
        F.count_distinct("masked_user_id").alias("masks"),
        F.count_distinct("user_id", "masked_user_id").alias("pairs"),
        F.count_if(F.col("masked_user_id") == digest(F.col("user_id"))).alias("plain"),
        F.count_if(F.length("masked_user_id") == 64).alias("rows"),
    )


@query
def encrypt_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers encrypted under a new key each run and decrypted again; no clear text in between."""
    key = os.urandom(32)
    customers = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "encrypted")
    encrypt_columns(customers, ["c_name", "c_acctbal"], key).write.parquet(path)
    hidden = spark.read.parquet(path)
    clear = hidden.withColumnRenamed("c_name", "seen").join(customers.select("c_custkey", "c_name"), "c_custkey")
    leaks = clear.where(F.col("seen").contains(F.col("c_name"))).count()
    return decrypt_columns(hidden, [("c_name", "string"), ("c_acctbal", "double")], key).withColumn("leaks", F.lit(leaks))


@query_named("enrich_join")
def enriched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the names of their suppliers and the brands of their parts."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    named_lines = enrich_join(lines, table(spark, sf_dir, "supplier"), {"l_suppkey": "s_suppkey"}, ["s_name"])
    return enrich_join(named_lines, table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"}, ["p_brand", "p_type"])
