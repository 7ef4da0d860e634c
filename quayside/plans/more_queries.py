"""Further queries, each with its SQL: drifted files, JSON, damaged records, versions, replays, skew."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import malformed_counts, parse_json
from quayside.operators.columns import decrypt_columns, pseudonym_key, pseudonymise
from quayside.operators.digest_tree import tree_difference
from quayside.operators.enrich import enrich_skewed
from quayside.operators.footers import footer_rows
from quayside.operators.pii import CHECKED, pii_validated
from quayside.plans import queries as _first  # noqa: F401 - registers the other queries
from quayside.plans.events import DATASET, land_events, landing_events, table
from quayside.plans.oracle import STAGED
from quayside.plans.records import land_records
from quayside.plans.registry import QUERIES, SQL, query_named
from quayside.session import scratch_path
from quayside.sinks import publish, read_published, write_dataset
from quayside.sinks.buckets import bucketed_join, write_bucketed
from quayside.sinks.versions import AuditError, current_manifest, roll_back
from quayside.sources import join_path, staged
from quayside.sources.paths import delete_file, file_names, folder_bytes, make_folder
from quayside.streaming.batches import stream_batches

__all__ = ["QUERIES", "SQL"]


@query_named(
    "drifted_read",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           CASE WHEN year(o_orderdate) >= 1994 THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN year(o_orderdate) < 1997 THEN month(o_orderdate)::BIGINT ELSE o_orderkey * 10000000000 END AS code,
           CASE WHEN year(o_orderdate) >= 1997 THEN 'late' END AS phase,
           year(o_orderdate)::INTEGER AS year_part
    FROM orders
    """,
)
def drifted_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders staged by three loads of other columns: one is added, one becomes wider, one comes late."""
    root = make_folder(spark, scratch_path(spark, "drifted"))
    orders = table(spark, sf_dir, "orders").withColumn("year_part", F.year("o_orderdate"))
    year = F.col("year_part")
    loads = [
        orders.where(year < 1994).drop("o_orderpriority").withColumn("code", F.month("o_orderdate")),
        orders.where((year >= 1994) & (year < 1997)).withColumn("code", F.month("o_orderdate")),
        orders.where(year >= 1997).withColumn("code", F.col("o_orderkey") * 10_000_000_000).withColumn("phase", F.lit("late")),
    ]
    for load in loads:
        path = write_dataset(load, root, "orders", ["year_part"], overwrite="dynamic")
    return staged(spark, path)


@query_named(
    "json_props",
    """
    SELECT event_id, event_type, json_extract(props, '$.k')::INTEGER AS k, NULL::VARCHAR AS malformed_props,
           CASE WHEN event_type IN ('click', 'error') THEN NULL ELSE json_extract(props, '$.k')::INTEGER END AS noted_k,
           CASE event_type WHEN 'click' THEN left(props, len(props) - 1) WHEN 'error' THEN replace(props, '": ', '": "x') || '"}' END
               AS malformed_noted,
           (SELECT count(*) FROM events WHERE event_type IN ('click', 'error') AND props IS NOT NULL) AS rejects
    FROM events
    """,
)
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON texts of all events, and beside them copies of which two kinds are damaged: cut off, or of another type."""
    props, kind = F.col("props"), F.col("event_type")
    cut = F.left(props, F.length(props) - 1)
    # A number's place taken by an open text; two ends follow it, so that nothing but the type is wrong.
    text = F.concat(F.replace(props, F.lit('": '), F.lit('": "x')), F.lit('"}'))
    events = table(spark, sf_dir, "events").withColumn("noted", F.when(kind == "click", cut).when(kind == "error", text).otherwise(props))
    parsed = parse_json(events, [("props", "k int"), ("noted", "k int, absent string")])
    rejects = malformed_counts(parsed, ["noted"]).select(F.col("malformed").alias("rejects"))
    read = parsed.select(
        "event_id", "event_type", "props.k", "malformed_props", F.col("noted.k").alias("noted_k"), "malformed_noted"
    )
    return read.crossJoin(F.broadcast(rejects))


@query_named(
    "csv_rejects",
    """
    SELECT doc_id, text, lang, source, n_chars,
           CASE WHEN n_chars % 5 IN (0, 1) THEN NULL ELSE n_chars % 5 END::INTEGER AS share,
           CASE WHEN n_chars % 5 IN (0, 1) THEN NULL ELSE DATE '2024-01-01' + (n_chars % 28)::INTEGER END AS day,
           n_chars % 5 IN (0, 1) AS rejected, true AS holds_record,
           (SELECT count(*) FROM documents WHERE n_chars % 5 IN (0, 1)) AS rejects,
           (SELECT count(*) FROM documents) AS records
    FROM documents
    """,
)
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through CSV; extra cells of two in five are damaged, one is no number, one no date."""
    records = {"lineSep": "\u001e"}
    chars = F.col("n_chars")
    documents = table(spark, sf_dir, "documents")
    share = F.when(chars % 5 == 0, F.lit("none")).otherwise((chars % 5).cast("string"))
    day = F.when(chars % 5 == 1, F.lit("2024-13-01")).otherwise(F.date_add(F.lit("2024-01-01"), (chars % 28).cast("int")).cast("string"))
    root = make_folder(spark, scratch_path(spark, "rejects"))
    path = write_dataset(documents.withColumns({"share": share, "day": day}), root, "raw", fmt="csv", options=records)
    schema = T.StructType([*documents.schema, T.StructField("share", T.IntegerType()), T.StructField("day", T.DateType())])
    landed = land_records(spark, path, "csv", schema, root, "landed", records)
    damaged = F.col("damaged_record")
    text_there = damaged.contains(F.col("doc_id").cast("string")) & F.col("damaged_file").contains("/raw/")
    rejects = landed.rejects.select(
        *documents.columns, F.lit(None).cast("int").alias("share"), F.lit(None).cast("date").alias("day"),
        F.lit(True).alias("rejected"), text_there.alias("holds_record"),
    )
    accepted = landed.accepted.select("*", F.lit(False).alias("rejected"), F.lit(True).alias("holds_record"))
    counts = [F.lit(landed.rejected_rows).cast("long").alias("rejects"), F.lit(landed.read).cast("long").alias("records")]
    return accepted.unionByName(rejects).select("*", *counts)


@query_named(
    "publish_version",
    """
    SELECT step, o_orderstatus, count(*) AS rows, sum(o_totalprice)::DECIMAL(28, 2) AS total
    FROM (VALUES ('1 first', 'FOP'), ('2 second', 'FO'), ('3 refused', 'FO'), ('4 half written', 'FO'), ('5 rolled back', 'FOP')) s(step, kinds)
    JOIN (SELECT o_orderstatus, o_totalprice::DECIMAL(18, 2) AS o_totalprice FROM orders) ON contains(kinds, o_orderstatus)
    GROUP BY step, o_orderstatus
    """,
)
def publish_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers of the orders see after each of five steps: two versions, one refused, one unfinished, one taken back."""
    root = scratch_path(spark, "versions")
    orders = table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    seen = []

    def look(step: str) -> None:
        rows = read_published(spark, root, "orders").groupBy("o_orderstatus")
        seen.append(rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("o_totalprice").alias("total")).withColumn("step", F.lit(step)))

    def no_dear_orders(written: DataFrame) -> list[str]:
        count = written.where("o_totalprice < 0").count()
        return [f"{count} orders with a negative price"] if count else []

    publish(orders, root, "orders", ["o_orderstatus"], audits=[no_dear_orders])
    look("1 first")
    publish(orders.where("o_orderstatus <> 'P'"), root, "orders", ["o_orderstatus"], audits=[no_dear_orders])
    look("2 second")
    try:
        publish(orders.withColumn("o_totalprice", -F.col("o_totalprice")), root, "orders", audits=[no_dear_orders])
    except AuditError:
        look("3 refused")
    # What a job leaves that was killed before it published.
    folder = join_path(join_path(root, "orders"), "versions")
    write_dataset(orders.where("o_orderstatus = 'F'"), folder, "unfinished")
    look("4 half written")
    before = current_manifest(spark, root, "orders")["version"]
    if roll_back(spark, root, "orders") != before:
        look("5 rolled back")
    found = seen[0]
    for rows in seen[1:]:
        found = found.unionByName(rows)
    return found


@query_named("stream_replay", f"SELECT *, true AS replayed FROM ({STAGED})")
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events staged by micro-batches, the last of them delivered twice: every row is there once."""
    rows = table(spark, sf_dir, "events").count()
    config = land_events(spark, sf_dir, "replay", rows_per_file=max(1, rows // 8))
    size = max(1, folder_bytes(spark, join_path(config.source.path, DATASET)) // 3)
    schema, checkpoint = landing_events(spark, sf_dir).schema, scratch_path(spark, "replay-checkpoint")

    def run() -> list[int]:
        running = stream_batches(spark, config, DATASET, checkpoint, schema, bytes_per_batch=size)
        running.awaitTermination()
        return [progress["batchId"] for progress in running.recentProgress if progress["numInputRows"]]

    run()
    # As if the process had died after the last batch was written and before it was noted as done.
    commits = join_path(checkpoint, "commits")
    last = max(int(name) for name in file_names(spark, commits) if name.isdigit())
    delete_file(spark, join_path(commits, str(last)))
    again = run()
    found = staged(spark, join_path(config.dest.path, DATASET))
    return found.drop("batch_id", "month_part", "date_part").withColumn("replayed", F.lit(again == [last]))


LINES = "SELECT * FROM lineitem"
CHANGED_LINES = """
    SELECT * REPLACE (CASE WHEN l_discount >= 0.095 AND l_quantity >= 49.5 THEN l_tax + 1 ELSE l_tax END AS l_tax)
    FROM lineitem WHERE NOT (l_discount < 0.005 AND l_quantity < 1.5)
    UNION ALL SELECT * FROM lineitem WHERE l_tax >= 0.075 AND l_quantity BETWEEN 9.5 AND 10.5 AND l_discount >= 0.095
"""


def _changed(lines: DataFrame) -> DataFrame:
    """Some order lines with another tax, some gone, some there twice."""
    dear, cheap = "l_discount >= 0.095 and l_quantity >= 49.5", "l_discount < 0.005 and l_quantity < 1.5"
    twice = "l_tax >= 0.075 and l_quantity between 9.5 and 10.5 and l_discount >= 0.095"
    tax = F.when(F.expr(dear), F.col("l_tax") + 1).otherwise(F.col("l_tax"))
    return lines.where(f"not ({cheap})").withColumn("l_tax", tax).unionAll(lines.where(twice))


@query_named(
    "golden_tree",
    f"""
    SELECT *, 'only_in_actual' AS side, count(*) AS copies, 0::BIGINT AS unchanged
    FROM ({LINES} EXCEPT ALL ({CHANGED_LINES})) GROUP BY ALL
    UNION ALL
    SELECT *, 'only_in_expected' AS side, count(*) AS copies, 0::BIGINT AS unchanged
    FROM (({CHANGED_LINES}) EXCEPT ALL {LINES}) GROUP BY ALL
    """,
)
def golden_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines against changed ones by a tree of digests, and beside it the differences to themselves."""
    lines = table(spark, sf_dir, "lineitem")
    same = tree_difference(lines, lines.repartition(7))
    if same.levels != ((0, 0),):
        raise ValueError("equal bags have been told apart")
    found = tree_difference(lines, _changed(lines))
    return found.rows.withColumn("unchanged", F.lit(same.rows.count()).cast("long"))


@query_named(
    "enrich_skewed",
    """
    SELECT event_id, e.user_id, event_type, c_name, c_mktsegment
    FROM (SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN NULL WHEN value < 40 THEN 7 ELSE user_id END AS user_id FROM events) e
    LEFT JOIN customer ON e.user_id = c_custkey
    """,
)
def skewed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the names of their users, of whom one has a large share of all events, and some none."""
    user = F.when(F.col("event_type") == "error", None).when(F.col("value") < 40, 7).otherwise(F.col("user_id"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", user.cast("long").alias("user_id"))
    return enrich_skewed(events, table(spark, sf_dir, "customer"), {"user_id": "c_custkey"}, ["c_name", "c_mktsegment"])


@query_named(
    "bucketed_join",
    """
    SELECT l_orderkey, l_linenumber, o_custkey, o_orderstatus, l_quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def joined_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines and their orders from two bucketed tables, joined without a shuffle."""
    root = scratch_path(spark, "buckets")
    name = "quayside_" + root.rsplit("-", 1)[1]
    write_bucketed(table(spark, sf_dir, "lineitem"), f"{name}_lines", ["l_orderkey"], 8, join_path(root, "lines"))
    write_bucketed(table(spark, sf_dir, "orders"), f"{name}_orders", ["o_orderkey"], 8, join_path(root, "orders"))
    joined = bucketed_join(spark, f"{name}_lines", f"{name}_orders", ["l_orderkey"], ["o_orderkey"])
    return joined.select("l_orderkey", "l_linenumber", "o_custkey", "o_orderstatus", "l_quantity")


LUHN = """list_sum(list_transform(range(1, len(h) + 1), lambda i:
    CASE WHEN (len(h) - i) % 2 = 0 THEN h[i]::INTEGER ELSE h[i]::INTEGER * 2 // 10 + h[i]::INTEGER * 2 % 10 END)) % 10 = 0"""
MOD_97 = """list_reduce(list_prepend(0, list_transform(string_split(h[5:] || h[:4], ''), lambda c:
    CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
    lambda r, v: (r * (CASE WHEN v > 9 THEN 100 ELSE 10 END) + v) % 97) = 1"""
OCTETS = "len(list_filter(string_split(h, '.'), lambda o: o::INTEGER > 255)) = 0"


def _validated_sql(columns: tuple[tuple[str, str], ...]) -> str:
    checks = {"card": LUHN, "iban": MOD_97, "ipv4": OCTETS}
    return " UNION ALL ".join(
        f"""
        SELECT '{label}' AS "column", '{name}' AS pattern, count(*) FILTER (n > 0) AS rows, coalesce(sum(n), 0)::BIGINT AS hits
        FROM (SELECT len(list_filter(regexp_extract_all({column}, '{CHECKED[name][0]}'), lambda h: {check})) AS n FROM documents)
        """
        for label, column in columns
        for name, check in checks.items()
    )


# Numbers of 15 and 16 digits and account numbers made of each row's id, right for a part of the rows.
NUMBERED = "'no. ' || (4000000000000000 + doc_id * 7919)::VARCHAR || ' ' || 'DE' || lpad((doc_id % 97 + 2)::VARCHAR, 2, '0') || lpad(doc_id::VARCHAR, 18, '0')"


@query_named("pii_validated", _validated_sql((("text", "text"), ("numbers", f"({NUMBERED})"))))
def validated_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data whose check digits are right, in all texts and in numbers made of the ids."""
    documents = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    card = (doc * 7919 + 4_000_000_000_000_000).cast("string")
    account = F.concat(F.lit("DE"), F.lpad((doc % 97 + 2).cast("string"), 2, "0"), F.lpad(doc.cast("string"), 18, "0"))
    rows = documents.withColumn("numbers", F.concat(F.lit("no. "), card, F.lit(" "), account))
    return pii_validated(rows, ["text", "numbers"])


@query_named(
    "pseudonym_join",
    """
    SELECT event_id, user_id, c_name, event_type, value, true AS hidden
    FROM events JOIN customer ON user_id = c_custkey
    """,
)
def pseudonym_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and customers joined by pseudonyms, under a new key each run, and the ids brought back."""
    key = pseudonym_key(os.urandom(32))
    events = pseudonymise(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), ["user_id"], key)
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_custkey").alias("clear"), "c_name")
    joined = events.join(pseudonymise(customers, ["user_id"], key), "user_id")
    hidden = F.length("user_id") >= 36  # nonce and tag have 28 bytes, in Base64
    shown = decrypt_columns(joined.withColumn("hidden", hidden), [("user_id", "bigint")], key)
    return shown.where(F.col("user_id") == F.col("clear")).select("event_id", "user_id", "c_name", "event_type", "value", "hidden")


@query_named(
    "footer_counts",
    """
    SELECT year(o_orderdate)::INTEGER AS year_part, count(*) AS rows, min(o_orderkey) AS least_o_orderkey,
           max(o_orderkey) AS greatest_o_orderkey, count(*) AS scanned
    FROM orders GROUP BY ALL
    """,
)
def footer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged orders counted by year from the footers, and beside it by a scan."""
    root = make_folder(spark, scratch_path(spark, "footers"))
    orders = table(spark, sf_dir, "orders").withColumn("year_part", F.year("o_orderdate"))
    path = write_dataset(orders, root, "orders", ["year_part"])
    stated = footer_rows(spark, path, ["year_part"], extremes=["o_orderkey"]).collect()
    kind = "year_part int, rows long, least_o_orderkey long, greatest_o_orderkey long"
    scanned = staged(spark, path).groupBy("year_part").agg(F.count("o_orderdate").alias("scanned"))
    return spark.createDataFrame(stated, kind).join(scanned, "year_part")
