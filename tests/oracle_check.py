"""Compare every registered query with its SQL, as multisets of rows.

    python tests/oracle_check.py SF_DIR [QUERY ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bytearray):
        return bytes(value)
    return tuple(value) if isinstance(value, list) else value


def bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, name: str, sf_dir: str) -> list[str]:
    """What differs between a query and its SQL; empty if they agree."""
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, sf_dir)
    ours = bag(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return [] if ours else ["no rows"]
    relation = connection.sql(sql)
    theirs = bag(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} against {sorted(relation.columns)}"]
    left, right = ours - theirs, theirs - ours
    if left or right:
        return [
            f"{left.total()} rows only in Spark, {right.total()} only in SQL",
            *[f"  spark {row}" for row in list(left)[:2]],
            *[f"  sql   {row}" for row in list(right)[:2]],
        ]
    return []


if __name__ == "__main__":
    from quayside.session import build_session

    sf_dir, *wanted = sys.argv[1:]
    spark = build_session(
        "oracle", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry

    connection = connect(sf_dir)
    failed = 0
    for name in wanted or entry.queries():
        begin = time.time()
        try:
            found = differences(spark, connection, name, sf_dir)
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        has_sql = "sql" if name in entry.oracle_sql() else "rows only"
        verdict = "FAIL" if found else "ok  "
        print(f"{verdict} {name} ({has_sql}) {time.time() - begin:.2f}s", *found, sep="\n     ")
    print(f"{failed} failed")
    sys.exit(bool(failed))
