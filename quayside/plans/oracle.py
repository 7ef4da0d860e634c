"""The registered queries in DuckDB SQL over the same tables."""

from __future__ import annotations

STAGED = """
    SELECT event_id::VARCHAR AS event_id, event_type,
           coalesce(array_to_string([event_type, props], ','), '') AS location_source,
           epoch_us(ts) * 1000 AS "timestamp", user_id::VARCHAR AS user_id,
           try_cast(value AS DECIMAL(12,7)) AS value, ts::DATE AS date,
           month(ts)::VARCHAR AS month,
           sha256(event_id::VARCHAR) AS masked_event_id, sha256(user_id::VARCHAR) AS masked_user_id
    FROM events
"""

# Hex digits of the row's hash as a number.
DRAW = "('0x' || substr(hex, {}, {}))::BIGINT"

ACTIVES = f"""
    WITH hashed AS (
        SELECT {{column}} AS i, sha256('0:' || {{column}}::VARCHAR) AS hex FROM {{table}}
    ), numbers AS (
        SELECT i, {DRAW.format(1, 15)} AS one, {DRAW.format(16, 15)} AS two,
               {DRAW.format(31, 15)} AS three
        FROM hashed
    ), drawn AS (
        SELECT i, one % 1073741824 AS d_lat, one // 1073741824 AS d_lon,
               two % 4294967296 AS d_time, two // 4294967296 % 16384 AS d_city,
               two // 70368744177664 AS d_state, three % 1024 AS d_cat,
               three // 1024 % 1024 AS d_gran, three // 1048576 % 1024 AS d_one,
               three // 1073741824 % 1024 AS d_two, three // 1099511627776 AS d_date
        FROM numbers
    )
    SELECT (i + 1)::VARCHAR AS advertising_id,
           ['Alderport', 'Brightwater', 'Cedarfield', 'Dunmouth', 'Eastmere', 'Foxhollow',
            'Graniteford', 'Harborview', 'Ironbridge', 'Juniper Bay', 'Kingsreach',
            'Lakehaven'][d_city % 12 + 1] AS city,
           ['continents', 'islands', 'countries', 'regions', 'state', 'cities', 'neighborhoods',
            'villages'][d_cat % 8 + 1] AS location_category,
           ['urban', 'rural', 'suburban'][d_gran % 3 + 1] AS location_granularities,
           'ABCDEFGH'[d_one % 8 + 1] || ',' || 'ABCDEFGH'[d_two % 8 + 1] AS location_source,
           ['Alaska', 'Colorado', 'Georgia', 'Idaho', 'Maine', 'Nevada', 'Ohio', 'Oregon',
            'Texas', 'Utah'][d_state % 10 + 1] AS state,
           d_time % 1700000000 * 1000000000 AS "timestamp",
           (i + 5000)::VARCHAR AS user_id,
           (d_lat % 360000001 - 180000000)::DOUBLE / 2000000::DOUBLE AS user_latitude,
           (d_lon % 360000001 - 180000000)::DOUBLE / 1000000::DOUBLE AS user_longitude,
           DATE '2022-01-01' + (d_date % 365)::INTEGER AS date,
           month(DATE '2022-01-01' + (d_date % 365)::INTEGER)::VARCHAR AS month
    FROM drawn
"""

PERTURBED = """
    SELECT event_id, ts, user_id, event_type,
           CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS value, props
    FROM events WHERE event_type <> 'click'
    UNION ALL
    SELECT * FROM events WHERE event_type = 'view'
"""

ORDERS = "SELECT * FROM orders"

ORACLE = {
    "scan_dataset": "SELECT * FROM events",
    "scan_csv": ORDERS,
    "scan_json": ORDERS,
    "scan_orc": ORDERS,
    "golden_scan": f"SELECT *, '' AS unreadable FROM ({STAGED})",
    "staged_read": f"SELECT *, month::INTEGER AS month_part, date AS date_part FROM ({STAGED})",
    "pruned_read": f"""
        SELECT *, month::INTEGER AS month_part, date AS date_part FROM ({STAGED})
        WHERE date = DATE '2024-01-15'
    """,
    "union_parts": """
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_type = 'purchase' THEN value END AS value,
               CASE WHEN event_type <> 'purchase' THEN props END AS props
        FROM events
    """,
    "synthetic": ACTIVES.format(column="event_id", table="events"),
    "mask_sha256": """
        SELECT event_id, user_id, sha256(event_id::VARCHAR) AS masked_event_id,
               sha256(user_id::VARCHAR) AS masked_user_id
        FROM events
    """,
    "mask_only": "SELECT c_custkey, sha256(c_name) AS masked_c_name FROM customer",
    "cast_decimal": "SELECT event_id, try_cast(value AS DECIMAL(12,7)) AS value FROM events",
    "cast_overflow": """
        SELECT o_orderkey, try_cast(o_totalprice AS DECIMAL(12,7)) AS o_totalprice FROM orders
    """,
    "join_array": """
        SELECT c_custkey,
               CASE WHEN c_acctbal < 0 THEN concat_ws(',', c_mktsegment, c_nationkey)
                    ELSE concat_ws(',', c_mktsegment, c_name, c_nationkey) END AS labels,
               CASE WHEN c_acctbal < 0 THEN ''
                    ELSE concat_ws(' | ', c_mktsegment, c_name, c_nationkey) END AS maybe_labels
        FROM customer
    """,
    "partition_copies": """
        SELECT event_id::VARCHAR AS event_id, ts::DATE AS date, month(ts)::VARCHAR AS month,
               month(ts)::VARCHAR AS month_part, ts::DATE AS date_part
        FROM events
    """,
    "scalar_functions": f"""
        SELECT event_id, month(ts)::VARCHAR AS month, epoch_ns(ts) AS nanos,
               (event_id + 5000)::VARCHAR AS id_text,
               ['urban', 'rural', 'suburban'][{DRAW.format(1, 8)} % 3 + 1] AS word,
               DATE '2022-01-01' + ({DRAW.format(9, 8)} % 365)::INTEGER AS day
        FROM (SELECT *, sha256(event_id::VARCHAR) AS hex FROM events)
    """,
    "pipeline_events": f"SELECT *, month AS month_part, date AS date_part FROM ({STAGED})",
    "partition_counts": """
        SELECT month(ts)::INTEGER AS month_part, ts::DATE AS date_part, count(*) AS rows
        FROM events GROUP BY ALL
    """,
    "overwrite_days": """
        SELECT year(o_orderdate)::INTEGER AS year_part, o_orderstatus, count(*) AS rows
        FROM orders WHERE year(o_orderdate) < 1997 OR o_orderstatus = 'O' GROUP BY ALL
    """,
    "pipeline_report": """
        SELECT 'events' AS dataset, c.*, n AS src_rows, n AS dst_rows, true AS rows_match,
               'records matched, datatype '
                   || CASE WHEN type_match THEN 'matched' ELSE 'mismatched' END AS verdict,
               true AS ok
        FROM (VALUES
            ('event_id', true, 'string', 'string', true),
            ('event_type', true, 'string', 'string', true),
            ('location_source', true, 'array<string>', 'string', false),
            ('timestamp', true, 'bigint', 'bigint', true),
            ('user_id', true, 'string', 'string', true),
            ('value', true, 'double', 'decimal(12,7)', false),
            ('date', true, 'date', 'date', true),
            ('month', true, 'string', 'string', true)
        ) c("column", in_staging, src_type, dst_type, type_match),
        (SELECT count(*) AS n FROM events)
    """,
    "csv_export": """
        SELECT event_id::VARCHAR AS event_id, event_type,
               array_to_string([event_type, props], ',') AS location_source,
               (epoch_us(ts) * 1000)::VARCHAR AS "timestamp", user_id::VARCHAR AS user_id,
               value::VARCHAR AS value, ts::DATE::VARCHAR AS date, month(ts)::VARCHAR AS month
        FROM events
    """,
    "parquet_export": ACTIVES.format(column="o_orderkey", table="orders"),
    "load_table": f"SELECT * FROM ({STAGED}) UNION ALL SELECT * FROM ({STAGED})",
    "load_repeatable": """
        SELECT load_id, event_type, count(*) AS rows
        FROM events, (VALUES ('first'), ('second')) loads(load_id) GROUP BY ALL
    """,
    "stream_load": f"SELECT *, month::INTEGER AS month_part, date AS date_part FROM ({STAGED})",
    "stream_table": STAGED,
    "row_count": "SELECT count(*) AS rows FROM lineitem",
    "first_rows": "SELECT * FROM events ORDER BY event_id LIMIT 5",
    "schema_report": """
        SELECT c.*, n AS rows
        FROM (VALUES (1, 'event_id', 'bigint'), (2, 'ts', 'timestamp_ntz'), (3, 'user_id', 'bigint'),
                     (4, 'event_type', 'string'), (5, 'value', 'double'), (6, 'props', 'string')
        ) c(position, "column", type), (SELECT count(*) AS n FROM events)
    """,
    "columns_added": """
        SELECT c.*, n AS filled
        FROM (VALUES ('masked_event_id', 'staging', true), ('masked_user_id', 'staging', true),
                     ('month_part', 'staging', true), ('date_part', 'staging', true)
        ) c("column", side, expected), (SELECT count(*) AS n FROM events)
    """,
    "lost_rows_verdicts": """
        SELECT 'orders' AS dataset, c.*, n AS src_rows, m AS dst_rows, n = m AS rows_match,
               CASE WHEN NOT in_staging THEN 'column not in staging'
                    ELSE 'records ' || CASE WHEN n = m THEN 'matched' ELSE 'mismatched' END
                         || ', datatype ' || CASE WHEN type_match THEN 'matched' ELSE 'mismatched' END
               END AS verdict,
               n = m AND type_match AS ok
        FROM (VALUES
            ('o_orderkey', true, 'bigint', 'bigint', true),
            ('o_custkey', true, 'bigint', 'bigint', true),
            ('o_orderstatus', true, 'string', 'string', true),
            ('o_totalprice', true, 'double', 'float', false),
            ('o_orderdate', true, 'timestamp_ntz', 'timestamp_ntz', true),
            ('o_orderpriority', false, 'string', NULL, false)
        ) c("column", in_staging, src_type, dst_type, type_match),
        (SELECT count(*) AS n, count(*) FILTER (o_orderstatus <> 'P') AS m FROM orders)
    """,
    "golden_diff": f"""
        SELECT *, 'only_in_actual' AS side, count(*) AS copies
        FROM (SELECT * FROM events EXCEPT ALL ({PERTURBED})) GROUP BY ALL
        UNION ALL
        SELECT *, 'only_in_expected' AS side, count(*) AS copies
        FROM (({PERTURBED}) EXCEPT ALL SELECT * FROM events) GROUP BY ALL
    """,
    "golden_passed": """
        SELECT event_type, 0::BIGINT AS only_in_actual, 0::BIGINT AS only_in_expected, true AS passed,
               count(*) AS rows
        FROM events GROUP BY event_type
    """,
    "golden_failed": f"""
        SELECT (SELECT count(*) FROM (SELECT * FROM events EXCEPT ALL ({PERTURBED}))) AS only_in_actual,
               (SELECT count(*) FROM (({PERTURBED}) EXCEPT ALL SELECT * FROM events)) AS only_in_expected,
               false AS passed
    """,
    "golden_files": """
        SELECT 'events' AS dataset, 'all.csv' AS golden, 0::BIGINT AS only_in_actual,
               0::BIGINT AS only_in_expected, true AS passed
        UNION ALL
        SELECT 'events', 'no_clicks.csv', count(*), 0, count(*) = 0
        FROM events WHERE event_type = 'click'
    """,
    "bag_except": """
        SELECT l_returnflag AS piece, l_linestatus AS copy, l_suppkey FROM lineitem
        EXCEPT ALL SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem
    """,
    "rows_per_partition": """
        SELECT count(*)::BIGINT AS rows, true AS each_once, true AS none_empty FROM lineitem
    """,
    "config_run": f"""
        SELECT event_id, 'masked_event_id,masked_user_id,masked_value' AS masks,
               sha256(masked_event_id || ',' || masked_user_id || ',' || masked_value) AS in_order
        FROM (SELECT *, sha256(v) AS masked_value FROM ({STAGED}) s
              JOIN (SELECT event_id::VARCHAR AS event_id, value::VARCHAR AS v FROM events) USING (event_id))
    """,
    "column_checks": """
        SELECT c.*, n AS rows
        FROM (VALUES
            ('mask', 'User_id', 'not present'),
            ('mask', 'location_source', 'is no plain value'),
            ('to_decimal', 'price', 'not present'),
            ('to_comma', 'value', 'is neither an array of plain values nor a string'),
            ('partition', 'region', 'not present')
        ) c("group", "column", problem), (SELECT count(*) AS n FROM events)
    """,
    "location_checks": """
        SELECT c.*, n AS rows
        FROM (VALUES
            ('source', 'ok'), ('missing source', 'not found'), ('destination apart', 'ok'),
            ('destination in source', 'overlaps'), ('missing destination', 'not found'),
            ('key', 'ends with its name')
        ) c(place, outcome), (SELECT count(*) AS n FROM orders)
    """,
    "ddl_load": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "load_text_partitions": "SELECT c_custkey, lpad(c_nationkey::VARCHAR, 3, '0') AS code FROM customer",
    "csv_round_trip": """
        SELECT *,
               CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' || text || ' '
                    WHEN 3 THEN '"' || text || chr(92) || '"' || chr(13) || chr(10) || ',x' || chr(92)
                    ELSE text END AS odd
        FROM documents
    """,
    "partial_run": """
        SELECT 'orders' AS dataset, c.*, n AS src_rows, n AS dst_rows, true AS rows_match,
               'records matched, datatype '
                   || CASE WHEN type_match THEN 'matched' ELSE 'mismatched' END AS verdict,
               true AS ok
        FROM (VALUES
            ('o_orderkey', true, 'bigint', 'bigint', true),
            ('o_custkey', true, 'bigint', 'bigint', true),
            ('o_orderstatus', true, 'string', 'string', true),
            ('o_totalprice', true, 'double', 'decimal(12,2)', false),
            ('o_orderdate', true, 'timestamp_ntz', 'timestamp_ntz', true),
            ('o_orderpriority', true, 'string', 'string', true),
            ('year', true, 'int', 'int', true),
            ('region', true, 'string', 'string', true)
        ) c("column", in_staging, src_type, dst_type, type_match),
        (SELECT count(*) AS n FROM orders WHERE year(o_orderdate) >= 1997 AND o_orderstatus = 'O')
    """,
    "mask_keyed": """
        SELECT count(DISTINCT user_id) AS ids, count(DISTINCT user_id) AS masks,
               count(DISTINCT user_id) AS pairs, 0::BIGINT AS plain, count(user_id) AS rows
        FROM events
    """,
    "encrypt_round_trip": "SELECT *, 0::INTEGER AS leaks FROM customer",
    "enrich_join": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name, p_brand, p_type
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey
    """,
}

# The patterns of the scan for personal data.
PII = {
    "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+",
    "ipv4": "[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}",
    "phone": "[+][0-9]{1,3} ?[(]?[0-9]{2,4}[)]?[ -]?[0-9]{3}[ -]?[0-9]{4}",
    "card": "[0-9]{13,16}",
}
ORACLE["pii_scan"] = " UNION ALL ".join(
    f"""
    SELECT '{column}' AS "column", '{name}' AS pattern,
           count(*) FILTER (regexp_matches({column}, '{regex}')) AS rows,
           coalesce(sum(len(regexp_extract_all({column}, '{regex}'))), 0)::BIGINT AS hits
    FROM documents
    """
    for column in ("text", "source")
    for name, regex in PII.items()
)

# The same report, whether staging was written or only planned.
ORACLE["column_report"] = ORACLE["pipeline_report"]
ORACLE["dataset_verdicts"] = (
    ORACLE["pipeline_report"].replace("'events'", "d.dataset").replace(
        "(SELECT count(*) AS n FROM events)",
        "(SELECT CASE WHEN event_type = 'click' THEN 'clicks' ELSE 'others' END AS dataset,"
        " count(*) AS n FROM events GROUP BY ALL) d",
    )
)
