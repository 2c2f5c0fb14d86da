"""DuckDB SQL equivalents of the registered jobs, over the driver tables.

Each statement computes, from the original tables, what the Spark job must
return after staging, reading, transforming and writing.  Column names and
types follow the Spark output.
"""

from __future__ import annotations

# Sensor readings as the flagship job produces them (error events carry no
# temperature and are dropped).
_SENSOR_ROWS = """
SELECT CAST(event_id AS VARCHAR) AS message_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time,
       'sensor_' || CAST(user_id AS VARCHAR) AS sensor_id,
       value AS temperature,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
       CAST(event_id % 100 + 950 AS INTEGER) AS pressure
FROM events WHERE event_type <> 'error'
"""

# The same readings in the declared warehouse table's types.
_SENSOR_TABLE = """
SELECT CAST(event_id AS VARCHAR) AS message_id, date_trunc('second', ts) AS event_time,
       'sensor_' || CAST(user_id AS VARCHAR) AS sensor_id, value AS temperature,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS humidity,
       CAST(event_id % 100 + 950 AS BIGINT) AS pressure
FROM events WHERE event_type <> 'error'
"""

# The message text as Spark's to_json writes it: fields in declared order,
# NULL fields left out.
_MESSAGE_TEXT = """
'{"id":"' || CAST(event_id AS VARCHAR)
 || '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
 || '","value":{"sensor_id":"sensor_' || CAST(user_id AS VARCHAR) || '"'
 || CASE WHEN event_type = 'error' THEN '' ELSE ',"temperature":' || CAST(value AS VARCHAR) END
 || ',"humidity":' || json_extract_string(props, '$.k')
 || ',"pressure":' || CAST(event_id % 100 + 950 AS VARCHAR) || '}}'
"""

_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
"""

_RECORDS = """
SELECT doc_id % 10 AS {uid}, doc_id AS id, concat_ws(' ', lang, source) AS title, text AS body FROM documents
"""

_WEATHER_ROWS = """
SELECT value AS latitude, CAST(user_id AS DOUBLE) AS longitude, event_type AS timezone,
       'iso8601' AS format_time, date_trunc('minute', ts) AS "time",
       value AS temperature, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS windspeed
FROM events
"""

ORACLE: dict[str, str] = {
    "sensor_flatten": _SENSOR_ROWS,
    "stream_jdbc_ingest": _SENSOR_TABLE,
    "weather_jdbc_load": _WEATHER_ROWS,
    "records_full_refresh": _RECORDS.format(uid="user_id"),
    "required_fields_check": """
SELECT 'complete' AS "case", '' AS missing, count(*) FILTER (WHERE event_type <> 'error') AS "rows" FROM events
UNION ALL
SELECT 'without sensor_id' AS "case", 'sensor_id' AS missing, CAST(0 AS BIGINT) AS "rows"
""",
    "stream_sensor_ingest": _SENSOR_TABLE,
    "stream_sorted_layout": _SENSOR_TABLE,
    "stream_watermark_passthrough": _SENSOR_TABLE,
    "stream_redelivered": _SENSOR_TABLE,
    "stream_restart_resume": _SENSOR_TABLE,
    "kafka_raw_view": f"""
SELECT CAST(event_id AS VARCHAR) AS "offset", ts AS "timestamp", {_MESSAGE_TEXT} AS raw_data FROM events
""",
    "event_time_format": """
SELECT 'events' AS source, event_id AS key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM events
UNION ALL
SELECT 'orders' AS source, o_orderkey AS key, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS event_time FROM orders
""",
    "json_envelope_encode": """
SELECT CAST(event_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
       'sensor_' || CAST(user_id AS VARCHAR) AS sensor_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS temperature,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
       CAST(event_id % 100 + 950 AS INTEGER) AS pressure
FROM events
""",
    "weather_flatten": _WEATHER_ROWS,
    "weather_landed_flatten": _WEATHER_ROWS,
    "weather_core": """
SELECT value AS latitude, CAST(user_id AS DOUBLE) AS longitude, event_type AS timezone FROM events
""",
    "json_records_scan": _RECORDS.format(uid='"userId"'),
    "positional_rename": _RECORDS.format(uid="user_id"),
    "records_csv_load": _RECORDS.format(uid="user_id"),
    "csv_header_scan": """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
       CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
FROM part
""",
    "csv_inferred_scan": """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""",
    # One header line in each of the export's four files.
    "csv_noheader_scan": """
SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, CAST(c_nationkey AS VARCHAR) AS _c2,
       CAST(c_acctbal AS VARCHAR) AS _c3, c_mktsegment AS _c4
FROM customer
UNION ALL
SELECT 'c_custkey' AS _c0, 'c_name' AS _c1, 'c_nationkey' AS _c2, 'c_acctbal' AS _c3, 'c_mktsegment' AS _c4
FROM (SELECT DISTINCT c_custkey % 4 AS file_no FROM customer)
""",
    "csv_multiline_scan": """
SELECT CAST(conv_id AS VARCHAR) AS _c0, CAST(turn AS VARCHAR) AS _c1, role AS _c2, text AS _c3 FROM conversations
""",
    "json_array_split_scan": _RECORDS.format(uid='"userId"'),
    "csv_records_split_scan": """
SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations
""",
    "parquet_merge_schema": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL::VARCHAR AS o_orderpriority
FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, NULL::VARCHAR AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' OR o_orderdate IS NULL
""",
    "parquet_widened": """
SELECT p_partkey, p_name, p_brand, CASE WHEN p_partkey % 3 <> 2 THEN p_type END AS p_type,
       CAST(p_size AS DOUBLE) AS p_size, p_retailprice
FROM part
""",
    "range_source": "SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS id FROM orders",
    # One text file per landing group: ceil(rows / 2000) groups by event_id; and
    # the writer's empty marker, a hidden name that a complete listing has too.
    "object_listing": """
WITH n AS (SELECT CAST(ceil(count(*) / 2000.0) AS BIGINT) AS n FROM events)
SELECT DISTINCT 'file=' || CAST(event_id % n AS VARCHAR) AS prefix, 'txt' AS extension FROM events, n
UNION ALL
SELECT '' AS prefix, '' AS extension
""",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "load_report": "SELECT count(*) AS row_count, 11 AS column_count FROM lineitem",
    "case_sensitive_select": "SELECT event_id AS lower_id, user_id AS upper_id FROM events",
    "jdbc_append": _ORDERS,
    "jdbc_full_refresh": _ORDERS,
    "jdbc_append_once": _ORDERS,
    "jdbc_change_refresh": _ORDERS,
    "raw_land_overwrite": "SELECT page_id, html AS payload FROM pages",
    "sorted_layout": _SENSOR_TABLE,
    "batch_row_counts": """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE event_type <> 'error') AS valid_rows, true AS within_cap
FROM events
""",
    "stream_progress": """
SELECT count(*) AS rows_read, count(*) FILTER (WHERE event_type <> 'error') AS rows_written, true AS batches_agree FROM events
""",
    "stream_empty_batch": """
SELECT count(*) AS rows_in, CAST(0 AS BIGINT) AS rows_written, CAST(0 AS BIGINT) AS batches_written FROM events
""",
    "stream_fanout": """
SELECT 'raw' AS branch, count(*) AS rows_in, count(*) AS rows_out, count(*) AS rows_held FROM events
UNION ALL
SELECT 'warehouse', count(*), count(*) FILTER (WHERE event_type <> 'error'), count(*) FILTER (WHERE event_type <> 'error')
FROM events
UNION ALL
SELECT 'rejected', count(*), count(*) FILTER (WHERE event_type = 'error'), count(*) FILTER (WHERE event_type = 'error')
FROM events
""",
    "stream_reject_reasons": """
WITH faults AS (
  SELECT CASE WHEN event_id % 13 = 1 THEN 'not_json' WHEN event_id % 13 = 2 THEN 'not_an_object'
              WHEN event_id % 13 = 3 OR user_id IS NULL THEN 'no_sensor'
              WHEN event_type = 'error' OR value IS NULL THEN 'no_temperature'
              WHEN event_id % 13 = 4 THEN 'temperature_not_a_number' ELSE 'accepted' END AS reason
  FROM events),
reasons AS (SELECT unnest(['not_json', 'not_an_object', 'no_sensor', 'no_temperature', 'temperature_not_a_number', 'accepted']) AS reason)
SELECT r.reason, count(f.reason) AS "rows" FROM reasons r LEFT JOIN faults f ON r.reason = f.reason GROUP BY r.reason
""",
}
