"""Inputs of the registered queries, derived from the given tables.

Each is one SQL text that Spark and DuckDB both run: ``{name}`` stands for a given
table or another fixture, ``@NTZ`` for the zone-less timestamp type.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

W = "1999-01-01 00:00:00"  # stored watermark
NOW = "2024-01-30 12:00:00"  # time of the reports
RUN = "2024-02-01 00:00:00"  # time of the runs

FIXTURES = {
    # Source table with a single key and a watermark column.
    "fx_source_orders": """
        SELECT o_orderkey AS pkid, o_custkey, o_orderstatus,
               CAST(round(o_totalprice * 100) AS BIGINT) AS total_cents,
               o_orderdate AS db_update_date
        FROM {orders}""",
    # Stale copy: a third missing, values off by one, and rows the source has lost.
    "fx_target_orders": """
        SELECT pkid, o_custkey, o_orderstatus, total_cents - 1 AS total_cents, db_update_date
        FROM {fx_source_orders} WHERE pkid % 3 <> 0
        UNION ALL
        SELECT pkid + 10000000 AS pkid, o_custkey, o_orderstatus, total_cents, db_update_date
        FROM {fx_source_orders} WHERE pkid % 50 = 0""",
    # Composite key, made unique.
    "fx_source_items": """
        SELECT l_orderkey, l_linenumber,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
               max(l_shipdate) AS db_update_date
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "fx_target_items": """
        SELECT l_orderkey, l_linenumber, qty + 1 AS qty, db_update_date
        FROM {fx_source_items} WHERE (l_orderkey + l_linenumber) % 4 <> 0""",
    # Parsed change log of two tables that share one log.
    "fx_changelog": """
        SELECT event_id AS lsn, ts AS committed_at, 'data' AS schema_name,
               CASE WHEN event_id % 10 = 0 THEN 'rec_items' ELSE 'users' END AS table_name,
               CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
               user_id AS pkid
        FROM {events}""",
    # Raw lines: transaction noise, look-alike text, key changes, a 3-column key.
    "fx_wal_lines": """
        SELECT event_id AS lsn,
          CASE
            WHEN event_id % 7 = 0 THEN concat('BEGIN ', CAST(event_id AS STRING))
            WHEN event_id % 7 = 6 THEN concat('COMMIT ', CAST(event_id AS STRING))
            WHEN event_id % 11 = 0 THEN concat(
                'table data.var_activity: UPDATE: assignment_id[integer]:', CAST(user_id AS STRING),
                ' period_id[integer]:', CAST(event_id % 12 AS STRING),
                ' prior_period_id[integer]:', CAST((event_id + 11) % 12 AS STRING))
            WHEN event_id % 13 = 0 THEN concat(
                'table data.users_archive: INSERT: pkid[integer]:', CAST(user_id AS STRING),
                ' note[text]:''table data.users: DELETE:''')
            WHEN event_id % 97 = 1 THEN concat(
                'table data.users: UPDATE: old-key: pkid[integer]:', CAST(user_id AS STRING),
                ' new-tuple: pkid[integer]:', CAST(user_id + 1000 AS STRING),
                ' value[numeric]:1.00')
            WHEN event_id % 89 = 2 THEN concat(
                'table data.users: UPDATE: note[text]:'' it''''s pkid[integer]:5 '' pkid[integer]:',
                CAST(user_id AS STRING))
            WHEN event_id % 83 = 3 THEN 'table data.users: DELETE: (no-tuple-data)'
            ELSE concat('table data.users: ',
                 CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE'
                                 ELSE 'UPDATE' END,
                 ': pkid[integer]:', CAST(user_id AS STRING),
                 ' value[numeric]:', CAST(CAST(value AS DECIMAL(10,2)) AS STRING))
          END AS data
        FROM {events}""",
    # What the lines of table users mean, from the same events without any text.
    "fx_wal_meaning": """
        SELECT event_id AS lsn,
               CASE WHEN event_id % 97 = 1 OR event_id % 89 = 2 THEN 'U'
                    WHEN event_id % 83 = 3 THEN 'D'
                    WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D'
                    ELSE 'U' END AS op,
               CASE WHEN event_id % 97 = 1 THEN user_id + 1000
                    WHEN event_id % 89 = 2 THEN user_id
                    WHEN event_id % 83 = 3 THEN NULL ELSE user_id END AS pkid,
               CASE WHEN event_id % 97 = 1 THEN user_id END AS old_pkid
        FROM {events}
        WHERE event_id % 7 NOT IN (0, 6) AND event_id % 11 <> 0 AND event_id % 13 <> 0""",
    "fx_wal_changes": """
        SELECT lsn, op, pkid FROM {fx_wal_meaning}
        UNION ALL
        SELECT lsn, 'D' AS op, old_pkid AS pkid FROM {fx_wal_meaning} WHERE old_pkid IS NOT NULL""",
    # Current source rows; one key in twenty no longer exists.
    "fx_source_users": """
        SELECT c_custkey AS pkid, c_name AS full_name, c_nationkey AS nation_id,
               CAST(round(c_acctbal * 100) AS BIGINT) AS balance_cents
        FROM {customer} WHERE c_custkey % 20 <> 19""",
    # Stale target; it still has some of the rows the source has lost.
    "fx_target_users": """
        SELECT c_custkey AS pkid, concat(c_name, ' (old)') AS full_name,
               c_nationkey AS nation_id, CAST(round(c_acctbal * 100) AS BIGINT) AS balance_cents
        FROM {customer} WHERE c_custkey % 2 = 0 OR c_custkey % 40 = 39""",
    "fx_database_registry": """
        SELECT DISTINCT concat('db', CAST(user_id % 3 AS STRING)) AS database_id,
               concat('app_', CAST(user_id % 3 AS STRING)) AS source_db_name,
               'src.example.com' AS host, 5432 AS port, 'data' AS source_schema,
               concat('TENANT_', CAST(user_id % 3 AS STRING)) AS target_schema,
               (user_id % 3) <> 2 AS is_active,
               CAST('2024-01-01 00:00:00' AS @NTZ) AS created_at,
               CAST('2024-01-01 00:00:00' AS @NTZ) AS updated_at
        FROM {events}""",
    "fx_table_registry": """
        SELECT DISTINCT concat('db', CAST(user_id % 3 AS STRING), '_t', CAST(user_id % 14 AS STRING)) AS table_id,
               concat('db', CAST(user_id % 3 AS STRING)) AS database_id,
               'data' AS source_schema,
               concat('t', CAST(user_id % 14 AS STRING)) AS source_table,
               concat('TENANT_', CAST(user_id % 3 AS STRING)) AS target_schema,
               upper(concat('t', CAST(user_id % 14 AS STRING))) AS target_table,
               CASE WHEN user_id % 14 = 6 THEN '' ELSE 'pkid' END AS primary_key_column,
               (user_id % 14) <> 13 AS sync_enabled,
               CASE WHEN user_id % 14 < 7 THEN 'wal' WHEN user_id % 14 = 7 THEN 'cdc'
                    WHEN user_id % 14 = 8 THEN NULL ELSE 'FULL' END AS sync_method,
               CASE WHEN user_id % 14 = 7 THEN 'db_update_date' END AS cdc_column,
               CASE WHEN user_id % 14 < 7 THEN concat('slot_', CAST(user_id % 3 AS STRING)) END AS wal_slot_name,
               CASE WHEN user_id % 14 = 7 THEN CAST('2023-12-31 00:00:00' AS @NTZ) END AS last_watermark,
               CAST(NULL AS @NTZ) AS last_sync_at, CAST(NULL AS STRING) AS last_sync_status,
               CAST(NULL AS BIGINT) AS last_sync_records, CAST(NULL AS BIGINT) AS last_cdc_rows,
               CASE WHEN user_id % 14 = 9 THEN 500 END AS batch_size,
               CASE WHEN user_id % 14 = 10 THEN 'abc' END AS schema_fingerprint,
               1 AS schema_version,
               CAST('2024-01-01 00:00:00' AS @NTZ) AS created_at,
               CAST('2024-01-01 00:00:00' AS @NTZ) AS updated_at
        FROM {events}""",
    # Append-only run log, without the rows of one table, which has never run.
    "fx_sync_log": """
        SELECT event_id AS log_id,
               concat('db', CAST(user_id % 3 AS STRING), '_t', CAST(user_id % 14 AS STRING)) AS table_id,
               CASE WHEN event_type = 'error' THEN concat('error: timeout ', CAST(event_id AS STRING))
                    ELSE 'success' END AS sync_status,
               CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT)
                    ELSE CAST(floor(value) AS BIGINT) END AS sync_records,
               value / 10 AS sync_duration_sec,
               CASE WHEN user_id % 14 = 7 AND event_type <> 'error' THEN ts END AS new_watermark,
               CASE WHEN user_id % 14 <= 7 AND event_type <> 'error'
                    THEN CAST(floor(value) AS BIGINT) END AS cdc_rows,
               ts AS logged_at
        FROM {events} WHERE user_id % 42 <> 12""",
    # Newest log row per table, and the registry after it was merged in.
    "fx_log_latest": """
        SELECT log_id, table_id, sync_status, sync_records, sync_duration_sec, new_watermark,
               cdc_rows, logged_at
        FROM (SELECT *, row_number() OVER (PARTITION BY table_id
                                           ORDER BY logged_at DESC, log_id DESC) AS rn
              FROM {fx_sync_log}) AS ranked
        WHERE rn = 1""",
    "fx_registry_run": """
        SELECT t.table_id, t.database_id, t.source_schema, t.source_table, t.target_schema,
               t.target_table, t.primary_key_column, t.sync_enabled, t.sync_method, t.cdc_column,
               t.wal_slot_name, coalesce(l.new_watermark, t.last_watermark) AS last_watermark,
               l.logged_at AS last_sync_at, l.sync_status AS last_sync_status,
               l.sync_records AS last_sync_records, l.cdc_rows AS last_cdc_rows, t.batch_size,
               t.schema_fingerprint, t.schema_version, t.created_at,
               CASE WHEN l.table_id IS NULL THEN t.updated_at
                    ELSE CAST('2024-02-01 00:00:00' AS @NTZ) END AS updated_at
        FROM {fx_table_registry} t LEFT JOIN {fx_log_latest} l ON t.table_id = l.table_id""",
    # One run result per event.
    "fx_results": """
        SELECT concat('t', CAST(event_id AS STRING)) AS table_id,
               CASE WHEN event_id % 3 = 0 THEN 'full' WHEN event_id % 3 = 1 THEN 'cdc' ELSE 'wal' END AS method,
               CASE WHEN event_type = 'error' THEN repeat(props, 60) END AS error,
               CAST(floor(value) AS BIGINT) AS row_count, value / 7 AS seconds,
               CASE WHEN event_id % 3 = 1 THEN ts END AS new_watermark, ts AS logged_at
        FROM {events}""",
    # Replication state, one row per user table.
    "fx_state": """
        SELECT concat('db', CAST(user_id % 3 AS STRING)) AS source_db,
               concat('t', CAST(user_id AS STRING)) AS table_name,
               max(CASE WHEN event_type <> 'error' THEN ts END) AS last_sync_value,
               max(ts) AS last_sync_ts, count(*) AS rows_synced, 'completed' AS sync_status,
               CASE WHEN user_id % 5 = 0 THEN 'old error' END AS error_message
        FROM {events} WHERE user_id % 4 <> 0 GROUP BY user_id""",
    "fx_state_runs": """
        SELECT concat('db', CAST(user_id % 3 AS STRING)) AS source_db,
               concat('t', CAST(user_id AS STRING)) AS table_name,
               CASE WHEN user_id % 6 <> 0 THEN max(ts) END AS watermark,
               count(*) AS row_count,
               repeat(concat('failed ', CAST(user_id AS STRING), ' '), 600) AS error
        FROM {events} WHERE user_id % 2 = 0 GROUP BY user_id""",
    # Column catalog of one table per order: what the source has now ...
    "fx_columns_new": """
        SELECT DISTINCT CASE WHEN l_orderkey % 7 = 0 THEN 'audit' ELSE 'data' END AS table_schema,
               concat('t', CAST(l_orderkey AS STRING)) AS table_id, l_linenumber AS ordinal,
               concat('Col_', CAST(l_linenumber AS STRING)) AS column_name,
               CASE l_linenumber % 3 WHEN 0 THEN 'integer' WHEN 1 THEN 'text'
                    ELSE 'timestamp without time zone' END AS data_type,
               l_orderkey
        FROM {lineitem}""",
    # ... and what was recorded: columns missing, dropped since, or of another type.
    "fx_columns_old": """
        SELECT table_id, ordinal, column_name,
               CASE WHEN l_orderkey % 5 = 2 AND ordinal % 3 = 0 THEN 'bigint' ELSE data_type END AS data_type
        FROM {fx_columns_new}
        WHERE NOT (l_orderkey % 5 IN (0, 3) AND ordinal % 2 = 0) AND l_orderkey % 13 <> 5
        UNION ALL
        SELECT DISTINCT table_id, 99 AS ordinal, 'legacy' AS column_name, 'text' AS data_type
        FROM {fx_columns_new} WHERE l_orderkey % 5 IN (1, 3) AND l_orderkey % 13 <> 5""",
    "fx_schema_registry": """
        SELECT DISTINCT table_id,
               CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 5 THEN 'stale'
                    ELSE concat('as recorded') END AS recorded,
               CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey % 3 END AS schema_version
        FROM {fx_columns_new}""",
    # Slot positions over time, as text.
    "fx_slots": """
        SELECT CAST(ts AS DATE) AS snapshot_at, event_id AS slot_id,
               CASE WHEN event_id % 9 <> 4 THEN event_id * 70000001 END AS position,
               event_id * 70000001 + user_id * 1000 + 5 AS head
        FROM {events}""",
    # Source databases, some with a driver nobody knows.
    "fx_addresses": """
        SELECT concat('db', CAST(s_suppkey AS STRING)) AS database_id,
               CASE s_suppkey % 7 WHEN 0 THEN 'psycopg2' WHEN 1 THEN 'pymssql' WHEN 2 THEN 'mssql'
                    WHEN 3 THEN 'pymysql' WHEN 4 THEN 'mysql' WHEN 5 THEN 'oracledb' END AS driver,
               concat('h', CAST(s_nationkey AS STRING), '.example.com') AS host,
               CAST(5000 + s_suppkey % 9 AS INTEGER) AS port,
               concat('app_', CAST(s_suppkey AS STRING)) AS source_db_name
        FROM {supplier}""",
}

_NAMES = re.compile(r"\{(\w+)\}")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a fixture as a DataFrame."""
    if name not in FIXTURES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = FIXTURES[name].replace("@NTZ", "TIMESTAMP_NTZ")
    inputs = {n: table(spark, sf_dir, n) for n in set(_NAMES.findall(text))}
    return spark.sql(text, **inputs)


def oracle(body: str) -> str:
    """``body`` with the fixtures it names put in front as common table expressions."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in _NAMES.findall(text):
            if name in FIXTURES and name not in order:
                need(FIXTURES[name])
                order.append(name)

    need(body)
    parts = [f"{n} AS ({FIXTURES[n].replace('@NTZ', 'TIMESTAMP')})" for n in order]
    text = (f"WITH {', '.join(parts)} " if parts else "") + body.replace("@NTZ", "TIMESTAMP")
    return _NAMES.sub(r"\1", text)
