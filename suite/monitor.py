"""Monitoring reports."""

from pyspark.sql import functions as F

from suite.fixtures import NOW, oracle, table
from tidemark.plans import monitor
from tidemark.sources.scans import fresh_folder


def _log(spark, sf):
    return table(spark, sf, "fx_sync_log")


def _tables(spark, sf):
    return table(spark, sf, "fx_registry_run")


def _databases(spark, sf):
    return table(spark, sf, "fx_database_registry")


def health_summary(spark, sf):
    return monitor.health_summary(_databases(spark, sf), _tables(spark, sf))


def hourly_stats(spark, sf):
    stats = monitor.hourly_stats(_log(spark, sf), NOW)
    return stats.withColumn("avg_duration", F.round("avg_duration", 6))


def hourly_stats_month(spark, sf):
    stats = monitor.hourly_stats(_log(spark, sf), "2024-02-01 00:00:00", hours=24 * 31)
    return stats.withColumn("avg_duration", F.round("avg_duration", 6))


def chart_series(spark, sf):
    return monitor.chart_series(monitor.hourly_stats(_log(spark, sf), NOW))


def table_stats(spark, sf):
    return monitor.table_stats(_tables(spark, sf))


def log_search(spark, sf):
    return monitor.log_search(_log(spark, sf), "error", "_t1")


def log_search_all(spark, sf):
    return monitor.log_search(_log(spark, sf), "success", "db0", limit=None)


def table_catalog(spark, sf):
    return monitor.table_catalog(_tables(spark, sf), _databases(spark, sf))


def recent_verify(spark, sf):
    return monitor.recent_verify(_log(spark, sf), NOW, minutes=180)


def recent_rollup(spark, sf):
    return monitor.recent_rollup(_log(spark, sf))


def tables_per_database(spark, sf):
    return monitor.tables_per_database(_tables(spark, sf))


def multi_db_status(spark, sf):
    """One more database per supplier, none of which has tables."""
    empty = table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), "s_suppkey").alias("database_id"),
        F.col("s_name").alias("target_schema"),
    )
    known = _databases(spark, sf).select("database_id", "target_schema")
    return monitor.multi_db_status(known.unionByName(empty), _tables(spark, sf))


def log_export_csv(spark, sf):
    """The failed runs written as CSV and read back as text columns."""
    path = fresh_folder(spark, "export")
    monitor.write_log_csv(monitor.log_search(_log(spark, sf), "error", limit=None), path)
    schema = ", ".join(f"{c} string" for c in monitor.EXPORT_COLUMNS)
    rows = spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)
    number, time = F.col("sync_duration_sec").cast("double"), F.to_timestamp_ntz("logged_at")
    return rows.withColumns({"sync_duration_sec": number, "logged_at": time})


def throughput(spark, sf):
    return monitor.throughput(_log(spark, sf))


def _position(column):
    high = F.hex(F.floor(F.col(column) / 4294967296).cast("bigint"))
    return F.concat(high, F.lit("/"), F.hex(F.col(column) % 4294967296))


def consumer_lag(spark, sf):
    slots = table(spark, sf, "fx_slots").select(
        "snapshot_at",
        _position("head").alias("head_lsn"),
        _position("position").alias("restart_lsn"),
    )
    return monitor.consumer_lag(slots)


QUERIES = {
    f.__name__: f
    for f in (
        health_summary,
        hourly_stats,
        hourly_stats_month,
        chart_series,
        table_stats,
        log_search,
        log_search_all,
        table_catalog,
        recent_verify,
        recent_rollup,
        tables_per_database,
        multi_db_status,
        log_export_csv,
        throughput,
        consumer_lag,
    )
}


def _hourly(now: str, interval: str) -> str:
    return f"""SELECT CAST(date_trunc('hour', logged_at) AS TIMESTAMP) AS hour, count(*) AS total_syncs,
                   count(*) FILTER (WHERE sync_status = 'success') AS successful,
                   count(*) FILTER (WHERE sync_status LIKE 'error%') AS errors,
                   CAST(sum(coalesce(sync_records, 0)) AS BIGINT) AS total_rows,
                   round(avg(sync_duration_sec), 6) AS avg_duration
            FROM {{fx_sync_log}} WHERE logged_at > TIMESTAMP '{now}' - INTERVAL {interval}
            GROUP BY 1"""


# Seconds are rounded half up on their decimal digits; a binary round differs on ties.
_SEARCH = """SELECT log_id, table_id, sync_status, sync_records,
                    CAST(CAST(CAST(sync_duration_sec AS VARCHAR) AS DECIMAL(18,2)) AS DOUBLE) AS sync_duration_sec,
                    new_watermark, cdc_rows, logged_at
             FROM {fx_sync_log} """
_OUTCOMES = """SELECT count(*) FILTER (WHERE sync_status = 'success') AS {0},
                      count(*) FILTER (WHERE sync_status LIKE 'error%') AS {1},
                      CAST(sum(sync_records) AS BIGINT) AS {2} """

ORACLES = {
    "health_summary": oracle(
        """SELECT (SELECT count(*) FROM {fx_database_registry} WHERE is_active) AS databases,
                  (SELECT count(*) FROM {fx_registry_run} WHERE sync_enabled) AS tables,
                  (SELECT count(*) FROM {fx_registry_run} WHERE last_sync_status = 'success') AS synced,
                  (SELECT CAST(coalesce(sum(last_sync_records), 0) AS BIGINT) FROM {fx_registry_run}) AS total_rows"""
    ),
    "hourly_stats": oracle(_hourly(NOW, "24 HOUR")),
    "hourly_stats_month": oracle(_hourly("2024-02-01 00:00:00", "744 HOUR")),
    "chart_series": oracle(
        f"""SELECT hour, total_rows AS row_count, total_syncs AS syncs, errors,
                   CAST(floor(avg_duration + 0.5) AS BIGINT) AS duration
            FROM ({_hourly(NOW, "24 HOUR")}) AS h"""
    ),
    "table_stats": oracle(
        """SELECT table_id, last_sync_status, last_sync_records, last_sync_at, sync_method
           FROM {fx_registry_run} WHERE sync_enabled"""
    ),
    "log_search": oracle(
        _SEARCH
        + """WHERE sync_status LIKE 'error%' AND contains(table_id, '_t1')
             ORDER BY logged_at DESC, log_id DESC LIMIT 100"""
    ),
    "log_search_all": oracle(
        _SEARCH + "WHERE sync_status = 'success' AND contains(table_id, 'db0')"
    ),
    "table_catalog": oracle(
        """SELECT d.database_id, t.table_id, t.source_table, t.target_table, t.sync_method,
                  t.sync_enabled, t.wal_slot_name, t.cdc_column, d.source_db_name, d.target_schema
           FROM {fx_registry_run} t JOIN {fx_database_registry} d ON t.database_id = d.database_id"""
    ),
    "recent_verify": oracle(
        _OUTCOMES.format("success", "errors", "rows_synced")
        + f"FROM {{fx_sync_log}} WHERE logged_at > TIMESTAMP '{NOW}' - INTERVAL 180 MINUTE"
    ),
    "recent_rollup": oracle(
        _OUTCOMES.format("success_count", "error_count", "total_rows")
        + """FROM (SELECT * FROM {fx_sync_log} ORDER BY logged_at DESC, log_id DESC LIMIT 50) AS newest"""
    ),
    "tables_per_database": oracle(
        "SELECT database_id, count(*) AS tables FROM {fx_registry_run} GROUP BY database_id"
    ),
    "multi_db_status": oracle(
        """SELECT d.database_id, d.target_schema, count(t.table_id) AS table_count,
                  count(*) FILTER (WHERE t.last_sync_status = 'success') AS synced_tables,
                  CAST(coalesce(sum(t.last_sync_records), 0) AS BIGINT) AS total_rows,
                  max(t.last_sync_at) AS last_sync_time
           FROM (SELECT database_id, target_schema FROM {fx_database_registry}
                 UNION ALL SELECT 's' || s_suppkey, s_name FROM {supplier}) AS d
           LEFT JOIN {fx_registry_run} t ON t.database_id = d.database_id
           GROUP BY d.database_id, d.target_schema"""
    ),
    "log_export_csv": oracle(
        """SELECT CAST(log_id AS VARCHAR) AS log_id, table_id, sync_status,
                  CAST(sync_records AS VARCHAR) AS sync_records, 
                  CAST(CAST(CAST(sync_duration_sec AS VARCHAR) AS DECIMAL(18,2)) AS DOUBLE) AS sync_duration_sec, logged_at
           FROM {fx_sync_log} WHERE sync_status LIKE 'error%'"""
    ),
    "throughput": oracle(
        """SELECT log_id, table_id,
                  CASE WHEN sync_records > 0 AND sync_duration_sec > 0
                       THEN CAST(floor(sync_records / sync_duration_sec) AS BIGINT) ELSE 0 END AS rows_per_sec
           FROM {fx_sync_log}"""
    ),
    "consumer_lag": oracle(
        """SELECT snapshot_at, count(*) AS slots, CAST(coalesce(sum(head - position), 0) AS BIGINT) AS lag_bytes
           FROM {fx_slots} GROUP BY snapshot_at"""
    ),
}
