"""Monitoring reports over the registries and the run log.

``now`` is always an argument. The time filters compare the bare column with a
literal, so they reach the scan and prune a log that is stored by time.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import is_error, lsn_bytes, ntz
from tidemark.functions import throughput as rows_per_second

LOG_COLUMNS = (
    "log_id",
    "table_id",
    "sync_status",
    "sync_records",
    "sync_duration_sec",
    "new_watermark",
    "cdc_rows",
    "logged_at",
)
EXPORT_COLUMNS = LOG_COLUMNS[:5] + ("logged_at",)


def _succeeded() -> Column:
    return F.col("sync_status") == "success"


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0).cast("bigint"))


def health_summary(databases: DataFrame, tables: DataFrame) -> DataFrame:
    """Active databases, enabled tables, tables in success and their rows, in one row."""
    zero = F.lit(0).cast("bigint")
    per_database = databases.agg(F.count_if("is_active").alias("databases")).select(
        "databases", zero.alias("tables"), zero.alias("synced"), zero.alias("total_rows")
    )
    per_table = tables.agg(
        F.count_if("sync_enabled").alias("tables"),
        F.count_if(F.col("last_sync_status") == "success").alias("synced"),
        _total("last_sync_records").alias("total_rows"),
    ).select(zero.alias("databases"), "tables", "synced", "total_rows")
    names = ("databases", "tables", "synced", "total_rows")
    return per_database.unionByName(per_table).agg(*[F.sum(n).alias(n) for n in names])


def hourly_stats(log: DataFrame, now: datetime | str, hours: int = 24) -> DataFrame:
    """Runs, outcomes, rows and mean seconds per hour of the last ``hours``, newest first."""
    recent = log.filter(F.col("logged_at") > ntz(now) - F.expr(f"INTERVAL {int(hours)} HOURS"))
    # Not date_trunc: that goes through the session time zone and its clock changes.
    past_hour = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute("logged_at"), F.extract(F.lit("SECOND"), "logged_at")
    )
    hour = F.col("logged_at") - past_hour
    return (
        recent.groupBy(hour.alias("hour"))
        .agg(
            F.count("*").alias("total_syncs"),
            F.count_if(_succeeded()).alias("successful"),
            F.count_if(is_error("sync_status")).alias("errors"),
            _total("sync_records").alias("total_rows"),
            F.avg("sync_duration_sec").alias("avg_duration"),
        )
        .orderBy(F.desc("hour"))
    )


def chart_series(hourly: DataFrame) -> DataFrame:
    """``hourly_stats`` oldest first with whole seconds."""
    seconds = F.floor(F.coalesce("avg_duration", F.lit(0.0)) + 0.5).cast("bigint")
    return hourly.orderBy("hour").select(
        "hour",
        F.col("total_rows").alias("row_count"),
        F.col("total_syncs").alias("syncs"),
        "errors",
        seconds.alias("duration"),
    )


def table_stats(tables: DataFrame) -> DataFrame:
    """Enabled tables, most recently synced first."""
    return (
        tables.filter("sync_enabled")
        .orderBy(F.desc_nulls_last("last_sync_at"), "table_id")
        .select(
            "table_id", "last_sync_status", "last_sync_records", "last_sync_at", "sync_method"
        )
    )


def log_search(
    log: DataFrame, status: str = "all", table: str = "", limit: int | None = 100
) -> DataFrame:
    """Log rows by outcome and table-name part, newest first.

    The name part is taken literally. ``limit=None`` returns every match.
    """
    if status == "success":
        log = log.filter(_succeeded())
    elif status == "error":
        log = log.filter(is_error("sync_status"))
    if table:
        log = log.filter(F.col("table_id").contains(table))
    found = log.orderBy(F.desc("logged_at"), F.desc("log_id"))
    if limit is not None:
        found = found.limit(limit)
    return found.select(
        *[
            F.round(c, 2).alias(c) if c == "sync_duration_sec" else F.col(c)
            for c in LOG_COLUMNS
        ]
    )


#: Times as they are stored, to the microsecond.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def log_export(log: DataFrame) -> DataFrame:
    """The six exported log columns."""
    return log.select(*EXPORT_COLUMNS)


def write_log_csv(log: DataFrame, path: str) -> None:
    """Export a log selection as CSV with header; text values quoted."""
    options = {"header": True, "quoteAll": True, "escape": '"', "timestampNTZFormat": TIME_FORMAT}
    log_export(log).write.mode("overwrite").options(**options).csv(path)


def table_catalog(tables: DataFrame, databases: DataFrame) -> DataFrame:
    """Registered tables with their database, in order."""
    place = databases.select("database_id", "source_db_name", "target_schema")
    own = tables.select(
        "table_id",
        "source_table",
        "target_table",
        "sync_method",
        "sync_enabled",
        "wal_slot_name",
        "cdc_column",
        "database_id",
    )
    return own.join(place, "database_id").orderBy("database_id", "source_table")


def recent_verify(log: DataFrame, now: datetime | str, minutes: int = 2) -> DataFrame:
    """Successes, errors and rows of the last minutes."""
    since = ntz(now) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return log.filter(F.col("logged_at") > since).agg(
        F.count_if(_succeeded()).alias("success"),
        F.count_if(is_error("sync_status")).alias("errors"),
        F.sum("sync_records").alias("rows_synced"),
    )


def recent_rollup(log: DataFrame, newest: int = 50) -> DataFrame:
    """Successes, errors and rows over the newest log rows."""
    return (
        log.orderBy(F.desc("logged_at"), F.desc("log_id"))
        .limit(newest)
        .agg(
            F.count_if(_succeeded()).alias("success_count"),
            F.count_if(is_error("sync_status")).alias("error_count"),
            _total("sync_records").alias("total_rows"),
        )
    )


def tables_per_database(tables: DataFrame) -> DataFrame:
    return tables.groupBy("database_id").agg(F.count("*").alias("tables"))


def multi_db_status(databases: DataFrame, tables: DataFrame) -> DataFrame:
    """Tables, synced tables, rows and last sync per database, empty databases included.

    Tables are aggregated before the join, so the join sees one row per database.
    """
    per_database = tables.groupBy("database_id").agg(
        F.count("*").alias("table_count"),
        F.count_if(F.col("last_sync_status") == "success").alias("synced_tables"),
        _total("last_sync_records").alias("total_rows"),
        F.max("last_sync_at").alias("last_sync_time"),
    )
    zero = F.lit(0).cast("bigint")
    return (
        databases.select("database_id", "target_schema")
        .join(per_database, "database_id", "left")
        .select(
            "database_id",
            "target_schema",
            *[F.coalesce(c, zero).alias(c) for c in ("table_count", "synced_tables", "total_rows")],
            "last_sync_time",
        )
        .orderBy("database_id")
    )


def throughput(log: DataFrame) -> DataFrame:
    """Rows per second of every run."""
    return log.select(
        "log_id",
        "table_id",
        rows_per_second("sync_records", "sync_duration_sec").alias("rows_per_sec"),
    )


def slot_lag(slots: DataFrame) -> DataFrame:
    """Bytes between the log head and each slot position ``(head_lsn, restart_lsn)``."""
    return slots.withColumn("lag_bytes", lsn_bytes("head_lsn") - lsn_bytes("restart_lsn"))


def consumer_lag(slots: DataFrame) -> DataFrame:
    """Slots and their summed lag per snapshot, 0 where no slot has a position."""
    return (
        slot_lag(slots)
        .groupBy("snapshot_at")
        .agg(F.count("*").alias("slots"), _total("lag_bytes").alias("lag_bytes"))
    )
