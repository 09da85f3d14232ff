"""Registries, run log, state table, event log and configuration documents.

Everything here takes and returns DataFrames. The time of a run is an argument.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions import ntz, run_status

TABLE_UPDATES = ("sync_method", "primary_key_column", "cdc_column", "wal_slot_name")
DATABASE_UPDATES = ("source_db_name", "host", "port", "target_schema", "source_schema")
STATE_KEY = ("source_db", "table_name")

# The event types of the sync event log.
EVENT_TYPES = (
    "SYNC_START",
    "SOURCE_COUNT",
    "EXTRACT_START",
    "EXTRACT_COMPLETE",
    "LOAD_START",
    "LOAD_COMPLETE",
    "SYNC_COMPLETE",
    "SYNC_FAILED",
)


# --- registries -----------------------------------------------------------------------


def enabled_tables(tables: DataFrame, databases: DataFrame) -> DataFrame:
    """Enabled tables of active databases with the registry defaults filled in."""
    active = databases.filter("is_active").select("database_id", "source_db_name")
    return (
        tables.filter("sync_enabled")
        .join(active, "database_id")
        .select(
            "table_id",
            "database_id",
            "source_db_name",
            "source_table",
            "target_table",
            F.lower(F.coalesce("sync_method", F.lit(s.DEFAULT_METHOD))).alias("sync_method"),
            F.coalesce("batch_size", F.lit(s.DEFAULT_BATCH_SIZE)).alias("batch_size"),
            "cdc_column",
            "wal_slot_name",
            "last_watermark",
        )
    )


def _upsert_columns(
    table: DataFrame,
    entries: DataFrame,
    key: str,
    update: Sequence[str],
    defaults: Mapping[str, Column],
    run_ts: datetime | str,
) -> DataFrame:
    """MERGE that updates only ``update`` and ``updated_at`` of a known key.

    A new key gets its entry, the defaults, and ``created_at``. One full outer
    equi-join; both sides have one row per key.
    """
    old = table.withColumn("_known", F.lit(True)).alias("o")
    new = entries.withColumn("_given", F.lit(True)).alias("n")
    joined = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    known, given = F.col("o._known").isNotNull(), F.col("n._given").isNotNull()
    columns = []
    for field in table.schema.fields:
        name = field.name
        kept = F.col(f"o.{name}")
        fresh = F.col(f"n.{name}") if name in entries.columns else defaults.get(name, F.lit(None))
        if name in defaults and name in entries.columns:
            fresh = F.coalesce(fresh, defaults[name])
        if name in ("created_at", "updated_at"):
            fresh = ntz(run_ts)
        if name == "updated_at" or name in update:
            value = F.when(given, fresh).otherwise(kept)
        else:
            value = F.when(known, kept).otherwise(fresh)
        columns.append(value.cast(field.dataType).alias(name))
    return joined.select(*columns)


def register_databases(
    registry: DataFrame, entries: DataFrame, run_ts: datetime | str
) -> DataFrame:
    """Insert or update database rows; an update leaves ``is_active`` alone."""
    defaults = {
        "port": F.lit(s.DEFAULT_PORT),
        "source_schema": F.lit(s.DEFAULT_SOURCE_SCHEMA),
        "is_active": F.lit(True),
    }
    return _upsert_columns(registry, entries, "database_id", DATABASE_UPDATES, defaults, run_ts)


def table_entries(requests: DataFrame, databases: DataFrame) -> DataFrame:
    """Requests ``(database_id, source_table, ...)`` as registry rows of known databases."""
    known = databases.select("database_id", "source_schema", "target_schema")
    return requests.join(known, "database_id").select(
        F.concat_ws("_", "database_id", "source_table").alias("table_id"),
        "database_id",
        F.coalesce("source_schema", F.lit(s.DEFAULT_SOURCE_SCHEMA)).alias("source_schema"),
        "source_table",
        "target_schema",
        F.upper("source_table").alias("target_table"),
        F.coalesce("primary_key", F.lit(s.DEFAULT_KEY)).alias("primary_key_column"),
        F.coalesce("sync_method", F.lit(s.DEFAULT_METHOD)).alias("sync_method"),
        "cdc_column",
        F.col("wal_slot").alias("wal_slot_name"),
    )


def register_tables(registry: DataFrame, entries: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Insert or update table rows; enabled flag, watermark and last results are kept."""
    defaults = {
        "sync_enabled": F.lit(True),
        "batch_size": F.lit(s.DEFAULT_BATCH_SIZE),
        "schema_version": F.lit(1),
    }
    return _upsert_columns(registry, entries, "table_id", TABLE_UPDATES, defaults, run_ts)


def config_documents(texts: DataFrame) -> DataFrame:
    """JSON texts in ``document`` parsed to the configuration struct."""
    return texts.withColumn("document", F.from_json("document", s.CONFIG_DOCUMENT))


def _config_databases(documents: DataFrame) -> DataFrame:
    """Each document with one of its databases, given as a list or singly."""
    listed = F.coalesce("document.databases", F.array())
    single = F.when(F.col("document.database").isNotNull(), F.array("document.database"))
    return documents.select("document", F.explode(F.concat(listed, F.coalesce(single, F.array()))).alias("db"))


def skipped_entries(documents: DataFrame) -> DataFrame:
    """What ``expand_config`` passes over: ``entry``, its ``name`` and the ``reason``."""

    def skipped(rows: DataFrame, entry: str, name: Column, reason: Column) -> DataFrame:
        found = rows.select(F.lit(entry).alias("entry"), name.cast("string").alias("name"), reason.alias("reason"))
        return found.filter(F.col("reason").isNotNull())

    db, tbl, doc = F.col("db"), F.col("tbl"), F.col("document")
    none = F.size(F.coalesce(doc["databases"], F.array())) + doc["database"].isNotNull().cast("int") == 0
    bad = F.when(doc.isNull() | none, "not readable, or without a database")
    no_id = F.coalesce(db["database_id"], F.lit("")) == ""
    no_host = F.coalesce(db["host"], F.lit("")) == ""
    tables = documents.select(F.explode("document.tables").alias("tbl"))
    return (
        skipped(documents, "document", F.lit(None), bad)
        .unionByName(
            skipped(
                _config_databases(documents),
                "database",
                db["database_id"],
                F.when(no_id, "without database_id").when(no_host, "without host"),
            )
        )
        .unionByName(
            skipped(tables, "table", tbl["name"], F.when(F.coalesce(tbl["name"], F.lit("")) == "", "without name"))
        )
    )


def expand_config(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Database entries and table entries of configuration documents.

    Every table of a document goes to every database of it. Both lists sit in the
    same row, so the product is two ``explode`` steps and no join. Databases
    without id or host and tables without a name are skipped; ``skipped_entries``
    names them.
    """
    db, defaults, tbl = F.col("db"), F.col("document.defaults"), F.col("tbl")
    given = (
        _config_databases(documents)
        .filter(db["database_id"].isNotNull() & (db["database_id"] != ""))
        .filter(db["host"].isNotNull() & (db["host"] != ""))
    )
    target_schema = F.coalesce(db["target_schema"], F.upper(db["database_id"]))
    source_schema = F.coalesce(db["source_schema"], F.lit(s.DEFAULT_SOURCE_SCHEMA))
    databases = given.select(
        db["database_id"].alias("database_id"),
        F.coalesce(db["source_db_name"], db["database_id"]).alias("source_db_name"),
        db["host"].alias("host"),
        F.coalesce(db["port"], F.lit(s.DEFAULT_PORT)).alias("port"),
        source_schema.alias("source_schema"),
        target_schema.alias("target_schema"),
    )
    method = F.coalesce(tbl["sync_method"], defaults["sync_method"], F.lit(s.DEFAULT_METHOD))
    cdc_column = F.coalesce(
        tbl["cdc_column"], defaults["cdc_column"], F.lit(s.DEFAULT_CDC_COLUMN)
    )
    tables = (
        given.select("db", "document", F.explode("document.tables").alias("tbl"))
        .filter(tbl["name"].isNotNull() & (tbl["name"] != ""))
        .select(
            F.concat_ws("_", db["database_id"], tbl["name"]).alias("table_id"),
            db["database_id"].alias("database_id"),
            source_schema.alias("source_schema"),
            tbl["name"].alias("source_table"),
            target_schema.alias("target_schema"),
            F.upper(tbl["name"]).alias("target_table"),
            F.coalesce(
                tbl["primary_key"], defaults["primary_key"], F.lit(s.DEFAULT_KEY)
            ).alias("primary_key_column"),
            method.alias("sync_method"),
            F.when(method == "cdc", cdc_column).alias("cdc_column"),
            F.when(method == "wal", F.coalesce(db["wal_slot"], defaults["wal_slot"])).alias(
                "wal_slot_name"
            ),
        )
    )
    return databases, tables


def list_tables(tables: DataFrame, database_id: str | None = None) -> DataFrame:
    """Registry listing, optionally of one database."""
    if database_id:
        tables = tables.filter(F.col("database_id") == database_id)
    return tables.orderBy("database_id", "source_table").select(
        "table_id",
        "sync_method",
        F.when(F.col("sync_enabled"), "yes").otherwise("no").alias("enabled"),
        F.substring(
            F.when(F.col("last_sync_status") != "", F.col("last_sync_status")).otherwise("never"),
            1,
            10,
        ).alias("status"),
        F.coalesce("last_sync_records", F.lit(0)).alias("row_count"),
    )


# --- run log --------------------------------------------------------------------------


#: Columns of a run that its log row has where they are known.
RUN_DETAILS = ("schema_fingerprint", "schema_version", "rejected", "missing")


def run_log_rows(results: DataFrame) -> DataFrame:
    """Run results as log rows.

    ``results`` holds ``table_id, method, error, row_count, seconds,
    new_watermark, logged_at`` and, where known, ``schema_fingerprint``,
    ``schema_version``, the typed watermark and the lines left out. Failed runs
    log no rows, watermark or cdc rows.
    """
    ok = F.col("error").isNull()
    incremental = F.lower("method").isin("cdc", "wal")
    carried = [c for c in (*RUN_DETAILS, *s.WATERMARK.names) if c in results.columns]
    return results.select(
        "table_id",
        run_status("error").alias("sync_status"),
        F.when(ok, F.col("row_count")).otherwise(0).cast("bigint").alias("sync_records"),
        F.round("seconds", 2).alias("sync_duration_sec"),
        F.when(ok, F.col("new_watermark")).alias("new_watermark"),
        F.when(ok & incremental, F.col("row_count")).cast("bigint").alias("cdc_rows"),
        *[F.when(ok, F.col(c)).alias(c) for c in carried],
        "logged_at",
    )


def log_latest_per_table(log: DataFrame) -> DataFrame:
    """The newest log row of each table; ``log_id`` decides between equal times.

    Spark applies the limit of one row before the shuffle too (WindowGroupLimit),
    so a table with most of the log reaches it as one row per map task.
    """
    newest = Window.partitionBy("table_id").orderBy(F.desc("logged_at"), F.desc("log_id"))
    numbered = log.withColumn("_rank", F.row_number().over(newest))
    return numbered.filter(F.col("_rank") == 1).drop("_rank")


def consolidate_log(
    tables: DataFrame, log: DataFrame, run_ts: datetime | str, after_log_id: int | None = None
) -> DataFrame:
    """Registry with the newest log row of each table merged in.

    The log is never cleared: only rows above ``after_log_id`` are read. A run
    without a watermark, cdc row count or fingerprint keeps the stored one.
    """
    if after_log_id is not None:
        log = log.filter(F.col("log_id") > after_log_id)
    latest = log_latest_per_table(log)
    new = latest.select([F.col(c).alias(f"_{c}") for c in latest.columns])
    ran = F.col("_table_id").isNotNull()
    # A fingerprint in the log replaces the stored one; so does its version.
    replaced = {
        "last_sync_at": F.when(ran, F.col("_logged_at")).otherwise(F.col("last_sync_at")),
        "last_sync_status": F.when(ran, F.col("_sync_status")).otherwise(F.col("last_sync_status")),
        "last_sync_records": F.when(ran, F.col("_sync_records")).otherwise(
            F.col("last_sync_records")
        ),
        "last_watermark": F.coalesce("_new_watermark", "last_watermark"),
        "last_cdc_rows": F.coalesce("_cdc_rows", "last_cdc_rows"),
    }
    for name in ("schema_fingerprint", "schema_version"):
        if name in log.columns and name in tables.columns:
            replaced[name] = F.coalesce(f"_{name}", name)
    for name in s.WATERMARK.names:  # text and type change together
        if name in log.columns and name in tables.columns:
            newer = F.col("_watermark_text").isNotNull()
            replaced[name] = F.when(newer, F.col(f"_{name}")).otherwise(F.col(name))
    if "updated_at" in tables.columns:
        replaced["updated_at"] = F.when(ran, ntz(run_ts)).otherwise(F.col("updated_at"))
    joined = tables.join(new, F.col("table_id") == F.col("_table_id"), "left")
    return joined.select([replaced.get(c, F.col(c)).alias(c) for c in tables.columns])


# --- state table ----------------------------------------------------------------------


def state_upsert(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Upsert state rows by ``(source_db, table_name)``, error text cut to its column."""
    from tidemark.operators.merge import merge_upsert

    cut = F.substring("error_message", 1, s.STATE_ERROR_LENGTH)
    return merge_upsert(state, changes.withColumn("error_message", cut), STATE_KEY)


def _state_change(
    state: DataFrame, runs: DataFrame, values: Mapping[str, Column], run_ts: datetime | str
) -> DataFrame:
    """State after ``runs`` (one row per table) with ``values`` over old (``o``) and run.

    One full outer join: each row is the old one, or a run's.
    """
    started = runs.withColumn("_ran", F.lit(True)).alias("r")
    joined = state.alias("o").join(started, list(STATE_KEY), "full_outer")
    columns = {
        "last_sync_value": F.col("o.last_sync_value"),
        "last_sync_ts": ntz(run_ts),
        "rows_synced": F.lit(0).cast("bigint"),
        "error_message": F.lit(None).cast("string"),
    } | {c: F.col(f"o.{c}") for c in s.WATERMARK.names if c in state.columns}
    columns |= dict(values)
    columns["error_message"] = F.substring(columns["error_message"], 1, s.STATE_ERROR_LENGTH)
    return joined.select(
        *STATE_KEY,
        *[
            F.when(F.col("r._ran"), columns[c]).otherwise(F.col(f"o.{c}")).alias(c)
            for c in state.columns
            if c not in STATE_KEY
        ],
    )


def state_mark_running(state: DataFrame, runs: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Started tables: a known row keeps its watermark, rows and error text."""
    values = {
        "rows_synced": F.coalesce("o.rows_synced", F.lit(0).cast("bigint")),
        "sync_status": F.lit("running"),
        "error_message": F.col("o.error_message"),
    }
    return _state_change(state, runs, values, run_ts)


def state_mark_completed(state: DataFrame, runs: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Finished tables with ``watermark`` and ``row_count``; a NULL watermark keeps the old."""
    values = {
        "last_sync_value": F.coalesce("r.watermark", "o.last_sync_value"),
        "rows_synced": F.col("r.row_count").cast("bigint"),
        "sync_status": F.lit("completed"),
    }
    for name in s.WATERMARK.names:  # text and type change together
        if name in state.columns and name in runs.columns:
            newer = F.col("r.watermark_text").isNotNull()
            values[name] = F.when(newer, F.col(f"r.{name}")).otherwise(F.col(f"o.{name}"))
    return _state_change(state, runs, values, run_ts)


def state_mark_failed(state: DataFrame, runs: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Failed tables with ``error``; the watermark stays, so the next run is no reload."""
    values = {"sync_status": F.lit("failed"), "error_message": F.col("r.error")}
    return _state_change(state, runs, values, run_ts)


def state_get(state: DataFrame, source_db: str, table_name: str) -> DataFrame:
    return state.filter(
        (F.col("source_db") == source_db) & (F.col("table_name") == table_name)
    )


def state_list(state: DataFrame) -> DataFrame:
    """All states in order, in the shape of the status report."""
    return state.orderBy(*STATE_KEY).select(
        "source_db",
        "table_name",
        "last_sync_value",
        "last_sync_ts",
        "rows_synced",
        "sync_status",
        "error_message",
    )


def state_reset(state: DataFrame, source_db: str, table_name: str) -> DataFrame:
    """State without one table."""
    match = (F.col("source_db") == source_db) & (F.col("table_name") == table_name)
    return state.filter(~F.coalesce(match, F.lit(False)))


def state_reset_all(state: DataFrame) -> DataFrame:
    return state.filter(F.lit(False))


# --- event log ------------------------------------------------------------------------


def event_rows(events: DataFrame, metadata: Sequence[str] = ()) -> DataFrame:
    """Event-log rows; the ``metadata`` columns go into one JSON text."""
    text: Any = F.to_json(F.struct(*metadata)) if metadata else F.lit(None).cast("string")
    return events.select(
        "source_db",
        "table_name",
        "event_type",
        "message",
        F.col("rows_affected").cast("bigint").alias("rows_affected"),
        F.col("duration_ms").cast("bigint").alias("duration_ms"),
        text.alias("metadata"),
        "logged_at",
    )
