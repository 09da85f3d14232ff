"""Control-table schemas and their fixed defaults."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Defaults that decide results.
DEFAULT_PORT = 5432
DEFAULT_SOURCE_SCHEMA = "public"
DEFAULT_METHOD = "full"
DEFAULT_KEY = "id"
DEFAULT_CDC_COLUMN = "db_update_date"
DEFAULT_BATCH_SIZE = 100_000
DEFAULT_FETCH_SIZE = 50_000
DEFAULT_PARTITIONS = 4
LARGE_TABLE_ROWS = 50_000
STATE_ERROR_LENGTH = 4_000


def _fields(*pairs: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in pairs])


_S, _I, _L, _B, _D, _T = (
    StringType(),
    IntegerType(),
    LongType(),
    BooleanType(),
    DoubleType(),
    TimestampNTZType(),
)

DATABASE_REGISTRY = _fields(
    ("database_id", _S),
    ("source_db_name", _S),
    ("host", _S),
    ("port", _I),
    ("source_schema", _S),
    ("target_schema", _S),
    ("is_active", _B),
    ("created_at", _T),
    ("updated_at", _T),
)

TABLE_REGISTRY = _fields(
    ("table_id", _S),
    ("database_id", _S),
    ("source_schema", _S),
    ("source_table", _S),
    ("target_schema", _S),
    ("target_table", _S),
    ("primary_key_column", _S),
    ("sync_enabled", _B),
    ("sync_method", _S),
    ("cdc_column", _S),
    ("wal_slot_name", _S),
    ("last_watermark", _T),
    ("last_sync_at", _T),
    ("last_sync_status", _S),
    ("last_sync_records", _L),
    ("last_cdc_rows", _L),
    ("batch_size", _I),
    ("schema_fingerprint", _S),
    ("schema_version", _I),
    ("created_at", _T),
    ("updated_at", _T),
)

SYNC_LOG = _fields(
    ("log_id", _L),
    ("table_id", _S),
    ("sync_status", _S),
    ("sync_records", _L),
    ("sync_duration_sec", _D),
    ("new_watermark", _T),
    ("cdc_rows", _L),
    ("schema_fingerprint", _S),
    ("schema_version", _I),
    ("logged_at", _T),
)

# The run log with what a run of a change log had to leave out.
RUN_LOG = StructType([*SYNC_LOG.fields, StructField("rejected", _L), StructField("missing", _L)])

STATE = _fields(
    ("source_db", _S),
    ("table_name", _S),
    ("last_sync_value", _T),
    ("last_sync_ts", _T),
    ("rows_synced", _L),
    ("sync_status", _S),
    ("error_message", _S),
)

EVENT_LOG = _fields(
    ("source_db", _S),
    ("table_name", _S),
    ("event_type", _S),
    ("message", _S),
    ("rows_affected", _L),
    ("duration_ms", _L),
    ("metadata", _S),
    ("logged_at", _T),
)

# A watermark of any type beside the time column of a control table.
WATERMARK = _fields(("watermark_text", _S), ("watermark_type", _S))


def with_watermark(schema: StructType) -> StructType:
    return StructType([*schema.fields, *WATERMARK.fields])


REJECTED_LINES = _fields(
    ("slot", _S), ("table_id", _S), ("lsn", _L), ("line_key", _S), ("data", _S), ("reason", _S)
)

CHANGELOG_COMMIT = _fields(("slot", _S), ("table_id", _S), ("lsn", _L))

_CONFIG_DATABASE = _fields(
    ("database_id", _S),
    ("source_db_name", _S),
    ("host", _S),
    ("port", _I),
    ("source_schema", _S),
    ("target_schema", _S),
    ("wal_slot", _S),
)

# One replication document: one database or several, shared defaults, shared tables.
CONFIG_DOCUMENT = StructType(
    [
        StructField(
            "databases",
            ArrayType(_CONFIG_DATABASE),
        ),
        StructField("database", _CONFIG_DATABASE),
        StructField(
            "defaults",
            _fields(
                ("sync_method", _S), ("primary_key", _S), ("cdc_column", _S), ("wal_slot", _S)
            ),
        ),
        StructField(
            "tables",
            ArrayType(
                _fields(
                    ("name", _S), ("sync_method", _S), ("primary_key", _S), ("cdc_column", _S)
                )
            ),
        ),
    ]
)
