"""Control tables, reports and decisions on hand-made rows."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions import key_list, lsn_bytes, ntz, run_status, throughput
from tidemark.operators import evolution
from tidemark.plans import control, flows, monitor

RUN = datetime(2024, 2, 1)
LOG = "log_id bigint, table_id string, sync_status string, sync_records bigint, sync_duration_sec double, new_watermark timestamp_ntz, cdc_rows bigint, logged_at timestamp_ntz"
CATALOG = "table_id string, ordinal int, column_name string, data_type string"


def log_row(i, table="a", status="success", rows=1, mark=None, cdc=None, at=RUN):
    return (i, table, status, rows, 0.5, mark, cdc, at)


def registry(spark, *rows):
    names = s.TABLE_REGISTRY.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], s.TABLE_REGISTRY)


# --- expressions ----------------------------------------------------------------------


def test_key_list():
    assert key_list(" a, b ,c") == ["a", "b", "c"]
    assert key_list(["a"]) == ["a"] and key_list(None) == [] and key_list("") == []


def test_expressions(spark):
    row = spark.range(1).select(
        lsn_bytes(F.lit("16/B374D848")).alias("lsn"),
        throughput(F.lit(10), F.lit(3.0)).alias("rate"),
        throughput(F.lit(10), F.lit(0.0)).alias("no_time"),
        run_status(F.repeat(F.lit("x"), F.lit(900))).alias("status"),
        ntz(datetime(2024, 1, 1, 1)).alias("at"),
    ).first()
    assert row["lsn"] == 0x16B374D848
    assert (row["rate"], row["no_time"]) == (3, 0)
    assert len(row["status"]) == 500 and row["status"].startswith("error: x")
    assert row["at"] == datetime(2024, 1, 1, 1)


def test_results_do_not_depend_on_the_session_zone(spark):
    log = spark.createDataFrame(
        [log_row(1, at=datetime(2024, 3, 31, 2, 30)), log_row(2, at=datetime(2024, 3, 31, 3, 30))], LOG
    )
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # 02:30 does not exist there
    try:
        rows = monitor.hourly_stats(log, datetime(2024, 3, 31, 12)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r["hour"].hour for r in rows] == [3, 2]


# --- run log --------------------------------------------------------------------------


def test_latest_row_ties_on_time(spark):
    log = spark.createDataFrame([log_row(1), log_row(3, rows=3), log_row(2, rows=2)], LOG)
    assert control.log_latest_per_table(log).first()["log_id"] == 3


def test_consolidate_keeps_watermark_after_an_error(spark):
    mark = datetime(2024, 1, 1)
    tables = registry(spark, {"table_id": "a", "last_watermark": mark, "last_cdc_rows": 9}, {"table_id": "b"})
    log = spark.createDataFrame(
        [log_row(1, mark=datetime(2023, 1, 1)), log_row(2, status="error: x", rows=0)], LOG
    )
    got = {r["table_id"]: r for r in control.consolidate_log(tables, log, RUN).collect()}
    assert got["a"]["last_sync_status"] == "error: x" and got["a"]["last_watermark"] == mark
    assert got["a"]["last_cdc_rows"] == 9 and got["a"]["updated_at"] == RUN
    assert got["b"]["last_sync_status"] is None and got["b"]["updated_at"] is None


def test_hot_table_log(spark):
    """Most of the log belongs to one table."""
    log = spark.range(20_000).select(
        F.col("id").alias("log_id"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("t"), F.col("id") % 70)).otherwise("hot").alias("table_id"),
        F.lit("success").alias("sync_status"),
        F.col("id").alias("sync_records"),
        ntz(RUN).alias("logged_at"),
    )
    got = {r["table_id"]: r["log_id"] for r in control.log_latest_per_table(log).collect()}
    assert got["hot"] == 19_999 and len(got) == 8


# --- registration and configuration ---------------------------------------------------


def test_register_updates_listed_columns_only(spark):
    tables = registry(
        spark,
        {"table_id": "d_t", "database_id": "d", "source_table": "t", "sync_enabled": False,
         "sync_method": "full", "last_watermark": RUN, "created_at": datetime(2020, 1, 1)},
    )
    databases = spark.createDataFrame([("d", None, "D")], "database_id string, source_schema string, target_schema string")
    requests = spark.createDataFrame(
        [("d", "t", "cdc", "k", "c", None), ("d", "u", None, None, None, None), ("x", "t", None, None, None, None)],
        "database_id string, source_table string, sync_method string, primary_key string, cdc_column string, wal_slot string",
    )
    entries = control.table_entries(requests, databases)
    got = {r["table_id"]: r for r in control.register_tables(tables, entries, RUN).collect()}
    assert set(got) == {"d_t", "d_u"}  # database x is unknown
    old, new = got["d_t"], got["d_u"]
    assert (old["sync_method"], old["cdc_column"], old["primary_key_column"]) == ("cdc", "c", "k")
    assert old["sync_enabled"] is False and old["last_watermark"] == RUN
    assert old["created_at"] == datetime(2020, 1, 1) and old["updated_at"] == RUN
    assert (new["sync_method"], new["primary_key_column"], new["target_table"]) == ("full", "id", "U")
    assert (new["sync_enabled"], new["batch_size"], new["source_schema"]) == (True, 100_000, "public")


def test_expand_document(spark):
    document = {
        "databases": [
            {"database_id": "a", "host": "h", "wal_slot": "slot_a"},
            {"database_id": "b", "host": "h", "port": 1, "target_schema": "B_RAW"},
            {"host": "h"},
            {"database_id": "c"},
        ],
        "defaults": {"sync_method": "wal", "primary_key": "pkid", "wal_slot": "slot_d"},
        "tables": [{"name": "users"}, {"name": "orders", "sync_method": "cdc"}, {"sync_method": "full"}],
    }
    texts = spark.createDataFrame([(json.dumps(document),), ("not json",)], "document string")
    databases, tables = control.expand_config(control.config_documents(texts))
    assert sorted((r["database_id"], r["port"], r["target_schema"]) for r in databases.collect()) == [
        ("a", 5432, "A"),
        ("b", 1, "B_RAW"),
    ]
    got = {r["table_id"]: (r["sync_method"], r["cdc_column"], r["wal_slot_name"]) for r in tables.collect()}
    assert got == {
        "a_users": ("wal", None, "slot_a"),
        "a_orders": ("cdc", "db_update_date", None),
        "b_users": ("wal", None, "slot_d"),
        "b_orders": ("cdc", "db_update_date", None),
    }


# --- state ----------------------------------------------------------------------------


def test_state_transitions(spark):
    state = spark.createDataFrame([], s.STATE)
    run = spark.createDataFrame(
        [("d", "t", RUN, 5, "x" * 9000)],
        "source_db string, table_name string, watermark timestamp_ntz, row_count bigint, error string",
    )
    running = control.state_mark_running(state, run, RUN)
    assert running.first()["sync_status"] == "running" and running.first()["rows_synced"] == 0
    done = control.state_mark_completed(running, run, RUN).first()
    assert (done["sync_status"], done["last_sync_value"], done["rows_synced"]) == ("completed", RUN, 5)
    completed = control.state_mark_completed(running, run, RUN)
    failed = control.state_mark_failed(completed, run, RUN).first()
    assert failed["last_sync_value"] == RUN and len(failed["error_message"]) == 4000
    empty = run.withColumn("watermark", ntz(None))
    assert control.state_mark_completed(completed, empty, RUN).first()["last_sync_value"] == RUN
    assert control.state_reset(completed, "d", "t").isEmpty()
    assert control.state_reset(completed, "d", "u").count() == 1


# --- schema evolution -----------------------------------------------------------------


def catalog(spark, **tables):
    rows = [(t, i, n, k) for t, columns in tables.items() for i, (n, k) in enumerate(columns)]
    return spark.createDataFrame(rows, CATALOG)


#: Fixed value: md5 of "user_id:integer|name:varchar", first 16 digits.
FINGERPRINT = "9500be5857cbd452"


def printed(spark, columns):
    row = evolution.schema_fingerprint(catalog(spark, t=columns)).first()
    return row["fingerprint"] if row else "of nothing"


@pytest.mark.parametrize(
    "old, new, recorded, expected",
    [
        ([("id", "int")], [("id", "int")], None, (False, 0, "Schema fingerprint initialized")),
        ([("id", "int")], [("id", "int")], "same", (False, 1, "Schema unchanged")),
        ([("id", "int")], [("id", "bigint")], "was", (False, 2, "Schema evolved v1->v2: column type changes")),
        ([("id", "int")], [("ID", "int"), ("b", "x"), ("A", "x")], "was", (True, 2, "Schema evolved v1->v2: +[A,B]")),
        ([("id", "int"), ("z", "x")], [("id", "int")], "was", (False, 2, "Schema evolved v1->v2: -[Z]")),
        ([("id", "int"), ("z", "x")], [("id", "int"), ("n", "x")], "was", (True, 2, "Schema evolved v1->v2: +[N] -[Z]")),
        ([], [("id", "int")], "was", (False, 2, "Schema evolved v1->v2: column type changes")),
    ],
)
def test_decision(spark, old, new, recorded, expected):
    stored = {"same": printed(spark, new), "was": printed(spark, old)}.get(recorded)
    known = spark.createDataFrame(
        [("t", stored, 1 if recorded else None)], "table_id string, schema_fingerprint string, schema_version int"
    )
    row = evolution.schema_decision(known, catalog(spark, t=new), catalog(spark, t=old)).first()
    assert (row["force_full"], row["schema_version"], row["message"]) == expected
    assert row["fingerprint"] == printed(spark, new)


def test_fingerprint_value(spark):
    assert printed(spark, [("user_id", "integer"), ("name", "varchar")]) == FINGERPRINT


@pytest.mark.parametrize(
    "method, key, cdc, changed, exists, expected",
    [
        ("wal", "id", None, False, True, ("wal", "WAL")),
        ("wal", "", None, False, True, ("full", "FULL")),
        ("wal", "id", None, True, True, ("full", "FULL")),
        ("CDC", "id", "c", False, True, ("cdc", "CDC")),
        ("cdc", "id", None, False, True, ("full", "FULL")),
        ("cdc", "id", "c", True, True, ("full", "FULL (schema change)")),
        ("cdc", "id", "c", True, False, ("full", "FULL (schema change)")),
        ("cdc", "id", "c", False, False, ("full", "FULL (initial)")),
        (None, None, None, False, True, ("full", "FULL")),
    ],
)
def test_plan_method(spark, method, key, cdc, changed, exists, expected):
    row = flows.plan_method(
        spark.createDataFrame(
            [("t", method, key, cdc, changed, exists)],
            "table_id string, sync_method string, primary_key_column string, cdc_column string, "
            "schema_changed boolean, target_exists boolean",
        )
    ).first()
    assert (row["method"], row["mode"]) == expected


# --- reports --------------------------------------------------------------------------


def test_reports_on_nothing(spark):
    log, tables = spark.createDataFrame([], LOG), registry(spark)
    databases = spark.createDataFrame([], s.DATABASE_REGISTRY)
    assert tuple(monitor.health_summary(databases, tables).first()) == (0, 0, 0, 0)
    assert tuple(monitor.recent_rollup(log).first()) == (0, 0, 0)
    assert tuple(monitor.recent_verify(log, RUN).first()) == (0, 0, None)
    assert monitor.hourly_stats(log, RUN).isEmpty()


def test_hourly_window_is_open(spark):
    day = timedelta(hours=24)
    log = spark.createDataFrame([log_row(1, at=RUN - day), log_row(2, at=RUN - day + timedelta(seconds=1))], LOG)
    assert [r["total_syncs"] for r in monitor.hourly_stats(log, RUN).collect()] == [1]


def test_search_takes_the_name_literally(spark):
    log = spark.createDataFrame([log_row(1, "a_b"), log_row(2, "axb"), log_row(3, "a_b", "error: x")], LOG)
    assert [r["log_id"] for r in monitor.log_search(log, table="a_b").collect()] == [3, 1]
    assert [r["log_id"] for r in monitor.log_search(log, "error").collect()] == [3]
    assert [r["log_id"] for r in monitor.log_search(log, limit=1).collect()] == [3]


def test_table_stats_puts_never_synced_last(spark):
    tables = registry(
        spark,
        {"table_id": "new", "sync_enabled": True},
        {"table_id": "old", "sync_enabled": True, "last_sync_at": RUN},
        {"table_id": "off", "sync_enabled": False},
    )
    assert [r["table_id"] for r in monitor.table_stats(tables).collect()] == ["old", "new"]


def test_events_of_unknown_type_are_left_out(spark):
    rows = [("d", "t", "SYNC_START", "m", None, None, RUN), ("d", "t", "NOISE", "m", None, None, RUN)]
    events = spark.createDataFrame(
        rows,
        "source_db string, table_name string, event_type string, message string, rows_affected int, "
        "duration_ms int, logged_at timestamp_ntz",
    )
    assert control.event_rows(events).count() == events.count()


def test_one_database_and_skipped_entries(spark):
    texts = [
        '{"database": {"database_id": "one", "host": "h"}, "tables": [{"name": "t"}, {"name": ""}]}',
        '{"databases": [{"database_id": "two", "host": "h"}, {"database_id": "no"}, {"host": "h"}], "tables": [{"name": "u"}]}',
        "not json",
        '{"tables": [{"name": "v"}]}',
    ]
    documents = control.config_documents(spark.createDataFrame([(t,) for t in texts], "document string"))
    databases, tables = control.expand_config(documents)
    assert sorted(r["database_id"] for r in databases.collect()) == ["one", "two"]
    assert sorted(r["table_id"] for r in tables.collect()) == ["one_t", "two_u"]
    skipped = sorted(map(str, (tuple(r) for r in control.skipped_entries(documents).collect())))
    assert skipped == sorted(
        map(
            str,
            [
                ("database", "no", "without host"),
                ("database", None, "without database_id"),
                ("document", None, "not readable, or without a database"),
                ("document", None, "not readable, or without a database"),
                ("table", "", "without name"),
            ],
        )
    )
