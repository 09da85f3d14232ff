"""Registries, run log, state table, event log and configuration documents."""

from pyspark.sql import functions as F

from suite.fixtures import RUN, oracle, table
from tidemark import schemas as s
from tidemark.plans import control
from tidemark.plans.store import SnapshotTable
from tidemark.sources.scans import fresh_folder


def _log(spark, sf):
    return table(spark, sf, "fx_sync_log")


def _runs(spark, sf):
    return table(spark, sf, "fx_state_runs")


def run_log_append(spark, sf):
    """Results logged by two appends, read back whole."""
    rows = control.run_log_rows(table(spark, sf, "fx_results"))
    store = SnapshotTable(spark, fresh_folder(spark, "log"))
    store.create(rows.schema)
    store.append(rows.filter("sync_status = 'success'"))
    store.append(rows.filter("sync_status <> 'success'"))
    return store.read()


def log_latest_per_table(spark, sf):
    return control.log_latest_per_table(_log(spark, sf))


def consolidate_log(spark, sf):
    return control.consolidate_log(table(spark, sf, "fx_table_registry"), _log(spark, sf), RUN)


def consolidate_log_twice(spark, sf):
    """Consolidating in two steps, each above the last log id, ends the same."""
    log = _log(spark, sf)
    half = log.agg(F.max("log_id")).first()[0] // 2
    first = control.consolidate_log(
        table(spark, sf, "fx_table_registry"), log.filter(F.col("log_id") <= half), RUN
    )
    return control.consolidate_log(first, log, RUN, after_log_id=half)


def state_upsert(spark, sf):
    changes = _runs(spark, sf).select(
        "source_db",
        "table_name",
        F.col("watermark").alias("last_sync_value"),
        F.lit(RUN).cast("timestamp_ntz").alias("last_sync_ts"),
        F.col("row_count").alias("rows_synced"),
        F.lit("failed").alias("sync_status"),
        F.col("error").alias("error_message"),
    )
    return control.state_upsert(table(spark, sf, "fx_state"), changes)


def state_mark_running(spark, sf):
    return control.state_mark_running(table(spark, sf, "fx_state"), _runs(spark, sf), RUN)


def state_mark_completed(spark, sf):
    return control.state_mark_completed(table(spark, sf, "fx_state"), _runs(spark, sf), RUN)


def state_mark_failed(spark, sf):
    return control.state_mark_failed(table(spark, sf, "fx_state"), _runs(spark, sf), RUN)


def state_get(spark, sf):
    return control.state_get(table(spark, sf, "fx_state"), "db1", "t13")


def state_list(spark, sf):
    return control.state_list(table(spark, sf, "fx_state"))


def state_reset(spark, sf):
    return control.state_reset(table(spark, sf, "fx_state"), "db1", "t13")


def state_reset_all(spark, sf):
    """A stored state table cleared, and filled again by the next runs."""
    store = SnapshotTable(spark, fresh_folder(spark, "state"))
    store.overwrite(table(spark, sf, "fx_state"), control.STATE_KEY)
    store.overwrite(control.state_reset_all(store.read()))
    return control.state_mark_completed(store.read(), _runs(spark, sf), RUN)


def _database_requests(spark, sf):
    """A new address for one known database in two, and one new database per supplier."""
    known = table(spark, sf, "fx_database_registry").filter("database_id <> 'db1'")
    known = known.select(
        "database_id",
        F.concat(F.lit("new_"), "source_db_name").alias("source_db_name"),
        F.lit("new.example.com").alias("host"),
        F.lit(6000).alias("port"),
        F.lit("MOVED").alias("target_schema"),
        F.lit(None).cast("string").alias("source_schema"),
    )
    new = table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), "s_suppkey").alias("database_id"),
        F.col("s_name").alias("source_db_name"),
        F.lit("src.example.com").alias("host"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit(5433)).alias("port"),
        F.concat(F.lit("S"), "s_suppkey").alias("target_schema"),
        F.lit("app").alias("source_schema"),
    )
    return known.unionByName(new)


def register_database(spark, sf):
    return control.register_databases(
        table(spark, sf, "fx_database_registry"), _database_requests(spark, sf), RUN
    )


def register_table(spark, sf):
    """Table t7 of every database switched to wal, and one new table per part."""
    databases = table(spark, sf, "fx_database_registry")
    registry = table(spark, sf, "fx_registry_run")
    known = registry.filter("source_table = 't7'").select(
        "database_id",
        "source_table",
        F.lit("a_id, b_id").alias("primary_key"),
        F.lit("wal").alias("sync_method"),
        F.lit(None).cast("string").alias("cdc_column"),
        F.lit("slot_x").alias("wal_slot"),
    )
    new = table(spark, sf, "part").select(
        F.concat(F.lit("db"), F.col("p_partkey") % 5).alias("database_id"),
        F.concat(F.lit("part_"), "p_partkey").alias("source_table"),
        F.when(F.col("p_size") % 2 == 0, F.lit("p_id")).alias("primary_key"),
        F.when(F.col("p_size") % 3 == 0, F.lit("cdc")).alias("sync_method"),
        F.when(F.col("p_size") % 3 == 0, F.lit("updated_at")).alias("cdc_column"),
        F.lit(None).cast("string").alias("wal_slot"),
    )
    entries = control.table_entries(known.unionByName(new), databases)
    return control.register_tables(registry.to(s.TABLE_REGISTRY), entries, RUN)


def config_texts(spark, sf):
    """One configuration document per customer: two databases, three tables."""
    key = F.col("c_custkey")

    def pick(condition, value):
        return F.when(condition, value if not isinstance(value, str) else F.lit(value))

    def named(prefix, *parts):
        return F.concat(F.lit(prefix), *[p.cast("string") for p in parts])

    def database(i):
        return F.struct(
            pick((key % 7 != 3) if i == 2 else F.lit(True), named(f"db{i}_", key)).alias("database_id"),
            pick(key % 2 == 0, named("app_", key)).alias("source_db_name"),
            pick((key % 5 != 4) if i == 1 else F.lit(True), "src.example.com").alias("host"),
            pick(key % 3 == 0, F.lit(5433)).alias("port"),
            pick(key % 4 == 2, named("X_", key)).alias("target_schema"),
            pick(F.lit(i == 1), named("slot_", key)).alias("wal_slot"),
        )

    def one(j):
        method = [F.lit(None).cast("string"), F.lit("cdc"), F.lit("wal")][j - 1]
        return F.struct(
            pick((key % 6 != 5) if j == 1 else F.lit(True), F.lit(f"Tab_{j}")).alias("name"),
            method.alias("sync_method"),
            pick(key % 2 == 1, "a_id, b_id").alias("primary_key"),
            pick(key % 3 == 1, "modified_at").alias("cdc_column"),
        )

    defaults = F.struct(
        pick(key % 5 == 0, "cdc").alias("sync_method"),
        pick(key % 3 == 0, "pkid").alias("primary_key"),
        pick(key % 4 == 1, "slot_default").alias("wal_slot"),
    )
    document = F.struct(
        F.array(database(1), database(2)).alias("databases"),
        defaults.alias("defaults"),
        F.array(one(1), one(2), one(3)).alias("tables"),
    )
    return table(spark, sf, "customer").select(F.to_json(document).alias("document"))


def expand_config(spark, sf):
    return control.expand_config(control.config_documents(config_texts(spark, sf)))[1]


def expand_config_databases(spark, sf):
    return control.expand_config(control.config_documents(config_texts(spark, sf)))[0]


def list_tables(spark, sf):
    return control.list_tables(table(spark, sf, "fx_registry_run"), "db1")


def event_log_append(spark, sf):
    """Every event logged as a sync event with its payload as JSON metadata."""
    kinds = F.array(*[F.lit(k) for k in control.EVENT_TYPES])
    number = (F.col("event_id") % 8).cast("int")
    events = table(spark, sf, "events").select(
        F.concat(F.lit("db"), F.col("user_id") % 3).alias("source_db"),
        F.concat(F.lit("t"), F.col("user_id") % 14).alias("table_name"),
        F.when(F.col("event_id") % 17 == 0, F.lit("OTHER")).otherwise(kinds[number]).alias("event_type"),
        F.concat(F.lit("event "), "event_id").alias("message"),
        F.floor("value").alias("rows_affected"),
        F.when(number > 2, F.floor(F.col("value") * 10)).alias("duration_ms"),
        F.col("ts").alias("logged_at"),
        "event_id",
        "event_type",
    )
    events = events.toDF(*events.columns[:-1], "cause")
    rows = control.event_rows(events, metadata=("event_id", "cause"))
    store = SnapshotTable(spark, fresh_folder(spark, "events"))
    store.create(rows.schema)
    store.append(rows)
    return store.read()


QUERIES = {
    f.__name__: f
    for f in (
        run_log_append,
        log_latest_per_table,
        consolidate_log,
        consolidate_log_twice,
        state_upsert,
        state_mark_running,
        state_mark_completed,
        state_mark_failed,
        state_get,
        state_list,
        state_reset,
        state_reset_all,
        register_database,
        register_table,
        expand_config,
        expand_config_databases,
        list_tables,
        event_log_append,
    )
}

_STATE = (
    "source_db, table_name, last_sync_value, last_sync_ts, rows_synced, sync_status, error_message"
)


def _state(value: str, rows: str, status: str, error: str) -> str:
    """State after the runs, given SQL for the changed columns over state s and run r."""
    return oracle(
        f"""SELECT {_STATE} FROM {{fx_state}} s
            WHERE NOT EXISTS (SELECT 1 FROM {{fx_state_runs}} r
                              WHERE r.source_db = s.source_db AND r.table_name = s.table_name)
            UNION ALL
            SELECT r.source_db, r.table_name, {value}, TIMESTAMP '{RUN}', {rows}, '{status}', {error}
            FROM {{fx_state_runs}} r LEFT JOIN {{fx_state}} s
              ON r.source_db = s.source_db AND r.table_name = s.table_name"""
    )


_TABLE_COLUMNS = ", ".join(s.TABLE_REGISTRY.names)
_CONSOLIDATED = oracle(f"SELECT {_TABLE_COLUMNS} FROM {{fx_registry_run}}")
_TABLES = """
    FROM (SELECT c_custkey AS k, d.i, t.j
          FROM {customer}, (VALUES (1), (2)) AS d(i), (VALUES (1), (2), (3)) AS t(j)) AS x
    WHERE NOT (i = 2 AND k % 7 = 3) AND NOT (i = 1 AND k % 5 = 4) AND NOT (j = 1 AND k % 6 = 5)"""
_METHOD = "CASE j WHEN 2 THEN 'cdc' WHEN 3 THEN 'wal' ELSE CASE WHEN k % 5 = 0 THEN 'cdc' ELSE 'full' END END"

ORACLES = {
    "run_log_append": oracle(
        """SELECT table_id,
                  CASE WHEN error IS NULL THEN 'success' ELSE ('error: ' || error)[1:500] END AS sync_status,
                  CASE WHEN error IS NULL THEN row_count ELSE 0 END AS sync_records,
                  CAST(CAST(CAST(seconds AS VARCHAR) AS DECIMAL(18,2)) AS DOUBLE) AS sync_duration_sec,
                  CASE WHEN error IS NULL THEN new_watermark END AS new_watermark,
                  CASE WHEN error IS NULL AND method IN ('cdc', 'wal') THEN row_count END AS cdc_rows,
                  logged_at
           FROM {fx_results}"""
    ),
    "log_latest_per_table": oracle("SELECT * FROM {fx_log_latest}"),
    "consolidate_log": _CONSOLIDATED,
    # The newest row of the first half counts where the newest row of all has no value.
    "consolidate_log_twice": oracle(
        f"""SELECT {", ".join(f"r.{c}" for c in s.TABLE_REGISTRY.names if c not in ("last_watermark", "last_cdc_rows"))},
                   coalesce(l.new_watermark, h.new_watermark, t.last_watermark) AS last_watermark,
                   coalesce(r.last_cdc_rows, h.cdc_rows) AS last_cdc_rows
            FROM {{fx_registry_run}} r
            JOIN {{fx_table_registry}} t ON r.table_id = t.table_id
            LEFT JOIN {{fx_log_latest}} l ON r.table_id = l.table_id
            LEFT JOIN (SELECT table_id, new_watermark, cdc_rows FROM {{fx_sync_log}}
                       WHERE log_id <= (SELECT max(log_id) // 2 FROM {{fx_sync_log}})
                       QUALIFY row_number() OVER (PARTITION BY table_id
                                                  ORDER BY logged_at DESC, log_id DESC) = 1
                      ) AS h ON r.table_id = h.table_id"""
    ),
    "state_upsert": _state("r.watermark", "r.row_count", "failed", "r.error[1:4000]"),
    "state_mark_running": _state("s.last_sync_value", "coalesce(s.rows_synced, 0)", "running", "s.error_message"),
    "state_mark_completed": _state(
        "coalesce(r.watermark, s.last_sync_value)", "r.row_count", "completed", "NULL"
    ),
    "state_mark_failed": _state("s.last_sync_value", "0", "failed", "r.error[1:4000]"),
    "state_get": oracle(
        f"SELECT {_STATE} FROM {{fx_state}} WHERE source_db = 'db1' AND table_name = 't13'"
    ),
    "state_list": oracle(f"SELECT {_STATE} FROM {{fx_state}}"),
    "state_reset": oracle(
        f"SELECT {_STATE} FROM {{fx_state}} WHERE NOT (source_db = 'db1' AND table_name = 't13')"
    ),
    "state_reset_all": oracle(
        f"""SELECT source_db, table_name, watermark AS last_sync_value, TIMESTAMP '{RUN}' AS last_sync_ts,
                   row_count AS rows_synced, 'completed' AS sync_status, CAST(NULL AS VARCHAR) AS error_message
            FROM {{fx_state_runs}}"""
    ),
    "register_database": oracle(
        f"""SELECT database_id,
                   CASE WHEN database_id <> 'db1' THEN 'new_' || source_db_name ELSE source_db_name END AS source_db_name,
                   CASE WHEN database_id <> 'db1' THEN 'new.example.com' ELSE host END AS host,
                   CASE WHEN database_id <> 'db1' THEN 6000 ELSE port END AS port,
                   CASE WHEN database_id <> 'db1' THEN 'public' ELSE source_schema END AS source_schema,
                   CASE WHEN database_id <> 'db1' THEN 'MOVED' ELSE target_schema END AS target_schema,
                   is_active, created_at,
                   CASE WHEN database_id <> 'db1' THEN TIMESTAMP '{RUN}' ELSE updated_at END AS updated_at
            FROM {{fx_database_registry}}
            UNION ALL
            SELECT 's' || s_suppkey, s_name, 'src.example.com',
                   CASE WHEN s_suppkey % 2 = 0 THEN 5433 ELSE 5432 END, 'app', 'S' || s_suppkey,
                   TRUE, TIMESTAMP '{RUN}', TIMESTAMP '{RUN}'
            FROM {{supplier}}"""
    ),
    "register_table": oracle(
        f"""SELECT table_id, database_id, source_schema, source_table, target_schema, target_table,
                   CASE WHEN source_table = 't7' THEN 'a_id, b_id' ELSE primary_key_column END AS primary_key_column,
                   sync_enabled,
                   CASE WHEN source_table = 't7' THEN 'wal' ELSE sync_method END AS sync_method,
                   CASE WHEN source_table <> 't7' THEN cdc_column END AS cdc_column,
                   CASE WHEN source_table = 't7' THEN 'slot_x' ELSE wal_slot_name END AS wal_slot_name,
                   last_watermark, last_sync_at, last_sync_status, last_sync_records, last_cdc_rows,
                   batch_size, schema_fingerprint, schema_version, created_at,
                   CASE WHEN source_table = 't7' THEN TIMESTAMP '{RUN}' ELSE updated_at END AS updated_at
            FROM {{fx_registry_run}}
            UNION ALL
            SELECT 'db' || p_partkey % 5 || '_part_' || p_partkey, 'db' || p_partkey % 5, 'data',
                   'part_' || p_partkey, 'TENANT_' || p_partkey % 5, 'PART_' || p_partkey,
                   CASE WHEN p_size % 2 = 0 THEN 'p_id' ELSE 'id' END, TRUE,
                   CASE WHEN p_size % 3 = 0 THEN 'cdc' ELSE 'full' END,
                   CASE WHEN p_size % 3 = 0 THEN 'updated_at' END, NULL, NULL, NULL, NULL, NULL,
                   NULL, 100000, NULL, 1, TIMESTAMP '{RUN}', TIMESTAMP '{RUN}'
            FROM {{part}} WHERE p_partkey % 5 < 3"""
    ),
    "expand_config": oracle(
        f"""SELECT 'db' || i || '_' || k || '_Tab_' || j AS table_id, 'db' || i || '_' || k AS database_id,
                   'public' AS source_schema, 'Tab_' || j AS source_table,
                   CASE WHEN k % 4 = 2 THEN 'X_' || k ELSE 'DB' || i || '_' || k END AS target_schema,
                   'TAB_' || j AS target_table,
                   CASE WHEN k % 2 = 1 THEN 'a_id, b_id' WHEN k % 3 = 0 THEN 'pkid' ELSE 'id' END AS primary_key_column,
                   {_METHOD} AS sync_method,
                   CASE WHEN {_METHOD} = 'cdc' THEN
                       CASE WHEN k % 3 = 1 THEN 'modified_at' ELSE 'db_update_date' END END AS cdc_column,
                   CASE WHEN j = 3 THEN CASE WHEN i = 1 THEN 'slot_' || k
                                             WHEN k % 4 = 1 THEN 'slot_default' END END AS wal_slot_name
            {_TABLES}"""
    ),
    "expand_config_databases": oracle(
        """SELECT 'db' || i || '_' || k AS database_id,
                  CASE WHEN k % 2 = 0 THEN 'app_' || k ELSE 'db' || i || '_' || k END AS source_db_name,
                  'src.example.com' AS host, CASE WHEN k % 3 = 0 THEN 5433 ELSE 5432 END AS port,
                  'public' AS source_schema,
                  CASE WHEN k % 4 = 2 THEN 'X_' || k ELSE 'DB' || i || '_' || k END AS target_schema
           FROM (SELECT c_custkey AS k, d.i FROM {customer}, (VALUES (1), (2)) AS d(i)) AS x
           WHERE NOT (i = 2 AND k % 7 = 3) AND NOT (i = 1 AND k % 5 = 4)"""
    ),
    "list_tables": oracle(
        """SELECT table_id, sync_method, CASE WHEN sync_enabled THEN 'yes' ELSE 'no' END AS enabled,
                  coalesce(last_sync_status, 'never')[1:10] AS status,
                  coalesce(last_sync_records, 0) AS row_count
           FROM {fx_registry_run} WHERE database_id = 'db1'"""
    ),
    "event_log_append": oracle(
        """SELECT 'db' || user_id % 3 AS source_db, 't' || user_id % 14 AS table_name,
                  CASE WHEN event_id % 17 = 0 THEN 'OTHER' ELSE ['SYNC_START', 'SOURCE_COUNT', 'EXTRACT_START', 'EXTRACT_COMPLETE', 'LOAD_START',
                   'LOAD_COMPLETE', 'SYNC_COMPLETE', 'SYNC_FAILED'][event_id % 8 + 1] END AS event_type,
                  'event ' || event_id AS message, CAST(floor(value) AS BIGINT) AS rows_affected,
                  CASE WHEN event_id % 8 > 2 THEN CAST(floor(value * 10) AS BIGINT) END AS duration_ms,
                  '{"event_id":' || event_id || ',"cause":"' || event_type || '"}' AS metadata,
                  ts AS logged_at
           FROM {events}"""
    ),
}
