"""Target tables, whole sync flows, and their streaming forms."""

from datetime import datetime

from pyspark.sql import functions as F

from suite.fixtures import RUN, W, oracle, table
from suite.merging import MERGED_ORDERS, applied
from tidemark.operators import merge
from tidemark.plans import config_sync, flows, registry_sync, rejects
from tidemark.plans.store import SnapshotTable, Warehouse
from tidemark.sources.scans import FrameSource, TableSpec, fresh_folder
from tidemark.streaming import streams

ORDERS = TableSpec.of("orders", "pkid", cdc_column="db_update_date")
ITEMS = TableSpec.of("items", "l_orderkey, l_linenumber", cdc_column="db_update_date")
USERS = TableSpec.of("users", "pkid")
WATERMARK = datetime.fromisoformat(W)


def _store(spark, name="target"):
    return SnapshotTable(spark, fresh_folder(spark, name))


def source(spark, sf):
    return FrameSource(
        {
            "orders": table(spark, sf, "fx_source_orders"),
            "items": table(spark, sf, "fx_source_items"),
            "users": table(spark, sf, "fx_source_users"),
        }
    )


def target(spark, sf, name, keys, buckets=None):
    store = _store(spark)
    store.overwrite(table(spark, sf, name), keys, buckets)
    return store


# --- target tables --------------------------------------------------------------------


def sink_overwrite(spark, sf):
    """A table overwritten while its old rows are being read."""
    store = target(spark, sf, "fx_target_orders", "pkid")
    store.overwrite(merge.merge_upsert(store.read(), table(spark, sf, "fx_source_orders"), ["pkid"]))
    return store.read()


def sink_append(spark, sf):
    store = target(spark, sf, "fx_target_orders", "pkid")
    store.append(table(spark, sf, "fx_source_orders"))
    return store.read()


def sink_merge(spark, sf):
    """A merge into a table of many buckets; only those its keys fall in are rewritten."""
    store = target(spark, sf, "fx_target_orders", "pkid", buckets=32)
    store.merge_rows(table(spark, sf, "fx_source_orders").filter(F.col("db_update_date") > F.lit(W).cast("timestamp_ntz")))
    return store.read()


def sink_delete(spark, sf):
    store = target(spark, sf, "fx_target_orders", "pkid", buckets=8)
    store.delete_keys(table(spark, sf, "fx_source_orders").filter("o_orderstatus = 'F'").select("pkid"))
    return store.read()


def table_from_schema(spark, sf):
    """An empty table in the source's schema, then filled."""
    rows = table(spark, sf, "fx_source_orders")
    store = _store(spark)
    store.create(rows.schema, "pkid")
    empty = store.count()
    store.append(rows)
    return store.read().withColumn("rows_at_first", F.lit(empty).cast("bigint"))


def _names(spark, sf):
    """A warehouse with one table per order status, and one dropped again."""
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    rows = table(spark, sf, "fx_source_orders")
    for status in ("F", "O", "P"):
        warehouse.table("RAW", status).overwrite(rows.filter(F.col("o_orderstatus") == status), "pkid")
    warehouse.table("RAW", "P").drop()
    return warehouse


def _per_status(spark, sf, value, kind):
    warehouse = _names(spark, sf)
    rows = [(n, value(warehouse.table("RAW", n))) for n in ("F", "O", "P")]
    return spark.createDataFrame(rows, f"name string, {kind}")


def table_exists(spark, sf):
    return _per_status(spark, sf, lambda t: t.exists(), "found boolean")


def target_count(spark, sf):
    return _per_status(spark, sf, lambda t: t.count() if t.exists() else None, "cnt bigint")


def target_max_watermark(spark, sf):
    return _per_status(
        spark,
        sf,
        lambda t: t.max_watermark("db_update_date") if t.exists() else None,
        "newest timestamp_ntz",
    )


def truncate_table(spark, sf):
    """A truncated table keeps its columns and takes rows again."""
    store = target(spark, sf, "fx_target_orders", "pkid")
    store.truncate()
    left = store.count()
    store.append(table(spark, sf, "fx_source_orders"))
    return store.read().withColumn("left_over", F.lit(left).cast("bigint"))


def drop_table(spark, sf):
    """A dropped table can be made anew with other columns."""
    store = target(spark, sf, "fx_target_orders", "pkid")
    store.drop()
    store.create(table(spark, sf, "fx_source_users").schema, "pkid")
    store.append(table(spark, sf, "fx_source_users"))
    return store.read()


# --- flows ----------------------------------------------------------------------------


def plan_method(spark, sf):
    registry = table(spark, sf, "fx_registry_run").select(
        "table_id",
        "sync_method",
        "primary_key_column",
        "cdc_column",
        (F.substring("database_id", 3, 1) == "1").alias("schema_changed"),
        (F.substring("database_id", 3, 1) != "2").alias("target_exists"),
    )
    return flows.plan_method(registry)


def _outcome(df, done):
    """Target rows next to what the flow reported."""
    return df.withColumns(
        {
            "reported_rows": F.lit(done.row_count).cast("bigint"),
            "mode": F.lit(done.mode),
            "watermark": F.lit(str(done.watermark)).try_cast("timestamp_ntz"),
        }
    )


def sync_full(spark, sf):
    store = _store(spark)
    done = flows.sync_full(source(spark, sf), ORDERS, store, 1_000, with_watermark=True)
    return _outcome(store.read(), done).withColumn("batches", F.lit(done.batches).cast("bigint"))


class ChangingSource(FrameSource):
    """A source that changes while it is read in parts: the first part is of before.

    ``frames`` hold the rows of before until the read, and those of after from then on.
    """

    one_snapshot = False

    def __init__(self, before, after):
        super().__init__(before)
        self.after = after

    def read_split(self, spec, rows):
        first = F.pmod(F.xxhash64(*spec.keys), F.lit(2)) == 0
        before, self.frames = self.read(spec), self.after
        return before.filter(first).unionByName(self.read(spec).filter(~first))


def sync_full_changing(spark, sf):
    """Rows inserted, changed and deleted between the parts of a reload."""
    after = table(spark, sf, "fx_source_orders")
    kept = after.filter(F.col("db_update_date") <= F.lit(W).cast("timestamp_ntz"))
    lost = table(spark, sf, "fx_target_orders").filter("pkid >= 10000000")
    changed = after.filter(F.col("db_update_date") > F.lit(W).cast("timestamp_ntz")).filter("pkid % 3 = 0")
    stale = changed.withColumns(
        {"total_cents": F.col("total_cents") - 7, "db_update_date": F.lit("1990-01-01").cast("timestamp_ntz")}
    )
    lost = lost.withColumn("db_update_date", F.lit("1990-01-01").cast("timestamp_ntz"))
    before = kept.unionByName(lost).unionByName(stale)
    store = _store(spark)
    done = flows.sync_full(ChangingSource({"orders": before}, {"orders": after}), ORDERS, store, 10)
    return store.read().withColumn("reported_rows", F.lit(done.row_count).cast("bigint"))


def sync_cdc(spark, sf):
    store = target(spark, sf, "fx_target_orders", "pkid", buckets=4)
    done = flows.sync_cdc(source(spark, sf), ORDERS, store, WATERMARK)
    return _outcome(store.read(), done)


def sync_wal(spark, sf):
    store = target(spark, sf, "fx_target_users", "pkid", buckets=4)
    lines = table(spark, sf, "fx_wal_lines")
    done = flows.sync_wal(lines, source(spark, sf), USERS, store, "data")
    return _outcome(store.read(), done).withColumns(
        {
            "rejected": F.lit(done.rejected).cast("bigint"),
            "position": F.lit(done.position).cast("bigint"),
        }
    ).drop("watermark")


def _config(*names):
    """One database per name, each with orders (merged by time) and users (reloaded)."""
    tables = [
        {"name": "orders", "primary_key": ["pkid"], "cdc_column": "db_update_date"},
        {"name": "users", "primary_key": ["pkid"]},
    ]
    return config_sync.SyncConfig.of(
        {
            "source": {"databases": [{"name": n, "tables": tables} for n in names]},
            "target": {"schema_pattern": "{source_db}_RAW"},
            "extraction": {"large_table_threshold": 1000},
        }
    )


def _config_sync(spark, sf, *names):
    """First the rows up to the watermark are loaded, then the source grows to all rows."""
    whole = source(spark, sf).frames
    old = whole["orders"].filter(F.col("db_update_date") <= F.lit(W).cast("timestamp_ntz"))
    grown = {"now": False}

    def source_of(name):
        if name == "lost":
            raise ConnectionError("no such host")
        return FrameSource(whole if grown["now"] else whole | {"orders": old})

    sync = config_sync.ConfigSync(
        _config(*names),
        Warehouse(spark, fresh_folder(spark, "warehouse")),
        source_of,
        clock=lambda: datetime.fromisoformat(RUN),
    )
    return sync, grown


def sync_table(spark, sf):
    """A first load, then a merge of the rows above the stored watermark."""
    sync, grown = _config_sync(spark, sf, "shop")
    sync.sync_table("shop", "orders")
    grown["now"] = True
    result = sync.sync_table("shop", "orders")
    loaded = sync.warehouse.table("SHOP_RAW", "ORDERS").read()
    return loaded.withColumns(
        {"status": F.lit(result["status"]), "merged": F.lit(result["rows"]).cast("bigint")}
    )


def _report(spark, results):
    rows = [(r["database"], r["table"], r["status"], r.get("rows"), r.get("error")) for r in results]
    return spark.createDataFrame(
        rows, "source_db string, table_name string, status string, row_count bigint, error string"
    )


def sync_database(spark, sf):
    sync, _ = _config_sync(spark, sf, "shop", "lost")
    return _report(spark, sync.sync_database("shop"))


def sync_all(spark, sf):
    """Two databases, one out of reach, synced twice; a failure keeps the others going."""
    sync, grown = _config_sync(spark, sf, "shop", "lost")
    sync.sync_all()
    grown["now"] = True
    return _report(spark, sync.sync_all())


def sync_registry(spark, sf):
    """Tables of the registries synced by all three methods, twice, then consolidated."""
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    lines = table(spark, sf, "fx_wal_lines")
    half = lines.agg(F.max("lsn")).first()[0] // 2
    tables = source(spark, sf)
    seen = {"lines": lines.filter(F.col("lsn") <= half)}
    sync = registry_sync.RegistrySync(
        warehouse,
        source_of=lambda database: tables,
        changelog_of=lambda database, slot: seen["lines"],
        clock=lambda: datetime.fromisoformat(RUN),
    )
    sync.register_databases(
        spark.createDataFrame(
            [("shop", "app", "src.example.com", "RAW", "data")],
            "database_id string, source_db_name string, host string, target_schema string, source_schema string",
        )
    )
    rows = [
        ("shop_orders", "shop", "data", "orders", "RAW", "ORDERS", "pkid", "cdc", "db_update_date", None),
        ("shop_items", "shop", "data", "items", "RAW", "ITEMS", "l_orderkey, l_linenumber", "full", None, None),
        ("shop_users", "shop", "data", "users", "RAW", "USERS", "pkid", "wal", None, "slot_0"),
        ("shop_gone", "shop", "data", "gone", "RAW", "GONE", "pkid", "full", None, None),
    ]
    sync.register_tables(
        spark.createDataFrame(
            rows,
            "table_id string, database_id string, source_schema string, source_table string, "
            "target_schema string, target_table string, primary_key_column string, "
            "sync_method string, cdc_column string, wal_slot_name string",
        )
    )
    sync.sync_all()
    seen["lines"] = lines
    sync.sync_all()
    return sync.tables.read().select(
        "table_id",
        F.substring("last_sync_status", 1, 6).alias("status"),
        "last_sync_records",
        "last_watermark",
        F.length("schema_fingerprint").alias("fingerprint_length"),
    )


# --- watermarks of other types --------------------------------------------------------

_DAYS = "datediff(db_update_date, DATE '1990-01-01')"
#: A column that grows with the time of change, by its type.
VERSIONS = {
    "bigint": f"CAST({_DAYS} AS BIGINT) * 10 + pkid % 10",
    "decimal": f"CAST({_DAYS} * 10 + pkid % 10 AS DECIMAL(18,0)) / 4",
    "date": "CAST(db_update_date AS DATE)",
    "text": f"concat('v', lpad(CAST({_DAYS} AS STRING), 8, '0'))",
    "zoned": "CAST(concat(CAST(db_update_date AS STRING), '+00:00') AS TIMESTAMP)",
}


def _typed_cdc(spark, sf, kind):
    """Two registry runs by a column of one type: the second may read newer rows only.

    The result is the target with the rows each run read and the stored watermark.
    """
    rows = table(spark, sf, "fx_source_orders").withColumn("version", F.expr(VERSIONS[kind]))
    old = rows.filter(F.col("db_update_date") <= F.lit(W).cast("timestamp_ntz"))
    seen = {"orders": old}
    sync = registry_sync.RegistrySync(
        Warehouse(spark, fresh_folder(spark, "warehouse")),
        source_of=lambda database: FrameSource(seen),
        clock=lambda: datetime.fromisoformat(RUN),
    )
    sync.register_databases(
        spark.createDataFrame([("shop", "RAW", "data")], "database_id string, target_schema string, source_schema string")
    )
    sync.register_tables(
        spark.createDataFrame(
            [("shop_orders", "shop", "data", "orders", "RAW", "ORDERS", "pkid", "cdc", "version")],
            "table_id string, database_id string, source_schema string, source_table string, "
            "target_schema string, target_table string, primary_key_column string, "
            "sync_method string, cdc_column string",
        )
    )
    first = sync.sync_all()[0].row_count
    seen["orders"] = rows
    second = sync.sync_all()[0]
    row = sync.tables.read().first()
    return sync.warehouse.table("RAW", "ORDERS").read().drop("version").withColumns(
        {
            "first_rows": F.lit(first).cast("bigint"),
            "second_rows": F.lit(second.row_count).cast("bigint"),
            "second_method": F.lit(second.method),
            "watermark": F.lit(row["watermark_text"]),
        }
    )


def sync_cdc_bigint(spark, sf):
    return _typed_cdc(spark, sf, "bigint")


def sync_cdc_decimal(spark, sf):
    return _typed_cdc(spark, sf, "decimal")


def sync_cdc_date(spark, sf):
    return _typed_cdc(spark, sf, "date")


def sync_cdc_text(spark, sf):
    return _typed_cdc(spark, sf, "text")


def sync_cdc_zoned(spark, sf):
    return _typed_cdc(spark, sf, "zoned")


# --- whole targets after two runs -----------------------------------------------------


def _rows_of(warehouse, places):
    """Key and amount of every row of some targets."""
    found = None
    for schema, name, key, amount in places:
        rows = warehouse.table(schema, name).read().select(
            F.lit(f"{schema}.{name}").alias("table_name"),
            F.col(key).cast("bigint").alias("key"),
            F.col(amount).cast("bigint").alias("amount"),
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def _shop_rows(sync, *databases):
    names = (("ORDERS", "total_cents"), ("USERS", "balance_cents"))
    return _rows_of(
        sync.warehouse, [(f"{d.upper()}_RAW", n, "pkid", a) for d in databases for n, a in names]
    )


def sync_database_rows(spark, sf):
    """Both tables of one database after a load and a run over the grown source."""
    sync, grown = _config_sync(spark, sf, "shop", "lost")
    sync.sync_database("shop")
    grown["now"] = True
    sync.sync_database("shop")
    return _shop_rows(sync, "shop")


def sync_all_rows(spark, sf):
    sync, grown = _config_sync(spark, sf, "shop", "lost", "mart")
    sync.sync_all()
    grown["now"] = True
    sync.sync_all()
    return _shop_rows(sync, "shop", "mart")


def sync_events(spark, sf):
    """The event log of one table's merge, with what its metadata says."""
    sync, grown = _config_sync(spark, sf, "shop", "lost")
    sync.sync_table("shop", "orders")
    grown["now"] = True
    sync.sync_table("shop", "orders")
    sync.sync_table("lost", "users")
    told = F.from_json("metadata", "target string, full_refresh boolean, large boolean, load string, error string")
    return sync.events.read().select(
        "source_db", "table_name", "event_type", "rows_affected", told.alias("told")
    ).select("source_db", "table_name", "event_type", "rows_affected", "told.*")


# --- rejected log lines ---------------------------------------------------------------


def sync_wal_rejects(spark, sf):
    """What a run of the log could not apply, stored once although the run is repeated."""
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    letters = rejects.DeadLetters(rejects.rejects_table(warehouse, "CONTROL"), "slot_0", "shop_users")
    store = target(spark, sf, "fx_target_users", "pkid", buckets=4)
    for _ in range(2):
        flows.sync_wal(
            table(spark, sf, "fx_wal_lines"), source(spark, sf), USERS, store, "data", dead_letters=letters
        )
    return letters.pending().select("slot", "table_id", "lsn", "data", "reason")


def replay_rejects(spark, sf):
    """Rejected lines of a registry run, repaired and applied: the users target."""
    sync, seen, lines = _users_registry(spark, sf)
    sync.sync_all()
    seen["lines"] = lines
    sync.sync_all()
    stored = sync.rejected.read()
    before = stored.count()
    users = table(spark, sf, "events").select(F.col("event_id").alias("lsn"), "user_id")
    repaired = stored.join(users, "lsn").select(
        "lsn", F.format_string("table data.users: DELETE: pkid[integer]:%d", "user_id").alias("data")
    )
    sync.replay_rejects("shop_users", repaired)
    return sync.warehouse.table("RAW", "USERS").read().withColumns(
        {
            "stored": F.lit(before).cast("bigint"),
            "left_over": F.lit(sync.rejected.count()).cast("bigint"),
        }
    )


def _users_registry(spark, sf):
    """A registry with the users table on a log of which the first half has landed."""
    lines = table(spark, sf, "fx_wal_lines")
    half = lines.agg(F.max("lsn")).first()[0] // 2
    tables, seen = source(spark, sf), {"lines": lines.filter(F.col("lsn") <= half)}
    sync = registry_sync.RegistrySync(
        Warehouse(spark, fresh_folder(spark, "warehouse")),
        source_of=lambda database: tables,
        changelog_of=lambda database, slot: seen["lines"],
        clock=lambda: datetime.fromisoformat(RUN),
    )
    sync.register_databases(
        spark.createDataFrame([("shop", "RAW", "data")], "database_id string, target_schema string, source_schema string")
    )
    sync.register_tables(
        spark.createDataFrame(
            [("shop_users", "shop", "data", "users", "RAW", "USERS", "pkid", "wal", "slot_0")],
            "table_id string, database_id string, source_schema string, source_table string, "
            "target_schema string, target_table string, primary_key_column string, "
            "sync_method string, wal_slot_name string",
        )
    )
    return sync, seen, lines


# --- streams --------------------------------------------------------------------------


def _polled(spark, df, column, start, polls=3, backwards=False):
    """Rows landed by range of ``column``; after each range the stream polls once.

    What has landed by a poll is one micro-batch. The folder is returned.
    """
    path, checkpoint = fresh_folder(spark, "landing"), fresh_folder(spark, "stream")
    low, high = df.agg(F.min(column), F.max(column)).first()
    width = (high - low) // polls + 1
    for poll in reversed(range(polls)) if backwards else range(polls):
        first = low + poll * width
        landed = df.filter((F.col(column) >= first) & (F.col(column) < first + width))
        landed.write.mode("append").parquet(path)
        start(spark.readStream.schema(df.schema).parquet(path), checkpoint).awaitTermination()
    return path


def stream_wal(spark, sf):
    """The log applied by several polls of a stream equals one batch apply."""
    store = target(spark, sf, "fx_target_users", "pkid", buckets=4)
    tables = source(spark, sf)
    types = {"pkid": "bigint"}

    def start(lines, checkpoint):
        return streams.stream_wal(lines, tables, USERS, store, "data", checkpoint, types)

    _polled(spark, table(spark, sf, "fx_wal_lines"), "lsn", start)
    return store.read()


def stream_wal_reverse(spark, sf):
    """The newest part of the log first, then the others, then all of it once more."""
    store = target(spark, sf, "fx_target_users", "pkid", buckets=4)
    tables = source(spark, sf)
    types = {"pkid": "bigint"}

    def start(lines, checkpoint):
        return streams.stream_wal(lines, tables, USERS, store, "data", checkpoint, types)

    lines = table(spark, sf, "fx_wal_lines")
    path = _polled(spark, lines, "lsn", start, backwards=True)
    again = spark.readStream.schema(lines.schema).parquet(path)
    start(again, fresh_folder(spark, "stream")).awaitTermination()
    return store.read()


def stream_cdc(spark, sf):
    store = target(spark, sf, "fx_target_orders", "pkid", buckets=4)
    rows = table(spark, sf, "fx_source_orders").filter(F.col("db_update_date") > F.lit(W).cast("timestamp_ntz"))

    def start(changed, checkpoint):
        return streams.stream_cdc(changed, ["pkid"], "db_update_date", store, checkpoint)

    _polled(spark, rows, "pkid", start)
    return store.read()


QUERIES = {
    f.__name__: f
    for f in (
        sink_overwrite,
        sink_append,
        sink_merge,
        sink_delete,
        table_from_schema,
        table_exists,
        target_count,
        target_max_watermark,
        truncate_table,
        drop_table,
        plan_method,
        sync_full,
        sync_full_changing,
        sync_cdc,
        sync_wal,
        sync_table,
        sync_database,
        sync_all,
        sync_registry,
        sync_cdc_bigint,
        sync_cdc_decimal,
        sync_cdc_date,
        sync_cdc_text,
        sync_cdc_zoned,
        sync_database_rows,
        sync_all_rows,
        sync_events,
        sync_wal_rejects,
        replay_rejects,
        stream_wal,
        stream_wal_reverse,
        stream_cdc,
    )
}

_C = "pkid, o_custkey, o_orderstatus, total_cents, db_update_date"
_U = "pkid, full_name, nation_id, balance_cents"
_NEWER = f"db_update_date > TIMESTAMP '{W}'"


def _merged(which: str) -> str:
    """Orders target after merging the source rows that satisfy ``which``."""
    return f"""SELECT {_C} FROM {{fx_source_orders}} WHERE {which}
               UNION ALL SELECT {_C} FROM {{fx_target_orders}}
               WHERE pkid NOT IN (SELECT pkid FROM {{fx_source_orders}} WHERE {which})"""


_RESULTS = """
    SELECT 'shop' AS source_db, 'orders' AS table_name, 'success' AS status,
           (SELECT count(*) FROM {{fx_source_orders}} WHERE {0}) AS row_count, CAST(NULL AS VARCHAR) AS error
    UNION ALL SELECT 'shop', 'users', 'success', (SELECT count(*) FROM {{fx_source_users}}), NULL"""

_DUCK_DAYS = "date_diff('day', DATE '1990-01-01', CAST(db_update_date AS DATE))"
_DUCK_VERSIONS = {
    "bigint": (f"{_DUCK_DAYS} * 10 + pkid % 10", "CAST(top AS VARCHAR)"),
    "decimal": (f"CAST(({_DUCK_DAYS} * 10 + pkid % 10) * 25 AS BIGINT)", "rtrim_zeros"),
    "date": ("CAST(db_update_date AS DATE)", "strftime(top, '%Y-%m-%dT00:00:00')"),
    "text": (f"'v' || lpad(CAST({_DUCK_DAYS} AS VARCHAR), 8, '0')", "top"),
    "zoned": ("db_update_date", "strftime(top, '%Y-%m-%dT%H:%M:%S')"),
}


def _typed_sql(kind: str) -> str:
    """Orders after a load up to the time and a merge of what lies above its highest version.

    The decimal's hundredfold is compared, and printed with as many places as Spark has.
    """
    version, text = _DUCK_VERSIONS[kind]
    if text == "rtrim_zeros":
        text = "printf('%d.%02d0000', top // 100, top % 100)"
    return oracle(
        f"""SELECT * FROM (
            WITH versions AS (SELECT {_C}, {version} AS version FROM {{fx_source_orders}}),
                 first AS (SELECT * FROM versions WHERE NOT {_NEWER}),
                 later AS (SELECT * FROM versions WHERE version > (SELECT max(version) FROM first))
            SELECT r.*, (SELECT count(*) FROM first) AS first_rows, (SELECT count(*) FROM later) AS second_rows,
                   'cdc' AS second_method, {text} AS watermark
            FROM (SELECT {_C} FROM first WHERE pkid NOT IN (SELECT pkid FROM later)
                  UNION ALL SELECT {_C} FROM later) AS r,
                 (SELECT max(version) AS top FROM versions) AS t) AS runs"""
    )


def _shop_sql(*databases: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{d.upper()}_RAW.ORDERS' AS table_name, pkid AS key, total_cents AS amount FROM {{fx_source_orders}}
            UNION ALL SELECT '{d.upper()}_RAW.USERS', pkid, balance_cents FROM {{fx_source_users}}"""
        for d in databases
    )


_HALF = "lsn > (SELECT max(lsn) // 2 FROM {fx_wal_lines})"
_EVENT = "'shop' AS source_db, 'orders' AS table_name"
_TOLD = "CAST(NULL AS VARCHAR) AS error"

ORACLES = {
    **{f"sync_cdc_{kind}": _typed_sql(kind) for kind in _DUCK_VERSIONS},
    "sync_full_changing": oracle(
        f"SELECT {_C}, (SELECT count(*) FROM {{fx_source_orders}}) AS reported_rows FROM {{fx_source_orders}}"
    ),
    "sync_database_rows": oracle(_shop_sql("shop")),
    "sync_all_rows": oracle(_shop_sql("shop", "mart")),
    "sync_events": oracle(
        f"""SELECT {_EVENT}, event_type, rows_affected, target, full_refresh, large, load, error
            FROM (SELECT count(*) AS n, count(*) FILTER (NOT {_NEWER}) AS o,
                         count(*) FILTER ({_NEWER} AND db_update_date > (
                             SELECT max(db_update_date) FROM {{fx_source_orders}} WHERE NOT {_NEWER})) AS w
                  FROM {{fx_source_orders}}) AS c,
                 LATERAL (VALUES
                    ('SYNC_START', NULL, 'SHOP_RAW.ORDERS', false, NULL, NULL, NULL),
                    ('SOURCE_COUNT', o, NULL, NULL, o > 1000, NULL, NULL),
                    ('EXTRACT_START', NULL, NULL, NULL, NULL, NULL, NULL),
                    ('EXTRACT_COMPLETE', NULL, NULL, NULL, NULL, NULL, NULL),
                    ('LOAD_START', NULL, NULL, NULL, NULL, NULL, NULL),
                    ('LOAD_COMPLETE', o, NULL, NULL, NULL, NULL, NULL),
                    ('SYNC_COMPLETE', o, NULL, NULL, NULL, 'FULL', NULL),
                    ('SYNC_START', NULL, 'SHOP_RAW.ORDERS', false, NULL, NULL, NULL),
                    ('SOURCE_COUNT', n, NULL, NULL, n > 1000, NULL, NULL),
                    ('EXTRACT_START', NULL, NULL, NULL, NULL, NULL, NULL),
                    ('EXTRACT_COMPLETE', NULL, NULL, NULL, NULL, NULL, NULL),
                    ('LOAD_START', NULL, NULL, NULL, NULL, NULL, NULL),
                    ('LOAD_COMPLETE', w, NULL, NULL, NULL, NULL, NULL),
                    ('SYNC_COMPLETE', w, NULL, NULL, NULL, 'MERGE', NULL)
                 ) AS e(event_type, rows_affected, target, full_refresh, large, load, error)
            UNION ALL SELECT 'lost', 'users', 'SYNC_START', NULL, 'LOST_RAW.USERS', false, NULL, NULL, NULL
            UNION ALL SELECT 'lost', 'users', 'SYNC_FAILED', NULL, NULL, NULL, NULL, NULL, 'ConnectionError'"""
    ),
    "sync_wal_rejects": oracle(
        """SELECT 'slot_0' AS slot, 'shop_users' AS table_id, lsn, data, 'no readable key: pkid' AS reason
           FROM {fx_wal_lines} WHERE lsn IN (SELECT lsn FROM {fx_wal_changes} WHERE pkid IS NULL)"""
    ),
    "replay_rejects": oracle(
        f"""SELECT {_U}, stored, CAST(0 AS BIGINT) AS left_over
            FROM {{fx_source_users}},
                 (SELECT count(*) AS stored FROM {{fx_wal_changes}} WHERE pkid IS NULL AND {_HALF}) AS s
            WHERE pkid NOT IN (SELECT pkid FROM {{fx_wal_changes}} WHERE pkid IS NOT NULL AND {_HALF}
                               GROUP BY pkid HAVING arg_max(op, lsn) = 'D')
               OR pkid IN (SELECT user_id FROM {{events}} JOIN {{fx_wal_changes}} ON event_id = lsn
                           WHERE pkid IS NULL AND {_HALF})"""
    ),
    "stream_wal_reverse": oracle(applied("{fx_wal_changes}")),
    "sink_overwrite": oracle(
        f"""SELECT {_C} FROM {{fx_source_orders}} UNION ALL
            SELECT {_C} FROM {{fx_target_orders}} WHERE pkid >= 10000000"""
    ),
    "sink_append": oracle(
        f"SELECT {_C} FROM {{fx_source_orders}} UNION ALL SELECT {_C} FROM {{fx_target_orders}}"
    ),
    "sink_merge": MERGED_ORDERS,
    "sink_delete": oracle(
        f"""SELECT {_C} FROM {{fx_target_orders}}
            WHERE pkid NOT IN (SELECT pkid FROM {{fx_source_orders}} WHERE o_orderstatus = 'F')"""
    ),
    "table_from_schema": oracle(
        f"SELECT {_C}, CAST(0 AS BIGINT) AS rows_at_first FROM {{fx_source_orders}}"
    ),
    "table_exists": oracle(
        "SELECT o_orderstatus AS name, o_orderstatus <> 'P' AS found FROM {orders} GROUP BY o_orderstatus"
    ),
    "target_count": oracle(
        """SELECT o_orderstatus AS name, CASE WHEN o_orderstatus <> 'P' THEN count(*) END AS cnt
           FROM {orders} GROUP BY o_orderstatus"""
    ),
    "target_max_watermark": oracle(
        """SELECT o_orderstatus AS name, CASE WHEN o_orderstatus <> 'P' THEN max(o_orderdate) END AS newest
           FROM {orders} GROUP BY o_orderstatus"""
    ),
    "truncate_table": oracle(
        f"SELECT {_C}, CAST(0 AS BIGINT) AS left_over FROM {{fx_source_orders}}"
    ),
    "drop_table": oracle(f"SELECT {_U} FROM {{fx_source_users}}"),
    "plan_method": oracle(
        """SELECT table_id,
                  CASE WHEN forced THEN 'full' WHEN method = 'wal' AND keyed THEN 'wal'
                       WHEN method = 'cdc' AND keyed AND cdc_column <> '' THEN 'cdc' ELSE 'full' END AS method,
                  CASE WHEN forced AND method = 'cdc' AND changed THEN 'FULL (schema change)'
                       WHEN forced AND method = 'cdc' THEN 'FULL (initial)'
                       WHEN forced THEN 'FULL' WHEN method = 'wal' AND keyed THEN 'WAL'
                       WHEN method = 'cdc' AND keyed AND cdc_column <> '' THEN 'CDC' ELSE 'FULL' END AS mode
           FROM (SELECT table_id, lower(coalesce(sync_method, 'full')) AS method,
                        primary_key_column <> '' AS keyed, cdc_column,
                        database_id = 'db1' AS changed, database_id IN ('db1', 'db2') AS forced
                 FROM {fx_registry_run}) AS r"""
    ),
    "sync_full": oracle(
        f"""SELECT {_C}, n AS reported_rows, 'FULL' AS mode, top AS watermark,
                   CASE WHEN n > 1000 THEN CAST(ceil(n / 1000) AS BIGINT) ELSE 1 END AS batches
            FROM {{fx_source_orders}},
                 (SELECT count(*) AS n, max(db_update_date) AS top FROM {{fx_source_orders}}) AS r"""
    ),
    "sync_cdc": oracle(
        f"""SELECT m.*, n AS reported_rows, 'CDC (merge)' AS mode, top AS watermark
            FROM ({_merged(_NEWER)}) AS m,
                 (SELECT count(*) AS n, max(db_update_date) AS top FROM {{fx_source_orders}}
                  WHERE {_NEWER}) AS r"""
    ),
    "sync_wal": oracle(
        f"""SELECT m.*, u + d AS reported_rows,
                   'WAL (' || u || ' upserts, ' || d || ' deletes)' AS mode, rejected, position
            FROM ({applied("{fx_wal_changes}")}) AS m,
                 (SELECT count(*) FILTER (WHERE op <> 'D' AND pkid IN (SELECT pkid FROM {{fx_source_users}})) AS u,
                         count(*) FILTER (WHERE op = 'D') AS d
                  FROM (SELECT pkid, arg_max(op, lsn) AS op FROM {{fx_wal_changes}}
                        WHERE pkid IS NOT NULL GROUP BY pkid) AS net) AS r,
                 (SELECT count(*) FILTER (WHERE pkid IS NULL) AS rejected FROM {{fx_wal_changes}}) AS x,
                 (SELECT max(lsn) AS position FROM {{fx_wal_lines}}) AS p"""
    ),
    "sync_table": oracle(
        f"""SELECT {_C}, TIMESTAMP '{RUN}' AS "_LOADED_AT", 'success' AS status, n AS merged
            FROM {{fx_source_orders}},
                 (SELECT count(*) AS n FROM {{fx_source_orders}}
                  WHERE db_update_date > (SELECT max(db_update_date) FROM {{fx_source_orders}}
                                          WHERE NOT {_NEWER})) AS r"""
    ),
    "sync_database": oracle(_RESULTS.format(f"NOT {_NEWER}")),
    "sync_all": oracle(
        _RESULTS.format(_NEWER)
        + """ UNION ALL SELECT 'lost', 'orders', 'failed', NULL, 'no such host'
              UNION ALL SELECT 'lost', 'users', 'failed', NULL, 'no such host'"""
    ),
    "sync_registry": oracle(
        """SELECT 'shop_orders' AS table_id, 'succes' AS status, CAST(0 AS BIGINT) AS last_sync_records,
                  max(db_update_date) AS last_watermark, 16 AS fingerprint_length FROM {fx_source_orders}
           UNION ALL SELECT 'shop_items', 'succes', count(*), NULL, 16 FROM {fx_source_items}
           UNION ALL
           SELECT 'shop_users', 'succes',
                  count(*) FILTER (WHERE op = 'D' OR pkid IN (SELECT pkid FROM {fx_source_users})), NULL, 16
           FROM (SELECT pkid, arg_max(op, lsn) AS op FROM {fx_wal_changes}
                 WHERE pkid IS NOT NULL AND lsn > (SELECT max(lsn) // 2 FROM {fx_wal_lines})
                 GROUP BY pkid) AS net
           UNION ALL SELECT 'shop_gone', 'error:', 0, NULL, NULL"""
    ),
    "stream_wal": oracle(applied("{fx_wal_changes}")),
    "stream_cdc": MERGED_ORDERS,
}
