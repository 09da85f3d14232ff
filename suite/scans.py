"""Scans, probes, addresses, and reading the change log by position."""

from pyspark.sql import functions as F

from suite.fixtures import W, oracle, table
from tidemark.plans import control
from tidemark.plans.store import SnapshotTable
from tidemark.sources import changelog, dbapi, dialects, scans
from tidemark.sources.scans import FrameSource, TableSpec

ORDERS = TableSpec.of("orders", "pkid", cdc_column="db_update_date", num_partitions=8)
COLUMNS = "pkid, o_custkey, o_orderstatus, total_cents, db_update_date"


def _orders(spark, sf):
    return FrameSource({"orders": table(spark, sf, "fx_source_orders")})


def _bounds(df):
    return df.agg(F.min("pkid"), F.max("pkid")).first()


def _ranges(df, lower, upper):
    """Rows, keys and watermark of each stride."""
    filters = scans.range_filters("pkid", lower, upper, ORDERS.num_partitions)
    number = F.coalesce(*(F.when(f, i) for i, f in enumerate(filters)))
    return df.groupBy(number.alias("range_no")).agg(
        F.count("*").alias("n"),
        F.min("pkid").alias("first_key"),
        F.max("pkid").alias("last_key"),
        F.max("db_update_date").alias("newest"),
    )


def scan_full(spark, sf):
    return scans.scan_full(_orders(spark, sf), ORDERS)


def scan_incremental(spark, sf):
    return scans.scan_incremental(_orders(spark, sf), ORDERS, W)


def scan_partitioned(spark, sf):
    source = _orders(spark, sf)
    lower, upper = _bounds(source.read(ORDERS))
    return _ranges(scans.scan_partitioned(source, ORDERS, lower, upper), lower, upper)


def scan_partitioned_incremental(spark, sf):
    source = _orders(spark, sf)
    lower, upper = _bounds(source.read(ORDERS))
    return _ranges(scans.scan_partitioned(source, ORDERS, lower, upper, W), lower, upper)


def scan_auto(spark, sf):
    rows, count = scans.scan_auto(_orders(spark, sf), ORDERS, W, threshold=5_000)
    return rows.withColumn("source_rows", F.lit(count).cast("bigint"))


def scan_auto_date(spark, sf):
    """A table above the threshold whose rows are dealt out by a time column."""
    spec = TableSpec.of("orders", "pkid", partition_column="db_update_date", num_partitions=8)
    return scans.scan_auto(_orders(spark, sf), spec, threshold=5)[0]


PARTS = 8


def _split(spark, sf, name, types, *keys):
    """Rows and outer keys of each part that a source read by query falls into."""
    files = {name: f"read_parquet('{sf}/{name}.parquet')"}
    source = dbapi.DbApiSource(spark, "duckdb:connect", tables=files, types={name: types})
    spec = TableSpec.of(name, list(keys), num_partitions=PARTS)
    rows, count = scans.scan_auto(source, spec, threshold=1)
    key = F.struct(*keys)
    parts = rows.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")
    )
    return parts.select(
        "part",
        "n",
        F.concat_ws("/", *[F.col(f"lo.{k}").cast("string") for k in keys]).alias("first_key"),
        F.concat_ws("/", *[F.col(f"hi.{k}").cast("string") for k in keys]).alias("last_key"),
        F.lit(count).cast("bigint").alias("source_rows"),
    )


def scan_split_text(spark, sf):
    return _split(spark, sf, "customer", "c_name string", "c_name")


def scan_split_composite(spark, sf):
    """A key of two columns, the first of them shared by many rows."""
    return _split(spark, sf, "orders", "o_custkey bigint, o_orderkey bigint", "o_custkey", "o_orderkey")


def scan_split_date(spark, sf):
    """Parts by a time that many rows share: equal values stay together."""
    files = {"orders": f"read_parquet('{sf}/orders.parquet')"}
    types = {"orders": "o_orderkey bigint, o_orderdate timestamp_ntz"}
    source = dbapi.DbApiSource(spark, "duckdb:connect", tables=files, types=types)
    spec = TableSpec.of("orders", "o_orderkey", partition_column="o_orderdate", num_partitions=PARTS)
    rows = scans.scan_auto(source, spec, threshold=1)[0]
    return (
        rows.withColumn("part", F.spark_partition_id())
        .groupBy("o_orderdate")
        .agg(F.count("*").alias("n"), F.count_distinct("part").alias("parts"))
    )


def scan_paged(spark, sf):
    scans.work_folder(spark)
    paged = scans.scan_paged(table(spark, sf, "fx_source_items"), ["l_orderkey", "l_linenumber"], 1000)
    return paged.groupBy("page").agg(
        F.count("*").alias("n"),
        F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("first_key"),
        F.max(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("last_key"),
    )


def scan_by_keys(spark, sf):
    source = FrameSource({"users": table(spark, sf, "fx_source_users")})
    keys = table(spark, sf, "fx_changelog").filter("op <> 'D'").select("pkid")
    return scans.scan_by_keys(source, TableSpec.of("users", "pkid"), keys)


def source_count(spark, sf):
    return scans.source_count(table(spark, sf, "fx_source_orders"))


def source_max_watermark(spark, sf):
    return scans.source_max_watermark(table(spark, sf, "fx_source_orders"), "db_update_date")


def source_columns(spark, sf):
    catalog = table(spark, sf, "fx_columns_new").select(
        "table_schema",
        F.col("table_id").alias("table_name"),
        F.col("ordinal").alias("ordinal_position"),
        "column_name",
        "data_type",
    )
    return scans.source_columns(catalog, "data")


def source_dialects(spark, sf):
    return dialects.source_addresses(table(spark, sf, "fx_addresses"))


def changelog_read(spark, sf):
    return changelog.changelog_read(table(spark, sf, "fx_wal_lines"), committed_lsn=100)


def changelog_commit(spark, sf):
    """Committed positions after each table of the log was applied in two runs."""
    log = table(spark, sf, "fx_changelog")
    commits = None
    for run in ("op = 'I'", "op <> 'I'"):
        for name in ("users", "rec_items"):
            applied = log.filter(run).filter(F.col("table_name") == name)
            row = changelog.changelog_commit(applied, "slot_0", name)
            commits = row if commits is None else commits.unionByName(row)
    store = SnapshotTable(spark, scans.fresh_folder(spark, "commits"))
    store.overwrite(commits)
    return changelog.committed_positions(store.read())


def enabled_tables(spark, sf):
    return control.enabled_tables(
        table(spark, sf, "fx_table_registry"), table(spark, sf, "fx_database_registry")
    )


QUERIES = {
    f.__name__: f
    for f in (
        scan_full,
        scan_incremental,
        scan_partitioned,
        scan_partitioned_incremental,
        scan_auto,
        scan_auto_date,
        scan_split_text,
        scan_split_composite,
        scan_split_date,
        scan_paged,
        scan_by_keys,
        source_count,
        source_max_watermark,
        source_columns,
        source_dialects,
        changelog_read,
        changelog_commit,
        enabled_tables,
    )
}

_RANGES = """
    SELECT CAST(CASE WHEN pkid IS NULL THEN 0
                ELSE least(greatest((pkid - lo) // greatest((hi - lo) // 8, 1), 0), 7) END
                AS INTEGER) AS range_no,
           count(*) AS n, min(pkid) AS first_key, max(pkid) AS last_key,
           max(db_update_date) AS newest
    FROM {fx_source_orders}, (SELECT min(pkid) AS lo, max(pkid) AS hi FROM {fx_source_orders}) AS b
"""

def _parts(name: str, *keys: str) -> str:
    """SQL for the parts of ``PARTS`` that end at equal numbers of rows in key order."""
    order = ", ".join(keys)
    text = " || '/' || ".join(f"{k}::VARCHAR" for k in keys)
    return f"""
        SELECT part, count(*) AS n, arg_min(name, r) AS first_key, arg_max(name, r) AS last_key, source_rows
        FROM (SELECT r, name, total AS source_rows,
                     len(list_filter(range(1, {PARTS}), lambda i: total * i // {PARTS} < r))::INTEGER AS part
              FROM (SELECT row_number() OVER (ORDER BY {order}) AS r, {text} AS name,
                           count(*) OVER () AS total FROM {{{name}}}) AS numbered) AS dealt
        GROUP BY part, source_rows"""


ORACLES = {
    "scan_auto_date": oracle(f"SELECT {COLUMNS} FROM {{fx_source_orders}}"),
    "scan_split_text": oracle(_parts("customer", "c_name")),
    "scan_split_composite": oracle(_parts("orders", "o_custkey", "o_orderkey")),
    "scan_split_date": oracle(
        "SELECT o_orderdate, count(*) AS n, CAST(1 AS BIGINT) AS parts FROM {orders} GROUP BY o_orderdate"
    ),
    "scan_full": oracle(f"SELECT {COLUMNS} FROM {{fx_source_orders}}"),
    "scan_incremental": oracle(
        f"SELECT {COLUMNS} FROM {{fx_source_orders}} WHERE db_update_date > TIMESTAMP '{W}'"
    ),
    "scan_partitioned": oracle(_RANGES + "GROUP BY 1"),
    "scan_partitioned_incremental": oracle(
        _RANGES + f"WHERE db_update_date > TIMESTAMP '{W}' GROUP BY 1"
    ),
    "scan_auto": oracle(
        f"""SELECT {COLUMNS}, (SELECT count(*) FROM {{fx_source_orders}}) AS source_rows
            FROM {{fx_source_orders}} WHERE db_update_date > TIMESTAMP '{W}'"""
    ),
    "scan_paged": oracle(
        """SELECT page, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS first_key,
                  max(l_orderkey * 10 + l_linenumber) AS last_key
           FROM (SELECT *, (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // 1000 AS page
                 FROM {fx_source_items}) AS numbered
           GROUP BY page"""
    ),
    "scan_by_keys": oracle(
        """SELECT pkid, full_name, nation_id, balance_cents FROM {fx_source_users}
           WHERE pkid IN (SELECT pkid FROM {fx_changelog} WHERE op <> 'D')"""
    ),
    "source_count": oracle("SELECT count(*) AS cnt FROM {fx_source_orders}"),
    "source_max_watermark": oracle("SELECT max(db_update_date) AS max_val FROM {fx_source_orders}"),
    "source_columns": oracle(
        """SELECT table_id, ordinal, column_name, data_type FROM {fx_columns_new}
           WHERE table_schema = 'data'"""
    ),
    "source_dialects": oracle(
        """SELECT database_id,
                  CASE WHEN driver = 'psycopg2' THEN 'postgresql'
                       WHEN driver IN ('pymssql', 'mssql') THEN 'sqlserver'
                       WHEN driver IN ('pymysql', 'mysql') THEN 'mysql' END AS dialect,
                  CASE WHEN driver = 'psycopg2'
                       THEN 'jdbc:postgresql://' || host || ':' || port || '/' || source_db_name || '?sslmode=require'
                       WHEN driver IN ('pymssql', 'mssql')
                       THEN 'jdbc:sqlserver://' || host || ':' || port || ';databaseName=' || source_db_name
                       WHEN driver IN ('pymysql', 'mysql')
                       THEN 'jdbc:mysql://' || host || ':' || port || '/' || source_db_name END AS url,
                  CASE WHEN driver IS NULL OR driver = 'oracledb'
                       THEN 'unknown driver ' || coalesce(driver, 'none') END AS error
           FROM {fx_addresses}"""
    ),
    "changelog_read": oracle(
        "SELECT lsn, data FROM {fx_wal_lines} WHERE lsn > 100"
    ),
    "changelog_commit": oracle(
        "SELECT 'slot_0' AS slot, table_name AS table_id, max(lsn) AS lsn FROM {fx_changelog} GROUP BY table_name"
    ),
    "enabled_tables": oracle(
        """SELECT t.table_id, t.database_id, d.source_db_name, t.source_table, t.target_table,
                  lower(coalesce(t.sync_method, 'full')) AS sync_method,
                  coalesce(t.batch_size, 100000) AS batch_size, t.cdc_column, t.wal_slot_name,
                  t.last_watermark
           FROM {fx_table_registry} t JOIN {fx_database_registry} d ON t.database_id = d.database_id
           WHERE t.sync_enabled AND d.is_active"""
    ),
}

