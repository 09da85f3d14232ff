"""Upserts, deletes, change apply and the key check."""

from pyspark.sql import functions as F

from suite.fixtures import RUN, W, oracle, table
from tidemark.operators import merge, wal

ITEM_KEYS = ["l_orderkey", "l_linenumber"]


def _newer(spark, sf):
    return table(spark, sf, "fx_source_orders").filter(F.col("db_update_date") > F.lit(W).cast("timestamp_ntz"))


def _apply(spark, sf, policy):
    log = table(spark, sf, "fx_changelog").filter("table_name = 'users'")
    return merge.apply_changes(
        table(spark, sf, "fx_target_users"),
        table(spark, sf, "fx_source_users"),
        wal.net_changes(log, ["pkid"], policy),
        ["pkid"],
        policy,
    )


def add_load_timestamp(spark, sf):
    return merge.add_load_timestamp(table(spark, sf, "fx_source_orders"), RUN)


def merge_upsert(spark, sf):
    return merge.merge_upsert(table(spark, sf, "fx_target_orders"), _newer(spark, sf), ["pkid"])


def merge_upsert_composite(spark, sf):
    return merge.merge_upsert(
        table(spark, sf, "fx_target_items"), table(spark, sf, "fx_source_items"), ITEM_KEYS
    )


def merge_upsert_null_keys(spark, sf):
    """NULL keys on both sides: kept in the target, inserted from the source."""
    key = F.when(F.col("pkid") % 3 != 1, F.col("pkid")).alias("pkid")
    rest = ["o_custkey", "o_orderstatus", "total_cents", "db_update_date"]
    return merge.merge_upsert(
        table(spark, sf, "fx_target_orders").select(key, *rest),
        _newer(spark, sf).select(key, *rest),
        ["pkid"],
    )


def merge_upsert_kept_columns(spark, sf):
    """The target has a column that the source has dropped."""
    return merge.merge_upsert(
        table(spark, sf, "fx_target_orders"), _newer(spark, sf).drop("o_custkey"), ["pkid"]
    )


def delete_by_keys(spark, sf):
    doomed = table(spark, sf, "fx_changelog").filter("op = 'D'").select("pkid")
    return merge.delete_by_keys(table(spark, sf, "fx_target_users"), doomed, ["pkid"])


def wal_apply(spark, sf):
    return _apply(spark, sf, "last_change")


def wal_apply_delete_wins(spark, sf):
    return _apply(spark, sf, "delete_wins")


def key_uniqueness_check(spark, sf):
    return merge.duplicate_keys(table(spark, sf, "lineitem"), ITEM_KEYS)


QUERIES = {
    f.__name__: f
    for f in (
        add_load_timestamp,
        merge_upsert,
        merge_upsert_composite,
        merge_upsert_null_keys,
        merge_upsert_kept_columns,
        delete_by_keys,
        wal_apply,
        wal_apply_delete_wins,
        key_uniqueness_check,
    )
}

_USERS = "pkid, full_name, nation_id, balance_cents"
_REST = "o_custkey, o_orderstatus, total_cents, db_update_date"
_NULLED = f"""SELECT CASE WHEN pkid % 3 <> 1 THEN pkid END AS pkid, {_REST}
              FROM {{fx_source_orders}} WHERE db_update_date > TIMESTAMP '{W}'"""
MERGED_ORDERS = oracle(
    f"""SELECT pkid, {_REST} FROM {{fx_source_orders}} WHERE db_update_date > TIMESTAMP '{W}'
        UNION ALL
        SELECT pkid, {_REST} FROM {{fx_target_orders}}
        WHERE pkid NOT IN (SELECT pkid FROM {{fx_source_orders}}
                           WHERE db_update_date > TIMESTAMP '{W}')"""
)


def applied(changes: str, policy: str = "last_change") -> str:
    """SQL for the users target after a relation of ``(lsn, op, pkid)`` was applied."""
    if policy == "last_change":
        return f"""
            SELECT {_USERS} FROM {{fx_target_users}}
            WHERE pkid NOT IN (SELECT pkid FROM {changes} AS c WHERE pkid IS NOT NULL)
            UNION ALL
            SELECT {_USERS} FROM {{fx_source_users}} WHERE pkid IN (
                SELECT pkid FROM {changes} AS c WHERE pkid IS NOT NULL
                GROUP BY pkid HAVING arg_max(op, lsn) <> 'D')"""
    return f"""
        SELECT {_USERS} FROM (
            SELECT {_USERS} FROM {{fx_source_users}}
            WHERE pkid IN (SELECT pkid FROM {changes} AS c WHERE op <> 'D')
            UNION ALL
            SELECT {_USERS} FROM {{fx_target_users}}
            WHERE pkid NOT IN (SELECT pkid FROM {{fx_source_users}}
                               WHERE pkid IN (SELECT pkid FROM {changes} AS c WHERE op <> 'D'))
        ) AS merged
        WHERE pkid NOT IN (SELECT pkid FROM {changes} AS c WHERE op = 'D' AND pkid IS NOT NULL)"""


_USERS_LOG = "(SELECT lsn, op, pkid FROM {fx_changelog} WHERE table_name = 'users')"

ORACLES = {
    "add_load_timestamp": oracle(
        f"SELECT pkid, {_REST}, TIMESTAMP '{RUN}' AS \"_LOADED_AT\" FROM {{fx_source_orders}}"
    ),
    "merge_upsert": MERGED_ORDERS,
    "merge_upsert_composite": oracle(
        """SELECT l_orderkey, l_linenumber, qty, db_update_date FROM {fx_source_items}
           UNION ALL
           SELECT l_orderkey, l_linenumber, qty, db_update_date FROM {fx_target_items} t
           WHERE NOT EXISTS (SELECT 1 FROM {fx_source_items} s
                             WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)"""
    ),
    "merge_upsert_null_keys": oracle(
        f"""SELECT * FROM ({_NULLED}) s
            UNION ALL
            SELECT CASE WHEN pkid % 3 <> 1 THEN pkid END AS pkid, {_REST}
            FROM {{fx_target_orders}} t
            WHERE pkid % 3 = 1 OR NOT EXISTS (SELECT 1 FROM ({_NULLED}) s WHERE s.pkid = t.pkid)"""
    ),
    "merge_upsert_kept_columns": oracle(
        f"""SELECT s.pkid, t.o_custkey, s.o_orderstatus, s.total_cents, s.db_update_date
            FROM {{fx_source_orders}} s LEFT JOIN {{fx_target_orders}} t ON s.pkid = t.pkid
            WHERE s.db_update_date > TIMESTAMP '{W}'
            UNION ALL
            SELECT pkid, {_REST} FROM {{fx_target_orders}}
            WHERE pkid NOT IN (SELECT pkid FROM {{fx_source_orders}}
                               WHERE db_update_date > TIMESTAMP '{W}')"""
    ),
    "delete_by_keys": oracle(
        f"""SELECT {_USERS} FROM {{fx_target_users}}
            WHERE pkid NOT IN (SELECT pkid FROM {{fx_changelog}} WHERE op = 'D')"""
    ),
    "wal_apply": oracle(applied(_USERS_LOG)),
    "wal_apply_delete_wins": oracle(applied(_USERS_LOG, "delete_wins")),
    "key_uniqueness_check": oracle(
        """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM {lineitem}
           WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
           GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
    ),
}
