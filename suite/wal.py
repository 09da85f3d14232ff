"""Shaping of change-log lines. The expected values come from the events, not the text."""

from pyspark.sql import functions as F

from suite.fixtures import oracle, table
from tidemark.operators import wal

KEYS = {"pkid": "bigint"}
ACTIVITY = {"assignment_id": "bigint", "period_id": "bigint", "prior_period_id": "bigint"}


def _lines(spark, sf):
    return table(spark, sf, "fx_wal_lines")


def _users_log(spark, sf):
    return table(spark, sf, "fx_changelog").filter("table_name = 'users'")


def wal_filter_table(spark, sf):
    return wal.filter_table(_lines(spark, sf), "data", "users")


def wal_parse_action(spark, sf):
    return wal.parse_action(_lines(spark, sf)).select("lsn", "op")


def wal_parse_key(spark, sf):
    return wal.parse_changes(_lines(spark, sf), "data", "users", KEYS)


def wal_parse_key_composite(spark, sf):
    return wal.parse_changes(_lines(spark, sf), "data", "var_activity", ACTIVITY)


def wal_rejects(spark, sf):
    return wal.rejected_changes(wal_parse_key(spark, sf), ["pkid"])


def wal_split(spark, sf):
    upserts, deletes = wal.split_changes(wal_parse_key(spark, sf), ["pkid"])
    return upserts.withColumn("side", F.lit("upsert")).unionByName(
        deletes.withColumn("side", F.lit("delete"))
    )


def wal_net_changes(spark, sf):
    return wal.net_changes(_users_log(spark, sf), ["pkid"])


def wal_net_changes_delete_wins(spark, sf):
    return wal.net_changes(_users_log(spark, sf), ["pkid"], "delete_wins")


def wal_counts(spark, sf):
    return wal.change_counts(wal.net_changes(wal_parse_key(spark, sf), ["pkid"]))


def wal_preview(spark, sf):
    return wal.preview(_lines(spark, sf), "data", "users", width=50)


QUERIES = {
    f.__name__: f
    for f in (
        wal_filter_table,
        wal_parse_action,
        wal_parse_key,
        wal_parse_key_composite,
        wal_rejects,
        wal_split,
        wal_net_changes,
        wal_net_changes_delete_wins,
        wal_counts,
        wal_preview,
    )
}

_NET = """
    SELECT pkid, lsn, op FROM (
        SELECT pkid, lsn, op, row_number() OVER (PARTITION BY pkid ORDER BY lsn DESC) AS rn
        FROM {fx_changelog} WHERE table_name = 'users') AS ranked
    WHERE rn = 1"""

ORACLES = {
    "wal_filter_table": oracle(
        "SELECT l.lsn, l.data FROM {fx_wal_lines} l JOIN {fx_wal_meaning} m ON l.lsn = m.lsn"
    ),
    "wal_parse_action": oracle(
        """SELECT event_id AS lsn,
                  CASE WHEN event_id % 11 = 0 THEN 'U' WHEN event_id % 13 = 0 THEN 'I'
                       ELSE m.op END AS op
           FROM {events} LEFT JOIN {fx_wal_meaning} m ON event_id = m.lsn
           WHERE event_id % 7 NOT IN (0, 6)"""
    ),
    "wal_parse_key": oracle("SELECT lsn, op, pkid FROM {fx_wal_changes}"),
    "wal_parse_key_composite": oracle(
        """SELECT event_id AS lsn, 'U' AS op, user_id AS assignment_id,
                  event_id % 12 AS period_id, (event_id + 11) % 12 AS prior_period_id
           FROM {events} WHERE event_id % 7 NOT IN (0, 6) AND event_id % 11 = 0"""
    ),
    "wal_rejects": oracle("SELECT lsn, op, pkid FROM {fx_wal_changes} WHERE pkid IS NULL"),
    "wal_split": oracle(
        """SELECT lsn, op, pkid, CASE op WHEN 'D' THEN 'delete' ELSE 'upsert' END AS side
           FROM {fx_wal_changes} WHERE pkid IS NOT NULL"""
    ),
    "wal_net_changes": oracle(_NET),
    "wal_net_changes_delete_wins": oracle(
        f"""SELECT n.pkid, n.lsn, CASE WHEN d.pkid IS NULL THEN n.op ELSE 'D' END AS op
            FROM ({_NET}) n LEFT JOIN
                 (SELECT DISTINCT pkid FROM {{fx_changelog}}
                  WHERE table_name = 'users' AND op = 'D') d ON n.pkid = d.pkid"""
    ),
    "wal_counts": oracle(
        """SELECT upserts, deletes,
                  'WAL (' || upserts || ' upserts, ' || deletes || ' deletes)' AS mode
           FROM (SELECT count(*) FILTER (WHERE op <> 'D') AS upserts,
                        count(*) FILTER (WHERE op = 'D') AS deletes
                 FROM (SELECT pkid, arg_max(op, lsn) AS op FROM {fx_wal_changes}
                       WHERE pkid IS NOT NULL GROUP BY pkid) AS net) AS counted"""
    ),
    "wal_preview": oracle(
        """SELECT l.lsn, CASE WHEN length(l.data) > 50 THEN l.data[1:50] || '...' ELSE l.data END AS text,
                  CAST(count(*) OVER () AS INTEGER) AS total_found
           FROM (SELECT lsn, data FROM {fx_wal_lines} ORDER BY lsn LIMIT 100) AS l
           JOIN {fx_wal_meaning} m ON l.lsn = m.lsn ORDER BY l.lsn LIMIT 10"""
    ),
}
