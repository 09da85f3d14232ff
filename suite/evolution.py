"""Schema fingerprints, differences and reload decisions over a column catalog."""

from pyspark.sql import functions as F

from suite.fixtures import oracle, table
from tidemark.operators import evolution


def _sides(spark, sf):
    return table(spark, sf, "fx_columns_new"), table(spark, sf, "fx_columns_old")


def schema_fingerprint(spark, sf):
    return evolution.schema_fingerprint(table(spark, sf, "fx_columns_new"))


def schema_diff(spark, sf):
    return evolution.schema_diff(*_sides(spark, sf))


def schema_decision(spark, sf):
    new, old = _sides(spark, sf)
    recorded = evolution.schema_fingerprint(old).withColumnRenamed("fingerprint", "was")
    registry = (
        table(spark, sf, "fx_schema_registry")
        .join(recorded, "table_id", "left")
        .select(
            "table_id",
            F.when(F.col("recorded") == "as recorded", F.col("was"))
            .otherwise(F.col("recorded"))
            .alias("schema_fingerprint"),
            F.col("schema_version").cast("int").alias("schema_version"),
        )
    )
    return evolution.schema_decision(registry, new, old)


QUERIES = {f.__name__: f for f in (schema_fingerprint, schema_diff, schema_decision)}


def _print(relation: str) -> str:
    return f"""SELECT table_id,
        substr(md5(string_agg(column_name || ':' || data_type, '|' ORDER BY ordinal)), 1, 16) AS fingerprint
        FROM {relation} GROUP BY table_id"""


# Names on one side only, by an outer join; tables without a recorded side differ in nothing.
_DIFF = f"""
    SELECT t.table_id, t.fingerprint, o.fingerprint AS target_fingerprint,
           coalesce(a.names, '') AS added, coalesce(r.names, '') AS removed
    FROM ({_print('{fx_columns_new}')}) t
    LEFT JOIN ({_print('{fx_columns_old}')}) o ON t.table_id = o.table_id
    LEFT JOIN (SELECT n.table_id, string_agg(upper(n.column_name), ',' ORDER BY upper(n.column_name)) AS names
               FROM {{fx_columns_new}} n
               WHERE NOT EXISTS (SELECT 1 FROM {{fx_columns_old}} p WHERE p.table_id = n.table_id
                                 AND upper(p.column_name) = upper(n.column_name))
                 AND EXISTS (SELECT 1 FROM {{fx_columns_old}} p WHERE p.table_id = n.table_id)
               GROUP BY n.table_id) a ON t.table_id = a.table_id
    LEFT JOIN (SELECT n.table_id, string_agg(upper(n.column_name), ',' ORDER BY upper(n.column_name)) AS names
               FROM {{fx_columns_old}} n
               WHERE NOT EXISTS (SELECT 1 FROM {{fx_columns_new}} p WHERE p.table_id = n.table_id
                                 AND upper(p.column_name) = upper(n.column_name))
               GROUP BY n.table_id) r ON t.table_id = r.table_id"""
_TEXT = """CASE WHEN added = '' AND removed = '' THEN 'column type changes'
                WHEN removed = '' THEN '+[' || added || ']'
                WHEN added = '' THEN '-[' || removed || ']'
                ELSE '+[' || added || '] -[' || removed || ']' END"""

ORACLES = {
    "schema_fingerprint": oracle(_print("{fx_columns_new}")),
    "schema_diff": oracle(
        f"""SELECT table_id, added, removed,
                   CASE WHEN fingerprint = target_fingerprint THEN 'unchanged' ELSE {_TEXT} END AS change
            FROM ({_DIFF}) AS d"""
    ),
    "schema_decision": oracle(
        f"""SELECT table_id, fingerprint,
                   CAST(v + CASE WHEN stored IS NULL OR stored = fingerprint THEN 0 ELSE 1 END AS INTEGER)
                       AS schema_version,
                   stored IS NOT NULL AND stored <> fingerprint AND added <> '' AS force_full,
                   CASE WHEN stored IS NULL THEN 'Schema fingerprint initialized'
                        WHEN stored = fingerprint THEN 'Schema unchanged'
                        ELSE 'Schema evolved v' || v || '->v' || (v + 1) || ': ' || {_TEXT} END AS message
            FROM (SELECT d.*, coalesce(g.schema_version, 0) AS v,
                         CASE WHEN g.recorded = 'as recorded' THEN d.target_fingerprint
                              ELSE g.recorded END AS stored
                  FROM ({_DIFF}) AS d JOIN {{fx_schema_registry}} g ON d.table_id = g.table_id) AS e"""
    ),
}
