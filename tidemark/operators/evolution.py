"""Schema comparison over column catalogs ``(table_id, ordinal, column_name, data_type)``.

The arrays below hold the columns of one table, a number every source database
bounds by itself; all tables of a catalog are compared in one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINGERPRINT_LENGTH = 16

# What a decision says.
INITIALIZED = "Schema fingerprint initialized"
UNCHANGED = "Schema unchanged"
EVOLVED = "Schema evolved v%d->v%d: %s"
RETYPED = "column type changes"


def _fingerprint(columns: Column) -> Column:
    """Fingerprint of an array of column structs that is in ordinal order."""
    pairs = F.transform(columns, lambda c: F.concat_ws(":", c["column_name"], c["data_type"]))
    return F.substring(F.md5(F.concat_ws("|", pairs)), 1, FINGERPRINT_LENGTH)


def schema_fingerprint(columns: DataFrame, by: Sequence[str] = ("table_id",)) -> DataFrame:
    """Fingerprint per table, in ordinal order."""
    listed = F.sort_array(F.collect_list(F.struct("ordinal", "column_name", "data_type")))
    return columns.groupBy(*by).agg(_fingerprint(listed).alias("fingerprint"))


def _sides(source: DataFrame, target: DataFrame) -> DataFrame:
    """Per table: source fingerprint, and added and removed names (upper case, sorted)."""
    names = ("table_id", "ordinal", "column_name", "data_type")
    both = (
        source.select(*names, F.lit(True).alias("_new"))
        .unionByName(target.select(*names, F.lit(False).alias("_new")))
    )
    entry = F.struct("_new", "ordinal", "column_name", "data_type")
    listed = both.groupBy("table_id").agg(F.sort_array(F.collect_list(entry)).alias("_columns"))
    split = listed.select(
        "table_id",
        F.filter("_columns", lambda c: c["_new"]).alias("_source"),
        F.filter("_columns", lambda c: ~c["_new"]).alias("_target"),
    )
    known = F.size("_target") > 0

    def names(side: str) -> Column:
        return F.transform(side, lambda c: F.upper(c["column_name"]))

    def only(a: str, b: str) -> Column:
        rest = F.sort_array(F.array_except(names(a), names(b)))
        return F.when(known, rest).otherwise(F.array().cast("array<string>"))

    return split.select(
        "table_id",
        _fingerprint(F.col("_source")).alias("fingerprint"),
        _fingerprint(F.col("_target")).alias("target_fingerprint"),
        only("_source", "_target").alias("added"),
        only("_target", "_source").alias("removed"),
    )


def _change_text() -> Column:
    added = F.when(F.size("added") > 0, F.concat(F.lit("+["), F.concat_ws(",", "added"), F.lit("]")))
    removed = F.when(
        F.size("removed") > 0, F.concat(F.lit("-["), F.concat_ws(",", "removed"), F.lit("]"))
    )
    text = F.concat_ws(" ", added, removed)
    return F.when(text == "", RETYPED).otherwise(text)


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Added and removed columns per table, and what changed in words.

    The target's columns are those recorded in the source's own type names, so
    equal names with another fingerprint mean a retyped column.
    """
    sides = _sides(source, target)
    same = F.col("fingerprint") == F.col("target_fingerprint")
    return sides.select(
        "table_id",
        F.concat_ws(",", "added").alias("added"),
        F.concat_ws(",", "removed").alias("removed"),
        F.when(same, "unchanged").otherwise(_change_text()).alias("change"),
    )


def schema_decision(registry: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """Whether each registered table must be reloaded, and the message that says why.

    ``registry`` holds ``(table_id, schema_fingerprint, schema_version)``. New
    columns force a reload. Removed or retyped columns do not: the target keeps
    its extra columns. The result carries what consolidation should store.
    """
    sides = _sides(source, target).drop("target_fingerprint")
    old = F.col("schema_fingerprint")
    version = F.coalesce(F.col("schema_version"), F.lit(0))
    initial = old.isNull() | (old == "")
    equal = old == F.col("fingerprint")
    evolved = F.format_string(EVOLVED, version, version + 1, _change_text())
    return registry.select("table_id", "schema_fingerprint", "schema_version").join(
        sides, "table_id"
    ).select(
        "table_id",
        "fingerprint",
        F.when(initial | equal, version).otherwise(version + 1).alias("schema_version"),
        (~initial & ~equal & (F.size("added") > 0)).alias("force_full"),
        F.when(initial, INITIALIZED)
        .when(equal, UNCHANGED)
        .otherwise(evolved)
        .alias("message"),
    )
