"""The change log as a table of lines ``(lsn, data)``, read by log position.

Each (slot, table) has a committed ``lsn`` of its own, so a table never loses
changes to another one that shares its slot. Reading consumes nothing; the
position moves with ``changelog_commit`` after the target has been switched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changelog_read(
    lines: DataFrame,
    committed_lsn: int | None = None,
    head_lsn: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Pending lines above the committed position and up to ``head_lsn``.

    The range is whole and unsorted, as net changes do not depend on row order.
    ``limit`` takes the first so many lines in log order, to look at the log.
    """
    if committed_lsn is not None:
        lines = lines.filter(F.col("lsn") > committed_lsn)
    if head_lsn is not None:
        lines = lines.filter(F.col("lsn") <= head_lsn)
    return lines if limit is None else lines.orderBy("lsn").limit(limit)


def changelog_head(lines: DataFrame) -> int | None:
    """Highest position now in the log; fixes the range of one run."""
    return lines.agg(F.max("lsn")).first()[0]


def committed_position(commits: DataFrame, slot: str, table_id: str) -> int | None:
    """Committed position of one table on one slot, from the append-only commit rows."""
    mine = commits.filter((F.col("slot") == slot) & (F.col("table_id") == table_id))
    return mine.agg(F.max("lsn")).first()[0]


def committed_positions(commits: DataFrame) -> DataFrame:
    """Committed position of every (slot, table)."""
    return commits.groupBy("slot", "table_id").agg(F.max("lsn").alias("lsn"))


def changelog_commit(applied: DataFrame, slot: str, table_id: str) -> DataFrame:
    """Commit row for applied lines; no row when nothing was applied."""
    top = applied.agg(F.max("lsn").cast("bigint").alias("lsn")).filter("lsn IS NOT NULL")
    return top.select(F.lit(slot).alias("slot"), F.lit(table_id).alias("table_id"), "lsn")
