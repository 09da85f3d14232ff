"""Log lines that could not be applied, kept until they are repaired.

A log position may move past a line only when the line has been applied or is here.
Storing goes by (slot, table, position, text), so a batch that is applied again stores
its lines once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.plans.store import SnapshotTable, Warehouse

#: What a run does with lines it cannot apply: keep them here, stop, or reload the table.
POLICIES = ("store", "fail", "reload")
KEYS = ["slot", "table_id", "lsn", "line_key"]


class RejectedLines(ValueError):
    """A log holds lines that cannot be applied, and the policy is to stop."""


@dataclass(frozen=True)
class DeadLetters:
    """The rejected lines of one table on one slot."""

    table: SnapshotTable
    slot: str
    table_id: str
    policy: str = "store"

    def __post_init__(self) -> None:
        if self.policy not in POLICIES:
            raise ValueError(f"unknown policy {self.policy!r}, expected one of {POLICIES}")

    def put(self, rejected: DataFrame) -> None:
        """Store ``(lsn, data, reason)``; under the policy ``fail``, raise instead."""
        if self.policy == "fail":
            first = rejected.orderBy("lsn").first()
            raise RejectedLines(f"{self.table_id}: line at {first['lsn']}: {first['reason']}")
        rows = rejected.select(
            F.lit(self.slot).alias("slot"),
            F.lit(self.table_id).alias("table_id"),
            "lsn",
            F.sha2("data", 256).alias("line_key"),
            "data",
            "reason",
        )
        self.table.merge_rows(rows.groupBy(*KEYS).agg(F.first("data").alias("data"), F.min("reason").alias("reason")))

    def pending(self) -> DataFrame:
        mine = (F.col("slot") == self.slot) & (F.col("table_id") == self.table_id)
        return self.table.read().filter(mine)

    def settle(self, lines: DataFrame) -> None:
        """Remove the lines of these positions."""
        settled = self.pending().join(lines.select("lsn").distinct(), "lsn", "left_semi")
        self.table.delete_keys(settled.select(*KEYS))


def rejects_table(warehouse: Warehouse, schema: str) -> SnapshotTable:
    table = warehouse.table(schema, "rejected_lines")
    if not table.exists():
        table.create(s.REJECTED_LINES, KEYS)
    return table
