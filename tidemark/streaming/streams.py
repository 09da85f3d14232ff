"""The sync flows as streams.

Each micro-batch runs the batch operators, so a stream ends with the same target
as one batch over the same input. The checkpoint holds the log position. The target
commits each batch's number with its rows, and the position of each key's last change
is kept beside it: a batch that comes again, or after batches of later lines, changes
no key that has seen a later change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from tidemark.functions import any_null
from tidemark.plans.flows import BatchOrder, apply_lines
from tidemark.plans.rejects import DeadLetters
from tidemark.plans.store import SnapshotTable, buckets_for
from tidemark.sources.scans import Source, TableSpec

LINES = "lsn bigint, data string"


def _trigger(interval: str | None) -> dict[str, Any]:
    """Poll every ``interval``, or take what is there and stop."""
    return {"processingTime": interval} if interval else {"availableNow": True}


def stream_wal(
    lines: DataFrame,
    source: Source,
    spec: TableSpec,
    table: SnapshotTable,
    source_schema: str,
    checkpoint: str,
    key_types: Mapping[str, DataType | str] | None = None,
    policy: str = "last_change",
    interval: str | None = None,
    dead_letters: DeadLetters | None = None,
) -> StreamingQuery:
    """Apply a stream of log lines ``(lsn, data)`` to a target table.

    Batches may come in any order and more than once. Lines that cannot be applied go
    to ``dead_letters``. ``delete_wins`` works per micro-batch, as it does per run in
    batch form.
    """

    def apply(batch: DataFrame, number: int) -> None:
        order = BatchOrder(table, checkpoint, number)
        if not order.done:
            apply_lines(
                batch, source, spec, table, source_schema, key_types, policy, None, dead_letters, order=order
            )
            table.prune()

    return (
        lines.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def newest_per_key(rows: DataFrame, keys: Sequence[str], cdc_column: str) -> DataFrame:
    """The newest version of each key in a batch; rows with NULL keys all stay.

    Spark limits each key to one row before the shuffle too, so a key with many
    versions is cheap. Equal times fall back to the row hash, so a re-run picks
    the same row.
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc(cdc_column), F.xxhash64(*rows.columns))
    ranked = rows.filter(~any_null(keys)).withColumn("_rank", F.row_number().over(newest))
    picked = ranked.filter(F.col("_rank") == 1).drop("_rank")
    return picked.unionByName(rows.filter(any_null(keys)))


def stream_cdc(
    rows: DataFrame,
    keys: Sequence[str],
    cdc_column: str,
    table: SnapshotTable,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Merge a stream of changed source rows into a target table.

    A row that is older than the target's stays out, in whatever order batches come.
    """

    def merge(batch: DataFrame, _: int) -> None:
        with table.staging() as stage:
            staged = stage(newest_per_key(batch, keys, cdc_column))
            if table.exists():
                table.merge(staged, newest_by=cdc_column)
            elif count := staged.count():
                table.overwrite(staged, keys, buckets_for(count))
        table.prune()

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )
