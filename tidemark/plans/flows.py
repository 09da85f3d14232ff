"""Sync flows of one table: full reload, merge by watermark, apply of a change log.

Each flow is a handful of Spark jobs. The driver handles counts, watermarks and
log positions only. An extracted batch is written to the shared folder once;
count, watermark, key check and merge all read that copy, which goes afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tidemark import schemas as s
from tidemark.functions import any_null, typed_literal
from tidemark.functions.exprs import watermark_value
from tidemark.functions.watermarks import usable
from tidemark.operators import wal
from tidemark.plans.rejects import DeadLetters
from tidemark.plans.store import SnapshotTable, Warehouse, buckets_for
from tidemark.sources.changelog import changelog_read
from tidemark.sources.scans import Source, TableSpec, newer_than, scan_auto

CONTROL = "_control"


@dataclass(frozen=True)
class Outcome:
    """What one load did."""

    row_count: int
    mode: str
    watermark: Any = None
    batches: int = 1
    upserts: int = 0
    deletes: int = 0
    rejected: int = 0
    position: int | None = None
    missing: int = 0

    @property
    def left_out(self) -> str:
        """What of the log could not be applied as it says; empty if nothing."""
        parts = []
        if self.rejected:
            parts.append(f"{self.rejected} unreadable lines skipped")
        if self.missing:
            parts.append(f"{self.missing} changed keys not in the source")
        return ", ".join(parts)


# --- method choice --------------------------------------------------------------------


def plan_method(tables: DataFrame) -> DataFrame:
    """Method each table runs by, from its registry row and what is known of its target.

    ``tables`` holds ``table_id, sync_method, primary_key_column, cdc_column,
    schema_changed, target_exists``.
    """
    declared = F.lower(F.coalesce("sync_method", F.lit(s.DEFAULT_METHOD)))
    keyed = F.coalesce(F.col("primary_key_column") != "", F.lit(False))
    dated = F.coalesce(F.col("cdc_column") != "", F.lit(False))
    forced = F.col("schema_changed") | ~F.col("target_exists")
    method = (
        F.when((declared == "wal") & keyed & ~forced, "wal")
        .when((declared == "cdc") & keyed & dated & ~forced, "cdc")
        .otherwise("full")
    )
    mode = (
        F.when(method != "full", F.upper(method))
        .when((declared == "cdc") & F.col("schema_changed"), "FULL (schema change)")
        .when((declared == "cdc") & forced, "FULL (initial)")
        .otherwise("FULL")
    )
    return tables.select("table_id", method.alias("method"), mode.alias("mode"))


# --- one table ------------------------------------------------------------------------


def sync_full(
    source: Source,
    spec: TableSpec,
    table: SnapshotTable,
    batch_size: int = s.DEFAULT_BATCH_SIZE,
    with_watermark: bool = False,
    mode: str = "FULL",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Outcome:
    """Reload a table, in parts when the source is large.

    Parts that the source answers one by one see it at different times; what changed
    meanwhile is repaired before this returns (``repair``). Partitions and the fetch
    size bound memory; ``batches`` reports how many pages of ``batch_size`` the load
    amounts to.
    """
    threshold, newest = min(batch_size, s.LARGE_TABLE_ROWS), None
    apart = bool(spec.split_columns) and not source.one_snapshot
    if apart and spec.cdc_column:
        newest = source.probe(replace(spec, partition_column=spec.cdc_column))[2]
    df, expected = scan_auto(source, spec, threshold=threshold)
    table.overwrite(prepare(df), spec.keys, buckets_for(expected))
    if apart and expected > threshold and spec.keys:
        repair(source, spec, table, newest, prepare)
    target = table.read()
    top = F.lit(None)
    if with_watermark and spec.cdc_column:
        top = F.max(watermark_value(spec.cdc_column, target.schema[spec.cdc_column].dataType))
    row = target.agg(F.count("*").alias("rows"), top.alias("watermark")).first()
    paged = bool(spec.keys) and row["rows"] > batch_size
    batches = -(-row["rows"] // batch_size) if paged else 1
    return Outcome(row["rows"], mode, row["watermark"], batches)


def repair(
    source: Source,
    spec: TableSpec,
    table: SnapshotTable,
    newest: Any = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Make a target that was loaded in parts what one read would have given.

    ``newest`` is the source's highest watermark from before the load: rows from it on
    are merged. If source and target then hold different numbers of rows, their keys are
    compared: keys the source has lost are deleted, keys the load has missed are fetched.
    Without a watermark column, changes of rows within the load's time stay unseen until
    the next one.
    """
    rows = source.read(spec)
    if newest is not None:
        table.merge_rows(prepare(rows.filter(F.col(spec.cdc_column) >= typed_literal(newest, rows.schema[spec.cdc_column].dataType))))
    if source.probe(spec)[0] == table.count():
        return
    keys = list(spec.keys)
    with table.staging() as stage:
        there = stage(rows.select(*keys).filter(~any_null(keys)))
        held = table.read().select(*keys).filter(~any_null(keys))
        table.delete_keys(held.join(there, keys, "left_anti"))
        missed = stage(there.join(table.read().select(*keys), keys, "left_anti"))
        if not missed.isEmpty():
            table.merge_rows(prepare(source.read_keys(spec, missed)))


def sync_cdc(
    source: Source,
    spec: TableSpec,
    table: SnapshotTable,
    watermark: Any = None,
    lookback: str = "",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Outcome:
    """Merge the rows above the watermark. The new watermark is the batch's own maximum.

    The watermark may be a time, date, number, text or bytes; one that the column's
    type cannot be compared with is passed over, and all rows are read.
    """
    rows = source.read(spec)
    watermark = usable(watermark, rows.schema[spec.cdc_column].dataType)
    with table.staging() as stage:
        staged = stage(prepare(newer_than(rows, spec.cdc_column, watermark, lookback)))
        if table.exists():
            mode = "CDC (merge)"
            rows, top = table.merge(staged, spec.cdc_column)
        else:
            mode = "CDC (initial)"
            newest = F.max(watermark_value(spec.cdc_column, staged.schema[spec.cdc_column].dataType))
            rows, top = staged.agg(F.count("*"), newest).first()
            if rows:
                table.overwrite(staged, spec.keys, buckets_for(rows))
    if not rows:
        return Outcome(0, "CDC (no changes)", watermark, 0)
    newest = top if watermark is None else max(top or watermark, watermark)
    return Outcome(rows, mode, newest)


def sync_wal(
    lines: DataFrame,
    source: Source,
    spec: TableSpec,
    table: SnapshotTable,
    source_schema: str,
    key_types: Mapping[str, DataType | str] | None = None,
    committed_lsn: int | None = None,
    limit: int | None = None,
    policy: str = "last_change",
    dead_letters: DeadLetters | None = None,
) -> Outcome:
    """Apply pending log lines of one table; ``position`` is what may be committed after.

    All that is pending is applied. A ``limit`` of lines fixes how far one run reads
    into the log; these are then read as a plain range.
    """
    pending = changelog_read(lines, committed_lsn, limit=limit)
    head = pending.agg(F.max("lsn")).first()[0]
    if head is None:
        return Outcome(0, "WAL (no changes)", batches=0, position=committed_lsn)
    batch = changelog_read(lines, committed_lsn, head)
    return apply_lines(
        batch, source, spec, table, source_schema, key_types, policy, head, dead_letters
    )


def apply_lines(
    lines: DataFrame,
    source: Source,
    spec: TableSpec,
    table: SnapshotTable,
    source_schema: str,
    key_types: Mapping[str, DataType | str] | None = None,
    policy: str = "last_change",
    position: int | None = None,
    dead_letters: DeadLetters | None = None,
    settle: bool = False,
    order: BatchOrder | None = None,
) -> Outcome:
    """Apply one batch of log lines. Applying it again changes nothing.

    Lines that cannot be applied go to ``dead_letters`` before the target changes;
    without it they are only counted. ``settle`` makes every key of the batch equal
    the source, for lines that are older than others applied before. ``order`` lets
    batches come in any order and more than once.
    """
    keys = list(spec.keys)
    if key_types is None:
        read = {f.name.lower(): f.dataType for f in source.read(spec).schema.fields}
        key_types = {k: read[k.lower()] for k in keys}
    changes = wal.parse_changes(lines, source_schema, spec.name, key_types, others=True)
    with table.staging() as stage:
        staged = stage(wal.net_changes(changes, keys, policy, with_rejects=True))
        rejected, others = wal.reject_counts(staged, keys)
        net = staged.filter(~any_null(keys)).drop("lines", "others")
        if settle:
            net = net.withColumn("op", F.lit(wal.UPDATE))
        if order:
            net = stage(order.newer(net, keys)) if order.behind(net) else net
        if dead_letters and (rejected or others):
            found = wal.rejected_lines(lines, source_schema, spec.name, key_types)
            if dead_letters.policy == "reload":
                done = sync_full(source, spec, table)
                return replace(done, mode="FULL (unreadable lines)", rejected=rejected, position=position)
            dead_letters.put(found)
        fetched = stage(source.read_keys(spec, net.filter(F.col("op") != wal.DELETE)))
        upserts, deletes, missing = _counts(net, fetched, keys)
        applied = order.applied() if order else None
        if table.exists():
            table.apply(fetched, net, policy, applied)
        else:
            deletes = 0
            if upserts:
                table.overwrite(fetched, keys, buckets_for(upserts), applied)
        if order:
            order.remember(net, keys)
    mode = f"WAL ({upserts} upserts, {deletes} deletes)" if upserts + deletes else "WAL (no changes)"
    return Outcome(upserts + deletes, mode, None, 1, upserts, deletes, rejected, position, missing)


class BatchOrder:
    """What a target has seen of a log, so that batches may come twice or in another order.

    The newest applied position and each stream's last batch are committed with the
    target's rows. The position of each key's last change is kept in a table beside
    the target, one narrow row per key that ever changed; it is asked only for batches
    that reach below the applied position. It is written after the target: if a run
    dies in between, the batch is applied again, which changes nothing.
    """

    def __init__(self, table: SnapshotTable, stream: str, batch: int) -> None:
        self.table, self.stream, self.batch = table, stream, batch
        version = table.current()
        self.before = dict(version.applied) if version else {}
        self.head = self.before.get("lsn")
        self.positions = SnapshotTable(table.spark, f"{table.path}/positions")

    @property
    def done(self) -> bool:
        """Whether the stream's batch, and its positions, have been committed."""
        known = self.positions.current()
        return known is not None and known.applied.get(self.stream, -1) >= self.batch

    def behind(self, net: DataFrame) -> bool:
        """Whether some change is not above all that has been applied."""
        low, high = net.agg(F.min("lsn"), F.max("lsn")).first()
        late = self.head is not None and low is not None and low <= self.head
        if high is not None:
            self.head = high if self.head is None else max(high, self.head)
        return late

    def newer(self, net: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Changes above their key's last one; at the same position an upsert decides."""
        if not self.positions.exists():
            return net
        last = self.positions.read().select(*keys, F.col("lsn").alias("_last"))
        same = (F.col("lsn") == F.col("_last")) & (F.col("op") != wal.DELETE)
        above = F.col("_last").isNull() | (F.col("lsn") > F.col("_last")) | same
        return net.join(last, list(keys), "left").filter(above).drop("_last")

    def applied(self) -> dict[str, int]:
        marks = self.before | {self.stream: self.batch}
        return marks if self.head is None else marks | {"lsn": self.head}

    def remember(self, net: DataFrame, keys: Sequence[str]) -> None:
        rows = net.select(*keys, "lsn")
        marks = {self.stream: self.batch}
        if not self.positions.exists():
            self.positions.overwrite(rows, list(keys), buckets_for(rows.count()), marks)
        else:
            self.positions.merge(rows, applied=marks)
        self.positions.prune()


def _counts(net: DataFrame, fetched: DataFrame, keys: Sequence[str]) -> tuple[int, int, int]:
    """Fetched rows, deleted keys, and upserted keys that the source no longer has."""
    held = fetched.groupBy(*keys).agg(F.count("*").alias("copies"))
    deleted = F.col("op") == wal.DELETE
    row = (
        net.join(held, list(keys), "left")
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("upserts"),
            F.count_if(deleted).alias("deletes"),
            F.count_if(~deleted & F.col("copies").isNull()).alias("missing"),
        )
        .first()
    )
    return row["upserts"], row["deletes"], row["missing"]


# --- control tables -------------------------------------------------------------------


def control_table(warehouse: Warehouse, name: str, schema: StructType) -> SnapshotTable:
    """A control table; one from before a column was added gets it, with NULLs."""
    table = warehouse.table(CONTROL, name)
    if not table.exists():
        table.create(schema)
    elif missing := [f for f in schema.fields if f.name not in table.columns()]:
        table.overwrite(table.read().withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}))
    return table


# --- many tables ----------------------------------------------------------------------


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def in_parallel(
    spark: SparkSession, jobs: Sequence[Any], work: Callable[[Any], Any], parallelism: int
) -> list[Any]:
    """Run independent table jobs at once, each in a scheduler pool of its own.

    Under ``spark.scheduler.mode=FAIR`` a small table is not held up by a large one.
    """

    def pooled(job: Any) -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"table-{id(job)}")
        return work(job)

    if len(jobs) <= 1 or parallelism <= 1:
        return [work(job) for job in jobs]
    with ThreadPoolExecutor(min(parallelism, len(jobs))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(pooled), job) for job in jobs]
        return [f.result() for f in futures]
