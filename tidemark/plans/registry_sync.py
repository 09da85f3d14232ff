"""Registry syncs: every enabled table of every active database, by its own method.

One query over the registry plans all tables. Tables then run at once, as
independent jobs, and the control tables are written once at the end.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidemark import schemas as s
from tidemark.functions.watermarks import stored, to_text
from tidemark.operators import evolution, wal
from tidemark.plans import control
from tidemark.plans.flows import (
    CONTROL,
    Outcome,
    apply_lines,
    control_table,
    in_parallel,
    plan_method,
    sync_cdc,
    sync_full,
    utc_now,
)
from tidemark.plans.rejects import DeadLetters, rejects_table
from tidemark.plans.store import SnapshotTable, Warehouse, remove_folder
from tidemark.sources.changelog import changelog_head, changelog_read, committed_positions
from tidemark.sources.scans import Source, TableSpec, columns_by_table, fresh_folder

RESULT = StructType(
    [
        StructField("log_id", LongType()),
        StructField("table_id", StringType()),
        StructField("method", StringType()),
        StructField("error", StringType()),
        StructField("row_count", LongType()),
        StructField("seconds", DoubleType()),
        StructField("new_watermark", TimestampNTZType()),
        StructField("schema_fingerprint", StringType()),
        StructField("schema_version", IntegerType()),
        StructField("rejected", LongType()),
        StructField("missing", LongType()),
        *s.WATERMARK.fields,
        StructField("logged_at", TimestampNTZType()),
    ]
)


@dataclass(frozen=True)
class TableRun:
    """Result of one registry run of one table."""

    table_id: str
    method: str = "full"
    message: str = ""
    error: str | None = None
    row_count: int = 0
    seconds: float = 0.0
    new_watermark: Any = None
    rejected: int = 0
    missing: int = 0
    schema_fingerprint: str | None = None
    schema_version: int | None = None
    position: int | None = None
    slot: str | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


@dataclass
class _Probe:
    """One table to sync: its registry rows, and what its source and target look like."""

    database: Row
    row: Row
    source: Source | None = None
    spec: TableSpec | None = None
    target: SnapshotTable | None = None
    columns: list[tuple[str, str]] = field(default_factory=list)
    target_columns: list[str] = field(default_factory=list)
    error: str | None = None

    @property
    def table_id(self) -> str:
        return self.row["table_id"]


@dataclass(frozen=True)
class _Pending:
    """Log lines one table has not seen, its position, and the position they reach."""

    lines: DataFrame
    position: int | None
    head: int | None


class RegistrySync:
    """Syncs the tables of the registries and logs each run.

    ``source_of`` opens the source of a database registry row; ``changelog_of``
    gives the log lines of a slot. The run log gets one append per call, and the
    registry one rewrite: tables that run at once never write the same table.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        source_of: Callable[[Row], Source],
        changelog_of: Callable[[Row, str], DataFrame] | None = None,
        clock: Callable[[], datetime] = utc_now,
        parallelism: int = 8,
        changelog_limit: int | None = None,
        policy: str = "last_change",
        rejects: str = "store",
    ) -> None:
        self.warehouse, self.spark = warehouse, warehouse.spark
        self.source_of, self.changelog_of = source_of, changelog_of
        self.clock, self.parallelism = clock, parallelism
        self.changelog_limit, self.policy = changelog_limit, policy
        self.rejects, self.rejected = rejects, rejects_table(warehouse, CONTROL)
        self.databases = self._control("database_registry", s.DATABASE_REGISTRY)
        self.tables = self._control("table_registry", s.with_watermark(s.TABLE_REGISTRY))
        self.log = self._control("sync_log", s.with_watermark(s.RUN_LOG))
        self.commits = self._control("changelog_commits", s.CHANGELOG_COMMIT)
        self.consolidated = self._control(
            "consolidated", StructType([StructField("log_id", LongType())])
        )

    def _control(self, name: str, schema: StructType) -> SnapshotTable:
        return control_table(self.warehouse, name, schema)

    # --- registration ---

    def register_databases(self, entries: DataFrame) -> None:
        self.databases.overwrite(
            control.register_databases(self.databases.read(), entries, self.clock())
        )

    def register_tables(self, entries: DataFrame) -> None:
        self.tables.overwrite(
            control.register_tables(self.tables.read(), entries, self.clock())
        )

    def setup(self, documents: DataFrame) -> DataFrame:
        """Register all databases and tables of configuration documents; what was skipped."""
        databases, tables = control.expand_config(documents)
        self.register_databases(databases)
        self.register_tables(tables)
        return control.skipped_entries(documents)

    # --- runs ---

    def sync_tables(self, database_id: str | None = None, table_id: str | None = None) -> list[TableRun]:
        """Sync the chosen enabled tables of active databases; one failure stops no other."""
        chosen = self.tables.read().filter("sync_enabled")
        if database_id is not None:
            chosen = chosen.filter(F.col("database_id") == database_id)
        if table_id is not None:
            chosen = chosen.filter(F.col("table_id") == table_id)
        rows = chosen.orderBy("table_id").collect()  # plan rows: one per registered table
        active = {r["database_id"]: r for r in self.databases.read().filter("is_active").collect()}
        jobs = [(active[r["database_id"]], r) for r in rows if r["database_id"] in active]
        probes = self._probes(jobs)
        plans = self._plan(probes)
        logs, folders = self._pending(probes, plans)
        runs = in_parallel(
            self.spark,
            probes,
            lambda p: self._run_one(p, plans.get(p.table_id), logs.get(p.table_id)),
            self.parallelism,
        )
        for folder in folders:
            remove_folder(self.spark, folder)
        self._log_runs(runs)
        return runs

    def sync_single(self, database_id: str, table_id: str) -> str:
        """Sync one table; the message of its run."""
        known = self.databases.read().filter(
            (F.col("database_id") == database_id) & F.col("is_active")
        )
        if known.isEmpty():
            return f"{database_id}: no active database is registered under this id"
        runs = self.sync_tables(database_id, table_id)
        return runs[0].message if runs else f"{table_id}: no enabled table is registered under this id"

    def sync_all(self) -> list[TableRun]:
        runs = self.sync_tables()
        self.consolidate()
        return runs

    def consolidate(self) -> int:
        """Merge new log rows into the registry; the log itself is kept."""
        done = self.consolidated.read().agg(F.max("log_id")).first()[0]
        log = self.log.read()
        top = log.agg(F.max("log_id")).first()[0]
        if top is None or top == done:
            return 0
        fresh = log if done is None else log.filter(F.col("log_id") > done)
        updated = fresh.agg(F.count_distinct("table_id")).first()[0]
        self.tables.overwrite(
            control.consolidate_log(self.tables.read(), log, self.clock(), done)
        )
        self.consolidated.append(self.spark.createDataFrame([(top,)], "log_id bigint"))
        return updated

    def _probes(self, jobs: Sequence[tuple[Row, Row]]) -> list[_Probe]:
        """What planning needs to know of the tables; a database's catalog is read once."""
        databases: dict[str, list[tuple[Row, Row]]] = {}
        for database, row in jobs:
            databases.setdefault(database["database_id"], []).append((database, row))
        found = in_parallel(self.spark, list(databases.values()), self._probe, self.parallelism)
        by_table = {p.table_id: p for probes in found for p in probes}
        return [by_table[row["table_id"]] for _, row in jobs]

    def _probe(self, jobs: Sequence[tuple[Row, Row]]) -> list[_Probe]:
        """The tables of one database."""
        probes = [_Probe(database, row) for database, row in jobs]
        try:
            source = self.source_of(jobs[0][0])
            for p in probes:
                p.source = source
                p.spec = TableSpec.of(
                    p.row["source_table"], p.row["primary_key_column"], cdc_column=p.row["cdc_column"]
                )
            columns = columns_by_table(source, [p.spec for p in probes])
        except Exception as error:  # reported as the run of each of its tables, the others go on
            for p in probes:
                p.error = str(error)
            return probes
        for p in probes:
            known = columns[p.spec.name]
            if isinstance(known, Exception):
                p.error = str(known)
                continue
            try:
                p.columns = known
                p.target = self.warehouse.table(p.row["target_schema"], p.row["target_table"])
                p.target_columns = p.target.columns()
            except Exception as error:  # reported as this table's run, the other tables go on
                p.error = str(error)
        return probes

    def _plan(self, probes: Sequence[_Probe]) -> dict[str, Row]:
        """Method and schema decision of every table, as one query over the registry."""
        reached = [p for p in probes if p.error is None]
        if not reached:
            return {}
        catalog = "table_id string, ordinal int, column_name string, data_type string"
        source = [
            (p.table_id, i, name, kind) for p in reached for i, (name, kind) in enumerate(p.columns)
        ]
        target = [
            (p.table_id, i, name, None) for p in reached for i, name in enumerate(p.target_columns)
        ]
        known = [(p.table_id, bool(p.target_columns)) for p in reached]
        registry = self.tables.read().join(
            self.spark.createDataFrame(known, "table_id string, target_exists boolean"), "table_id"
        )
        decision = evolution.schema_decision(
            registry,
            self.spark.createDataFrame(source, catalog),
            self.spark.createDataFrame(target, catalog),
        ).withColumnRenamed("force_full", "schema_changed")
        planned = plan_method(registry.join(decision.select("table_id", "schema_changed"), "table_id"))
        return {r["table_id"]: r for r in planned.join(decision, "table_id").collect()}

    def _pending(
        self, probes: Sequence[_Probe], plans: dict[str, Row]
    ) -> tuple[dict[str, _Pending], list[str]]:
        """Pending log lines of every table that follows a log.

        Tables that share a slot would each read all of its lines. So the range that
        any of them lacks is read once and written apart by table; a table then
        reads its own lines above its own position.
        """
        slots: dict[tuple[str, str], list[_Probe]] = {}
        for probe in probes:
            plan = plans.get(probe.table_id)
            if plan and plan["method"] == "wal" and self.changelog_of:
                key = (probe.row["database_id"], self._slot(probe.row))
                slots.setdefault(key, []).append(probe)
        # One row per registered table.
        committed = {
            (r["slot"], r["table_id"]): r["lsn"]
            for r in (committed_positions(self.commits.read()).collect() if slots else [])
        }
        pending, folders = {}, []
        for (_, slot), members in slots.items():
            positions = [committed.get((slot, p.table_id)) for p in members]
            start = None if None in positions else min(positions)
            try:
                lines = self.changelog_of(members[0].database, slot)
                # A limit counts from each position, so that no table stalls another.
                heads = {
                    p: changelog_head(changelog_read(lines, p, limit=self.changelog_limit))
                    for p in (set(positions) if self.changelog_limit else {start})
                }
                head = max((h for h in heads.values() if h is not None), default=None)
                batch = changelog_read(lines, start, head)
                names = {p.table_id: wal.relation(*self._relation(p)) for p in members}
                if head is not None and len(members) > 1:
                    folder = fresh_folder(self.spark, "slot")
                    folders.append(folder)
                    wal.by_relation(batch, sorted(set(names.values()))).write.partitionBy(
                        "relation"
                    ).parquet(folder)
                    split = "lsn bigint, data string, relation string"
                    batch = self.spark.read.schema(split).parquet(folder)
            except Exception as error:  # reported for each table of the slot
                for p in members:
                    p.error = str(error)
                continue
            for p, position in zip(members, positions):
                own = batch
                if "relation" in batch.columns:
                    own = batch.filter(F.col("relation") == names[p.table_id])
                end = heads.get(position, head) if self.changelog_limit else head
                pending[p.table_id] = _Pending(changelog_read(own, position, end), position, end)
        return pending, folders

    @staticmethod
    def _relation(probe: _Probe) -> tuple[str, str]:
        return probe.row["source_schema"] or s.DEFAULT_SOURCE_SCHEMA, probe.row["source_table"]

    def _run_one(self, probe: _Probe, plan: Row | None, log: _Pending | None) -> TableRun:
        row, started = probe.row, time.monotonic()
        declared = (row["sync_method"] or s.DEFAULT_METHOD).lower()
        run = TableRun(probe.table_id, declared)
        error = probe.error
        if error is None:
            try:
                done = self._load(probe, plan, log)
                seconds = time.monotonic() - started
                rate = int(done.row_count / seconds) if seconds > 0 and done.row_count > 0 else 0
                text = f"{probe.table_id} {done.mode}: {done.row_count} rows, {rate} per second"
                if done.left_out:
                    text = f"{text}; {done.left_out}"
                note = plan["message"]
                return replace(
                    run,
                    method=plan["method"],
                    message=text if note == evolution.UNCHANGED else f"{text}. {note}",
                    row_count=done.row_count,
                    seconds=seconds,
                    new_watermark=done.watermark,
                    rejected=done.rejected,
                    missing=done.missing,
                    schema_fingerprint=plan["fingerprint"],
                    schema_version=plan["schema_version"],
                    position=done.position,
                    slot=self._slot(row),
                )
            except Exception as failure:  # reported in the log, the other tables go on
                error = str(failure)
        return replace(
            run,
            error=error,
            message=f"{probe.table_id} failed: {error}",
            seconds=time.monotonic() - started,
        )

    def _dead_letters(self, row: Row) -> DeadLetters:
        return DeadLetters(self.rejected, self._slot(row), row["table_id"], self.rejects)

    def replay_rejects(self, table_id: str, repaired: DataFrame | None = None) -> Outcome:
        """Apply rejected lines again, as ``repaired`` (lsn, data) or, after another fix, as stored.

        Later lines of the same keys may have been applied since, so the keys are made equal
        to the source. Lines that are readable now leave the rejected ones.
        """
        row = self.tables.read().filter(F.col("table_id") == table_id).first()
        known = self.databases.read()
        database = known.filter(F.col("database_id") == row["database_id"]).first() if row else None
        if database is None:
            raise LookupError(f"{table_id}: no table is registered under this id")
        (probe,), letters = self._probe([(database, row)]), self._dead_letters(row)
        if probe.error:
            raise RuntimeError(probe.error)
        schema, name = self._relation(probe)
        types = {f.name.lower(): f.dataType for f in probe.source.read(probe.spec).schema.fields}
        types = {k: types[k.lower()] for k in probe.spec.keys}
        with probe.target.staging() as stage:
            lines = letters.pending().select("lsn", "data") if repaired is None else repaired
            lines = stage(lines.select("lsn", "data"))
            done = apply_lines(lines, probe.source, probe.spec, probe.target, schema, types, settle=True)
            left = wal.rejected_lines(lines, schema, name, types)
            letters.settle(lines.join(left, "lsn", "left_anti"))
        return done

    @staticmethod
    def _slot(row: Row) -> str:
        return row["wal_slot_name"] or "default"

    def _load(self, probe: _Probe, plan: Row, log: _Pending | None) -> Outcome:
        row, source, spec, table = probe.row, probe.source, probe.spec, probe.target
        declared = (row["sync_method"] or s.DEFAULT_METHOD).lower()
        if log is not None:
            if log.head is None or (log.position is not None and log.head <= log.position):
                return Outcome(0, "WAL (no changes)", batches=0, position=log.position)
            done = apply_lines(
                log.lines,
                source,
                spec,
                table,
                self._relation(probe)[0],
                policy=self.policy,
                position=log.head,
                dead_letters=self._dead_letters(row),
            )
        elif plan["method"] == "cdc":
            mark = stored(row["watermark_text"], row["watermark_type"], row["last_watermark"])
            done = sync_cdc(source, spec, table, mark)
        else:
            # The position is taken before the reload: later lines are applied again.
            head = None
            if declared == "wal" and self.changelog_of:
                head = changelog_head(self.changelog_of(probe.database, self._slot(row)))
            done = sync_full(
                source,
                spec,
                table,
                row["batch_size"] or s.DEFAULT_BATCH_SIZE,
                with_watermark=declared == "cdc",
                mode=plan["mode"] if plan["method"] == "full" else "FULL",
            )
            done = replace(done, position=head)
        table.prune()
        return done

    def _log_runs(self, runs: Sequence[TableRun]) -> None:
        """One append for all runs, then the applied log positions."""
        if not runs:
            return
        top = self.log.read().agg(F.max("log_id")).first()[0] or 0
        now = self.clock()
        rows = []
        for i, run in enumerate(runs, top + 1):
            row = {k: v for k, v in asdict(run).items() if k in RESULT.names}
            row |= dict(zip(s.WATERMARK.names, to_text(run.new_watermark)))
            row["new_watermark"] = run.new_watermark if isinstance(run.new_watermark, datetime) else None
            rows.append(row | {"log_id": i, "logged_at": now})
        results = self.spark.createDataFrame(rows, RESULT)
        ids = results.select("log_id", "table_id")
        self.log.append(control.run_log_rows(results).join(ids, "table_id"))
        positions = [(r.slot, r.table_id, r.position) for r in runs if r.ok and r.position is not None]
        if positions:
            self.commits.append(self.spark.createDataFrame(positions, s.CHANGELOG_COMMIT))
