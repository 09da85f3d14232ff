"""Configuration syncs: databases and tables from a document, with a state table.

State and events are written once per call, before and after the tables run.
"""

from __future__ import annotations

import json
import time
import warnings
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions.exprs import watermark_value
from tidemark.functions.watermarks import stored, to_text, usable
from tidemark.operators.merge import add_load_timestamp
from tidemark.plans import control
from tidemark.plans.flows import control_table, in_parallel, utc_now
from tidemark.plans.store import Warehouse, buckets_for
from tidemark.sources.scans import Source, TableSpec, scan_auto

@dataclass(frozen=True)
class SourceDatabase:
    name: str
    tables: tuple[TableSpec, ...]


@dataclass(frozen=True)
class SyncConfig:
    databases: tuple[SourceDatabase, ...]
    schema_pattern: str = "{source_db}"
    driver: str = "psycopg2"
    host: str | None = None
    port: int = s.DEFAULT_PORT
    large_table_rows: int = s.LARGE_TABLE_ROWS
    parallelism: int = 4

    @staticmethod
    def of(raw: dict[str, Any]) -> SyncConfig:
        """From a parsed configuration document."""
        origin, reading = raw["source"], raw.get("extraction", {})

        def spec(t: dict[str, Any]) -> TableSpec:
            return TableSpec.of(
                t["name"],
                t["primary_key"],
                cdc_column=t.get("cdc_column"),
                partition_column=t.get("partition_column"),
                num_partitions=t.get(
                    "num_partitions", reading.get("num_partitions", s.DEFAULT_PARTITIONS)
                ),
                fetch_size=reading.get("fetch_size", s.DEFAULT_FETCH_SIZE),
            )

        return SyncConfig(
            databases=tuple(
                SourceDatabase(d["name"], tuple(spec(t) for t in d["tables"]))
                for d in origin["databases"]
            ),
            schema_pattern=raw["target"]["schema_pattern"],
            driver=origin.get("driver", "psycopg2"),
            host=origin.get("host"),
            port=origin.get("port", s.DEFAULT_PORT),
            large_table_rows=reading.get("large_table_threshold", s.LARGE_TABLE_ROWS),
            parallelism=raw.get("orchestration", {}).get("parallelism", 4),
        )

    @staticmethod
    def load(path: str) -> SyncConfig:
        """From a YAML or JSON file."""
        with open(path) as f:
            text = f.read()
        if path.endswith(".json"):
            return SyncConfig.of(json.loads(text))
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("YAML configuration needs PyYAML; use JSON instead") from error
        return SyncConfig.of(yaml.safe_load(text))

    def target_schema(self, database: str) -> str:
        return self.schema_pattern.format(source_db=database).upper()


class ConfigSync:
    """Syncs the tables of a configuration, with a state table and an event log.

    State and events are written once per call, before and after the tables run.
    """

    def __init__(
        self,
        config: SyncConfig,
        warehouse: Warehouse,
        source_of: Callable[[str], Source],
        clock: Callable[[], datetime] = utc_now,
    ) -> None:
        self.config, self.warehouse, self.spark = config, warehouse, warehouse.spark
        self.source_of, self.clock = source_of, clock
        self.state = control_table(warehouse, "replication_state", s.with_watermark(s.STATE))
        self.events = control_table(warehouse, "sync_events", s.EVENT_LOG)

    def sync_table(self, database: str, table: str, full_refresh: bool = False) -> dict[str, Any]:
        """Sync one table; never raises for a failed sync."""
        jobs = [j for j in self._jobs(database) if j[1].name == table]
        if not jobs:
            raise LookupError(f"the configuration has no table {database}.{table}")
        return self._run(jobs, full_refresh)[0]

    def sync_database(self, database: str, full_refresh: bool = False) -> list[dict[str, Any]]:
        jobs = self._jobs(database)
        if not jobs:
            raise LookupError(f"the configuration has no database {database}")
        return self._run(jobs, full_refresh)

    def sync_all(self, full_refresh: bool = False) -> list[dict[str, Any]]:
        return self._run(self._jobs(), full_refresh)

    def status(self) -> DataFrame:
        return control.state_list(self.state.read())

    def _jobs(self, database: str | None = None) -> list[tuple[str, TableSpec]]:
        return [
            (d.name, t)
            for d in self.config.databases
            if database is None or d.name == database
            for t in d.tables
        ]

    def _run(self, jobs: list[tuple[str, TableSpec]], full_refresh: bool) -> list[dict[str, Any]]:
        if not jobs:
            return []
        names = self.spark.createDataFrame(
            [(d, t.name) for d, t in jobs], "source_db string, table_name string"
        )
        self.state.overwrite(
            control.state_mark_running(self.state.read(), names, self.clock())
        )
        marks = {
            (r["source_db"], r["table_name"]): stored(
                r["watermark_text"], r["watermark_type"], r["last_sync_value"]
            )
            for r in self.state.read().join(names, list(control.STATE_KEY)).collect()
        }
        done = in_parallel(
            self.spark,
            jobs,
            lambda job: self._sync(job[0], job[1], full_refresh, marks[job[0], job[1].name]),
            self.config.parallelism,
        )
        results, events = [d[0] for d in done], [e for d in done for e in d[1]]
        self._finish(results)
        self._log_events(events)
        return [{k: v for k, v in r.items() if k != "watermark"} for r in results]

    def _sync(
        self, database: str, spec: TableSpec, full_refresh: bool, watermark: Any
    ) -> tuple[dict[str, Any], list[dict[str, Any]]]:
        started, events = time.monotonic(), []
        schema = self.config.target_schema(database)
        table = self.warehouse.table(schema, spec.name.upper())

        def log(
            kind: str, message: str, rows: int | None = None, since: float | None = None, **details: Any
        ) -> None:
            spent = None if since is None else int((time.monotonic() - since) * 1000)
            events.append(
                {
                    "source_db": database,
                    "table_name": spec.name,
                    "event_type": kind,
                    "message": message,
                    "rows_affected": rows,
                    "duration_ms": spent,
                    "metadata": json.dumps(details, default=str) if details else None,
                    "logged_at": self.clock(),
                }
            )

        log(
            "SYNC_START",
            f"to {table.path}, full refresh: {full_refresh}",
            target=f"{schema}.{spec.name.upper()}",
            full_refresh=full_refresh,
            primary_key=list(spec.keys),
            cdc_column=spec.cdc_column,
        )
        base = {"database": database, "table": spec.name}
        try:
            source = self.source_of(database)
            if full_refresh or not spec.cdc_column or not table.exists():
                watermark = None  # a missing target gets all rows, not the newest only
            if watermark is not None:
                watermark = usable(watermark, source.read(spec).schema[spec.cdc_column].dataType)
            merging = watermark is not None
            load = "MERGE" if merging else "FULL"
            extract = time.monotonic()
            df, count = scan_auto(source, spec, watermark, self.config.large_table_rows)
            log("SOURCE_COUNT", "rows in the source", count, large=bool(count > self.config.large_table_rows))
            large = count > self.config.large_table_rows and spec.split_columns
            log("EXTRACT_START", f"{spec.parts(count)} range reads" if large else "one read")
            df = add_load_timestamp(df, self.clock())
            with table.staging() as stage:
                if merging:
                    # The batch is on disk after this, so the time is that of the extract.
                    df = stage(df)
                log("EXTRACT_COMPLETE", "batch staged" if merging else "read planned", since=extract)
                loading = time.monotonic()
                log("LOAD_START", load)
                if merging:
                    rows, newest = table.merge(df, spec.cdc_column)
                    newest = watermark if newest is None else max(newest, watermark)
                else:
                    table.overwrite(df, spec.keys, buckets_for(count))
                    target, top = table.read(), F.lit(None)
                    if spec.cdc_column:
                        top = F.max(watermark_value(spec.cdc_column, target.schema[spec.cdc_column].dataType))
                    rows, newest = target.agg(F.count("*"), top).first()
            table.prune()
            log("LOAD_COMPLETE", load, rows, loading)
            log("SYNC_COMPLETE", f"watermark {newest}", rows, started, load=load, watermark=newest)
            return base | {"status": "success", "rows": rows, "watermark": newest}, events
        except Exception as error:  # reported in the result, the state and the event log
            log("SYNC_FAILED", str(error), since=started, error=type(error).__name__)
            return base | {"status": "failed", "error": str(error)}, events

    def _finish(self, results: list[dict[str, Any]]) -> None:
        schema = (
            "source_db string, table_name string, watermark timestamp_ntz, "
            "row_count bigint, error string, watermark_text string, watermark_type string"
        )
        rows = []
        for r in results:
            mark = r.get("watermark")
            time_mark = mark if isinstance(mark, datetime) else None
            rows.append((r["database"], r["table"], time_mark, r.get("rows"), r.get("error"), *to_text(mark)))
        runs = self.spark.createDataFrame(rows, schema)
        now = self.clock()
        state = control.state_mark_completed(self.state.read(), runs.filter("error IS NULL"), now)
        state = control.state_mark_failed(state, runs.filter("error IS NOT NULL"), now)
        self.state.overwrite(state)

    def _log_events(self, events: list[dict[str, Any]]) -> None:
        """Append events; a failure to log never fails the run."""
        try:
            rows = self.spark.createDataFrame(events, s.EVENT_LOG)
            self.events.append(rows.select(*s.EVENT_LOG.names))
        except Exception as error:
            warnings.warn(f"events not logged: {error}", stacklevel=2)
