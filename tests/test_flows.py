"""Whole syncs over several runs."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import config_sync, flows, registry_sync, rejects
from tidemark.plans.store import SnapshotTable, Warehouse
from tidemark.sources import changelog
from tidemark.sources.scans import FrameSource, TableSpec, fresh_folder

DAY = datetime(2024, 1, 1)
ROWS = "id bigint, v string, at timestamp_ntz"
SPEC = TableSpec.of("t", "id", cdc_column="at")


def day(n):
    return DAY + timedelta(days=n)


@pytest.fixture
def table(spark):
    return SnapshotTable(spark, fresh_folder(spark, "table"))


def source(spark, *rows, **more):
    return FrameSource({"t": spark.createDataFrame(list(rows), ROWS), **more})


# --- one table ------------------------------------------------------------------------


def test_cdc_runs(spark, table, values):
    first = flows.sync_cdc(source(spark, (1, "a", day(1)), (2, "b", day(2))), SPEC, table)
    assert (first.mode, first.row_count, first.watermark) == ("CDC (initial)", 2, day(2))
    # A row at the watermark is not read again; the late row 3 is missed without lookback.
    later = source(spark, (1, "A", day(3)), (2, "B", day(2)), (3, "c", day(1)))
    second = flows.sync_cdc(later, SPEC, table, first.watermark)
    assert (second.mode, second.row_count, second.watermark) == ("CDC (merge)", 1, day(3))
    assert values(table.read(), "id", "v") == [(1, "A"), (2, "b")]
    third = flows.sync_cdc(later, SPEC, table, second.watermark)
    assert (third.mode, third.row_count, third.watermark) == ("CDC (no changes)", 0, day(3))
    back = flows.sync_cdc(later, SPEC, table, third.watermark, lookback="5 days")
    assert back.watermark == day(3)
    assert values(table.read(), "id", "v") == [(1, "A"), (2, "B"), (3, "c")]


def test_cdc_on_an_empty_source_keeps_null(spark, table):
    done = flows.sync_cdc(source(spark), SPEC, table)
    assert (done.row_count, done.watermark) == (0, None) and not table.exists()


def test_full_reports_batches(spark, table):
    rows = [(i, "a", day(i % 3)) for i in range(25)]
    done = flows.sync_full(source(spark, *rows), SPEC, table, batch_size=10, with_watermark=True)
    assert (done.row_count, done.batches, done.watermark) == (25, 3, day(2))
    done = flows.sync_full(source(spark, *rows[:5]), SPEC, table, batch_size=10)
    assert (done.row_count, done.batches, done.watermark, table.count()) == (5, 1, None, 5)


def lines(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "lsn bigint, data string")


def test_wal_limit_moves_in_steps(spark, table, values):
    table.overwrite(spark.createDataFrame([(1, "old", day(0)), (2, "old", day(0))], ROWS), "id")
    now = source(spark, (1, "new", day(1)), (3, "new", day(1)))
    log = lines(
        spark,
        "BEGIN 1",
        "table public.t: UPDATE: id[bigint]:1",
        "table public.t: DELETE: id[bigint]:2",
        "table public.u: DELETE: id[bigint]:1",
        "table public.t: INSERT: id[bigint]:3",
    )
    one = flows.sync_wal(log, now, SPEC, table, "public", limit=2)
    assert (one.position, one.upserts, one.deletes) == (1, 1, 0)
    two = flows.sync_wal(log, now, SPEC, table, "public", committed_lsn=one.position, limit=2)
    assert (two.position, two.upserts, two.deletes) == (3, 0, 1)
    three = flows.sync_wal(log, now, SPEC, table, "public", committed_lsn=two.position)
    assert (three.position, three.mode) == (4, "WAL (1 upserts, 0 deletes)")
    assert values(table.read(), "id", "v") == [(1, "new"), (3, "new")]
    none = flows.sync_wal(log, now, SPEC, table, "public", committed_lsn=three.position)
    assert (none.row_count, none.mode, none.position) == (0, "WAL (no changes)", 4)


def test_wal_replay_changes_nothing(spark, table, values):
    table.overwrite(spark.createDataFrame([(i, "old", day(0)) for i in range(20)], ROWS), "id")
    now = source(spark, *[(i, "new", day(1)) for i in range(0, 20, 2)])
    log = lines(spark, *[f"table public.t: {'UPDATE' if i % 2 == 0 else 'DELETE'}: id[bigint]:{i}" for i in range(20)])
    flows.sync_wal(log, now, SPEC, table, "public")
    once = values(table.read())
    flows.sync_wal(log, now, SPEC, table, "public")
    assert values(table.read()) == once and len(once) == 10


def test_wal_over_a_text_key_and_a_driver(spark, table, values):
    """Key types come from what the source is read as, not from its own type names."""
    from tidemark.sources.dbapi import DbApiSource

    rows = "(SELECT 'a' AS code, 1 AS n UNION ALL SELECT 'b', 2) AS t"
    driver = DbApiSource(spark, "duckdb:connect", tables={"t": rows}, types={"t": "code string, n int"})
    spec = TableSpec.of("t", "code")
    table.overwrite(spark.createDataFrame([("a", 0), ("it's", 0)], "code string, n int"), "code")
    log = lines(
        spark,
        "table public.t: UPDATE: code[character varying]:'a' n[integer]:1",
        "table public.t: DELETE: code[character varying]:'it''s'",
        "table public.t: INSERT: code[character varying]:'b' n[integer]:2",
    )
    done = flows.sync_wal(log, driver, spec, table, "public")
    assert (done.upserts, done.deletes) == (2, 1)
    assert values(table.read()) == [("a", 1), ("b", 2)]


def test_wal_counts_rejected_lines(spark, table):
    table.overwrite(spark.createDataFrame([(1, "old", day(0))], ROWS), "id")
    log = lines(spark, "table public.t: DELETE: (no-tuple-data)", "table public.t: DELETE: id[bigint]:1")
    done = flows.sync_wal(log, source(spark), SPEC, table, "public")
    assert (done.rejected, done.deletes, table.count()) == (1, 1, 0)


def test_commit_positions_are_per_table(spark):
    commits = spark.createDataFrame(
        [("s", "a", 5), ("s", "a", 9), ("s", "b", 3)], "slot string, table_id string, lsn bigint"
    )
    assert changelog.committed_position(commits, "s", "a") == 9
    assert changelog.committed_position(commits, "s", "b") == 3
    assert changelog.committed_position(commits, "s", "c") is None
    empty = lines(spark).select("lsn")
    assert changelog.changelog_commit(empty, "s", "a").isEmpty()


# --- registry -------------------------------------------------------------------------


class World:
    """A changing source with its log."""

    def __init__(self, spark):
        self.spark, self.frames, self.log = spark, {}, []

    def put(self, name, rows, schema=ROWS):
        self.frames[name] = self.spark.createDataFrame(rows, schema)

    def lines(self, database, slot):
        return self.spark.createDataFrame(list(enumerate(self.log)), "lsn bigint, data string")


@pytest.fixture
def world(spark):
    w = World(spark)
    w.put("c", [(1, "a", day(1))])
    w.put("w", [(1, "a", day(1))])
    w.put("x", [(1, "a", day(1))])
    return w


@pytest.fixture
def sync(spark, world):
    sync = registry_sync.RegistrySync(
        Warehouse(spark, fresh_folder(spark, "warehouse")),
        lambda database: FrameSource(world.frames),
        world.lines,
        parallelism=4,
    )
    document = {
        "databases": [{"database_id": "d", "host": "h", "wal_slot": "s", "target_schema": "RAW"}],
        "defaults": {"primary_key": "id", "cdc_column": "at"},
        "tables": [
            {"name": "c", "sync_method": "cdc"},
            {"name": "w", "sync_method": "wal"},
            {"name": "x", "sync_method": "wal"},
        ],
    }
    from tidemark.plans import control

    texts = spark.createDataFrame([(json.dumps(document),)], "document string")
    sync.setup(control.config_documents(texts))
    return sync


def by_id(df):
    return {r["table_id"]: r for r in df.collect()}


def test_registry_runs(spark, world, sync, values):
    runs = {r.table_id: r for r in sync.sync_all()}
    assert "FULL (initial):" in runs["d_c"].message and "initialized" in runs["d_c"].message
    assert " FULL:" in runs["d_w"].message
    tables = by_id(sync.tables.read())
    assert tables["d_c"]["last_watermark"] == day(1) and tables["d_w"]["last_watermark"] is None
    assert len(tables["d_c"]["schema_fingerprint"]) == 16

    # Two tables share a slot; each follows its own position.
    world.put("c", [(1, "a", day(1)), (2, "b", day(2))])
    world.put("w", [(2, "b", day(2))])
    world.put("x", [(1, "z", day(2))])
    world.log = [
        "table public.w: INSERT: id[bigint]:2",
        "table public.x: UPDATE: id[bigint]:1",
        "table public.w: DELETE: id[bigint]:1",
    ]
    assert "WAL (1 upserts, 0 deletes)" in sync.sync_single("d", "d_x")
    runs = {r.table_id: r for r in sync.sync_all()}
    assert "CDC (merge):" in runs["d_c"].message
    assert "WAL (1 upserts, 1 deletes):" in runs["d_w"].message
    assert "WAL (no changes):" in runs["d_x"].message
    read = lambda name: values(sync.warehouse.table("RAW", name).read(), "id", "v")
    assert read("C") == [(1, "a"), (2, "b")] and read("W") == [(2, "b")] and read("X") == [(1, "z")]
    log = sync.log.read()
    assert log.count() == 7 and log.select("log_id").distinct().count() == 7
    assert by_id(sync.tables.read())["d_c"]["last_cdc_rows"] == 1


def test_registry_failure_and_recovery(spark, world, sync):
    sync.sync_all()
    kept = world.frames.pop("c")
    runs = {r.table_id: r for r in sync.sync_all()}
    assert not runs["d_c"].ok and runs["d_w"].ok and runs["d_x"].ok
    row = by_id(sync.tables.read())["d_c"]
    assert row["last_sync_status"].startswith("error: ") and row["last_watermark"] == day(1)
    world.frames["c"] = kept
    assert all(r.ok for r in sync.sync_all())
    assert by_id(sync.tables.read())["d_c"]["last_sync_status"] == "success"


def test_registry_schema_change(spark, world, sync, values):
    sync.sync_all()
    world.put("c", [(1, "a", day(1), 7), (5, "late", day(0), 8)], ROWS + ", n int")
    runs = {r.table_id: r for r in sync.sync_all()}
    assert "FULL (schema change):" in runs["d_c"].message
    assert runs["d_c"].message.endswith("Schema evolved v1->v2: +[N]")
    assert values(sync.warehouse.table("RAW", "C").read(), "id", "n") == [(1, 7), (5, 8)]
    assert by_id(sync.tables.read())["d_c"]["schema_version"] == 2
    # A dropped column forces nothing: the target keeps it.
    world.put("c", [(1, "A", day(4))])
    runs = {r.table_id: r for r in sync.sync_all()}
    assert "CDC (merge):" in runs["d_c"].message and "-[N]" in runs["d_c"].message
    assert values(sync.warehouse.table("RAW", "C").read(), "id", "v", "n") == [(1, "A", 7), (5, "late", 8)]


def test_registry_scope(spark, world, sync):
    assert sync.sync_single("nope", "d_c").startswith("nope: no active database")
    assert sync.sync_single("d", "nope").startswith("nope: no enabled table")
    sync.tables.overwrite(
        sync.tables.read().withColumn("sync_enabled", F.col("table_id") != "d_c")
    )
    assert {r.table_id for r in sync.sync_tables("d")} == {"d_w", "d_x"}
    assert sync.consolidate() == 2
    assert sync.consolidate() == 0


# --- configuration path ---------------------------------------------------------------

CONFIG = {
    "source": {
        "host": "h",
        "port": 5432,
        "databases": [
            {"name": "one", "tables": [{"name": "t", "primary_key": ["id"], "cdc_column": "at"}]},
            {"name": "two", "tables": [{"name": "t", "primary_key": ["id"], "num_partitions": 9}]},
        ],
    },
    "target": {"schema_pattern": "{source_db}_raw"},
}


def test_config_defaults(tmp_path):
    config = config_sync.SyncConfig.of(CONFIG)
    assert config.driver == "psycopg2" and config.large_table_rows == 50_000
    assert config.databases[0].tables[0].num_partitions == 4
    assert config.databases[1].tables[0].num_partitions == 9
    assert config.databases[1].tables[0].cdc_column is None
    assert config.target_schema("one") == "ONE_RAW"
    path = tmp_path / "config.json"
    path.write_text(json.dumps(CONFIG))
    assert config_sync.SyncConfig.load(str(path)) == config


def test_config_runs(spark, values):
    frames = {"now": source(spark, (1, "a", day(1)), (2, "b", day(2)))}
    sync = config_sync.ConfigSync(
        config_sync.SyncConfig.of(CONFIG),
        Warehouse(spark, fresh_folder(spark, "warehouse")),
        lambda name: frames["now"],
        clock=lambda: day(30),
    )
    assert [(r["status"], r["rows"]) for r in sync.sync_all()] == [("success", 2), ("success", 2)]
    frames["now"] = source(spark, (2, "B", day(3)), (3, "c", day(1)))
    one, two = sync.sync_all()
    assert (one["rows"], two["rows"]) == (1, 2)  # merged above the watermark; reloaded
    target = sync.warehouse.table("ONE_RAW", "T").read()
    assert values(target, "id", "v") == [(1, "a"), (2, "B")]
    assert [r[0] for r in target.select("_LOADED_AT").distinct().collect()] == [day(30)]
    status = {r["source_db"]: r for r in sync.status().collect()}
    assert status["one"]["last_sync_value"] == day(3) and status["two"]["last_sync_value"] is None

    frames["now"] = FrameSource({})
    failed = sync.sync_table("one", "t")
    assert failed["status"] == "failed" and "not found" in failed["error"]
    row = sync.status().filter("source_db = 'one'").first()
    assert (row["sync_status"], row["last_sync_value"]) == ("failed", day(3))

    frames["now"] = source(spark, (9, "z", day(1)))
    assert sync.sync_table("one", "t", full_refresh=True)["rows"] == 1
    assert values(sync.warehouse.table("ONE_RAW", "T").read(), "id") == [(9,)]
    kinds = {r["event_type"] for r in sync.events.read().collect()}
    assert {"SYNC_START", "SOURCE_COUNT", "LOAD_COMPLETE", "SYNC_COMPLETE", "SYNC_FAILED"} <= kinds
    with pytest.raises(LookupError):
        sync.sync_table("one", "nope")

    # A target that went missing is filled with all rows, whatever the watermark.
    sync.warehouse.table("ONE_RAW", "T").drop()
    frames["now"] = source(spark, (1, "a", day(0)), (9, "z", day(1)))
    assert sync.sync_table("one", "t")["rows"] == 2


def test_config_duplicate_keys_fail_the_table(spark):
    frames = {"now": source(spark, (1, "a", day(1)))}
    sync = config_sync.ConfigSync(
        config_sync.SyncConfig.of(CONFIG),
        Warehouse(spark, fresh_folder(spark, "warehouse")),
        lambda name: frames["now"],
    )
    sync.sync_table("one", "t")
    frames["now"] = source(spark, (1, "b", day(2)), (1, "c", day(3)))
    result = sync.sync_table("one", "t")
    assert result["status"] == "failed" and "repeats a key" in result["error"]
    assert sync.status().first()["last_sync_value"] == day(1)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp", "date", "timestamp_ntz"])
def test_watermarks_of_other_types(spark, tmp_path, kind, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.range(1, 11).selectExpr(
            "id", f"CAST(timestamp_ntz'2024-03-01 00:30:00' + make_dt_interval(CAST(id AS int)) AS {kind}) AS at"
        )
        spec = TableSpec.of("t", "id", cdc_column="at")
        table = SnapshotTable(spark, str(tmp_path / "t"))
        first = flows.sync_cdc(FrameSource({"t": rows.filter("id <= 5")}), spec, table)
        assert first.row_count == 5 and first.watermark is not None
        second = flows.sync_cdc(FrameSource({"t": rows}), spec, table, first.watermark)
        assert second.row_count == 5 and table.read().count() == 10
        assert flows.sync_cdc(FrameSource({"t": rows}), spec, table, second.watermark).row_count == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_what_the_log_leaves_out_is_counted(spark, tmp_path):
    lines = [
        (1, "table public.t: DELETE: (no-tuple-data)"),
        (2, "table public.t: UPDATE: id[bigint]:7"),
        (3, "table public.t: INSERT: id[bigint]:1"),
    ]
    log = spark.createDataFrame(lines, "lsn bigint, data string")
    now = FrameSource({"t": spark.createDataFrame([(1, "a")], "id bigint, v string")})
    table = SnapshotTable(spark, str(tmp_path / "t"))
    done = flows.sync_wal(log, now, TableSpec.of("t", "id"), table, "public")
    assert (done.upserts, done.rejected, done.missing, done.position) == (1, 1, 1, 3)
    assert done.left_out == "1 unreadable lines skipped, 1 changed keys not in the source"


# --- rejected lines, and parts read at different times --------------------------------


def wal_line(lsn, text):
    return (lsn, f"table public.t: {text}")


LINES = [
    wal_line(1, "INSERT: id[bigint]:1 v[text]:'a'"),
    wal_line(2, "DELETE: (no-tuple-data)"),
    wal_line(3, "UPDATE: id[bigint]:2 v[text]:'b'"),
    wal_line(4, "TRUNCATE: (no-flags)"),
    (5, "table public.other: TRUNCATE: (no-flags)"),
]


def wal_run(spark, table, policy):
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    letters = rejects.DeadLetters(rejects.rejects_table(warehouse, "CONTROL"), "s", "t", policy)
    tables = source(spark, (1, "a", day(1)), (2, "b", day(2)), (9, "z", day(3)))
    lines = spark.createDataFrame(LINES, "lsn bigint, data string")
    table.overwrite(spark.createDataFrame([(2, "old", day(0))], ROWS), "id")
    return letters, lambda: flows.sync_wal(lines, tables, SPEC, table, "public", dead_letters=letters)


def test_rejected_lines_are_stored_once(spark, table, values):
    letters, run = wal_run(spark, table, "store")
    done = run()
    assert (done.rejected, done.position) == (1, 5)
    assert run().rejected == 1
    assert values(letters.pending(), "lsn", "reason") == [(2, "no readable key: id"), (4, "not a row change")]
    assert values(table.read(), "id", "v") == [(1, "a"), (2, "b")]
    letters.settle(spark.createDataFrame([(4,)], "lsn bigint"))
    assert values(letters.pending(), "lsn") == [(2,)]


def test_a_batch_of_nothing_but_rejected_lines(spark, table, values):
    table.overwrite(spark.createDataFrame([(2, "old", day(0))], ROWS), "id")
    only = spark.createDataFrame([LINES[1], LINES[3]], "lsn bigint, data string")
    done = flows.sync_wal(only, source(spark, (2, "b", day(2))), SPEC, table, "public")
    assert (done.rejected, done.row_count, done.position) == (1, 0, 4)
    assert values(table.read(), "id", "v") == [(2, "old")]


def test_rejected_lines_can_stop_a_run(spark, table, values):
    letters, run = wal_run(spark, table, "fail")
    with pytest.raises(rejects.RejectedLines, match="line at 2: no readable key: id"):
        run()
    assert values(table.read(), "id", "v") == [(2, "old")] and letters.pending().isEmpty()


def test_rejected_lines_can_reload_the_table(spark, table, values):
    letters, run = wal_run(spark, table, "reload")
    done = run()
    assert done.mode.startswith("FULL") and done.position == 5
    assert values(table.read(), "id", "v") == [(1, "a"), (2, "b"), (9, "z")]
    with pytest.raises(ValueError, match="unknown policy"):
        rejects.DeadLetters(letters.table, "s", "t", "drop")


class TornSource(FrameSource):
    """Parts of a split read see the table before and after a change."""

    one_snapshot = False

    def __init__(self, before, after):
        super().__init__({"t": before})
        self.after = after

    def read_split(self, spec, rows):
        torn = self.frames["t"].filter("id % 2 = 0").unionByName(self.after.filter("id % 2 = 1"))
        self.frames = {"t": self.after}
        return torn


@pytest.mark.parametrize("cdc_column", ["at", None])
def test_load_in_parts_equals_one_read(spark, table, values, cdc_column):
    before = [(i, "old", day(0)) for i in range(20)]
    after = [(i, "new" if i == 4 and cdc_column else "old", day(5 if i == 4 else 0)) for i in range(30) if i not in (6, 7)]
    frames = [spark.createDataFrame(rows, ROWS) for rows in (before, after)]
    spec = TableSpec.of("t", "id", cdc_column=cdc_column)
    if not cdc_column:  # changes within a row need a watermark column
        frames = [f.drop("at") for f in frames]
    done = flows.sync_full(TornSource(*frames), spec, table, batch_size=5)
    assert values(table.read()) == values(frames[1]) and done.row_count == 28


def test_registry_logs_and_replays_what_was_left_out(spark, world, sync, values):
    """The run log counts rejected lines and missing keys; repaired lines follow the source."""
    sync.sync_all()
    world.put("w", [(1, "a", day(1)), (3, "c", day(3))])
    world.log = [
        "table public.w: UPDATE: id[bigint]:7 v[text]:'gone'",
        "table public.w: INSERT: (no-tuple-data)",
        "table public.x: TRUNCATE: (no-flags)",
    ]
    runs = {r.table_id: r for r in sync.sync_all()}
    assert (runs["d_w"].rejected, runs["d_w"].missing, runs["d_x"].rejected) == (1, 1, 0)
    logged = sync.log.read().filter("rejected > 0").select("table_id", "rejected", "missing").collect()
    assert [tuple(r) for r in logged] == [("d_w", 1, 1)]
    assert values(sync.rejected.read(), "table_id", "lsn") == [("d_w", 1), ("d_x", 2)]

    repaired = spark.createDataFrame([(1, "table public.w: INSERT: id[bigint]:3 v[text]:'old'")], "lsn bigint, data string")
    done = sync.replay_rejects("d_w", repaired)
    assert (done.upserts, done.deletes) == (1, 0) and values(sync.rejected.read(), "table_id") == [("d_x",)]
    target = sync.warehouse.table("RAW", "W")
    assert values(target.read(), "id", "v") == [(1, "a"), (3, "c")]
    with pytest.raises(LookupError, match="d_nothing"):
        sync.replay_rejects("d_nothing")


def test_one_catalog_read_per_database(spark, world, sync):
    """Tables of a database share one look at its columns; one missing table stops no other."""
    asked = []

    class Listed(FrameSource):
        def catalog(self):
            asked.append(1)
            rows = [(n, i, f.name, f.dataType.simpleString()) for n, df in self.frames.items() for i, f in enumerate(df.schema.fields)]
            return spark.createDataFrame(rows, "table_id string, ordinal int, column_name string, data_type string")

    del world.frames["x"]
    sync.source_of = lambda database: Listed(world.frames)
    runs = {r.table_id: r for r in sync.sync_all()}
    assert len(asked) == 1 and runs["d_c"].ok and runs["d_w"].ok
    assert not runs["d_x"].ok and "'x' not found" in runs["d_x"].error
