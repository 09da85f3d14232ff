"""Snapshot tables: what is read, what is rewritten, what a crash leaves."""

import random
from datetime import date

import pytest

from tidemark.plans import store
from tidemark.plans.store import DuplicateKeyError, SnapshotTable, Warehouse, buckets_for
from tidemark.sources.scans import fresh_folder

COLUMNS = "k bigint, v string"


@pytest.fixture
def table(spark):
    return SnapshotTable(spark, fresh_folder(spark, "table"))


def rows(spark, start, end, value="a"):
    return spark.range(start, end).selectExpr("id AS k", f"'{value}' AS v")


def folders(table):
    return {b: list(v) for b, v in table.current().parts.items()}


def test_missing_table(table):
    assert not table.exists()
    with pytest.raises(LookupError):
        table.read()


def test_create_refuses_existing(spark, table):
    table.create(rows(spark, 0, 1).schema, "k")
    assert table.count() == 0 and table.columns() == ["k", "v"]
    with pytest.raises(ValueError, match="already exists"):
        table.create(rows(spark, 0, 1).schema, "k")


def test_overwrite_while_reading(spark, table):
    table.overwrite(rows(spark, 0, 100), "k")
    old = table.read()
    table.overwrite(old.selectExpr("k + 1000 AS k", "v"))
    assert old.count() == 100  # a query that began before still sees its version
    assert table.read().agg({"k": "min"}).first()[0] == 1000


def test_merge_rewrites_touched_buckets_only(spark, table):
    table.overwrite(rows(spark, 0, 1000), "k", buckets=16)
    before = folders(table)
    table.merge_rows(rows(spark, 5, 6, "b"))
    after = folders(table)
    changed = [b for b in after if after[b] != before[b]]
    assert len(changed) == 1
    assert table.count() == 1000
    assert [r["v"] for r in table.read().filter("k = 5").collect()] == ["b"]


def files(table):
    """Names of all files of the table's newest version."""
    return {(b, f) for b, ps in table.current().parts.items() for f in table._files(b, ps)}


def test_few_keys_rewrite_few_files(spark, table, monkeypatch):
    monkeypatch.setattr(store, "ROWS_PER_FILE", 100)
    table.overwrite(rows(spark, 0, 20_000), "k", buckets=32)
    before = files(table)
    assert len(before) >= 200
    keys = range(0, 20_000, 2_000)
    table.merge_rows(spark.createDataFrame([(k, "b") for k in keys], COLUMNS))
    left = files(table)
    assert len(before - left) <= 10 and len(left - before) <= 20
    assert table.count() == 20_000
    assert sorted(r["k"] for r in table.read().filter("v = 'b'").collect()) == list(keys)
    table.delete_keys(spark.createDataFrame([(k,) for k in [5, 6, 10**6]], "k bigint"))
    assert len(left - files(table)) <= 2 and table.count() == 19_998


def test_new_keys_rewrite_nothing(spark, table):
    table.overwrite(rows(spark, 0, 1000), "k", buckets=4)
    before = files(table)
    table.merge_rows(rows(spark, 5000, 5010, "b"))
    assert before < files(table) and table.count() == 1010
    table.delete_keys(rows(spark, 9000, 9010).select("k"))
    assert table.current().number == 2


def test_same_rows_as_one_reading_after_many_small_changes(spark, table, monkeypatch):
    monkeypatch.setattr(store, "ROWS_PER_FILE", 40)
    monkeypatch.setattr(store, "COMPACT_AFTER", 4)
    rng, want = random.Random(3), {k: "a" for k in range(600)}
    table.overwrite(rows(spark, 0, 600), "k", buckets=3)
    for step in range(8):
        changed = {rng.randrange(700): f"s{step}" for _ in range(12)}
        table.merge_rows(spark.createDataFrame(list(changed.items()), COLUMNS))
        want |= changed
        dead = [rng.randrange(700) for _ in range(5)]
        table.delete_keys(spark.createDataFrame([(k,) for k in set(dead)], "k bigint"))
        want = {k: v for k, v in want.items() if k not in dead}
        table.prune()
        assert {r["k"]: r["v"] for r in table.read().collect()} == want
    assert max(store.writes(ps) for ps in table.current().parts.values()) <= 5


def test_null_and_composite_keys_in_touched_files(spark, table):
    kinds = "a string, b date, v int"
    day = date(2024, 1, 1)
    table.overwrite(spark.createDataFrame([("x", day, 1), ("x", None, 2), (None, day, 3), ("y", day, 4)], kinds), "a, b")
    table.merge_rows(spark.createDataFrame([("x", day, 10), (None, day, 30), ("z", day, 50)], kinds))
    found = sorted((r["a"] or "", r["b"] is None, r["v"]) for r in table.read().collect())
    assert found == [("", False, 3), ("", False, 30), ("x", False, 10), ("x", True, 2), ("y", False, 4), ("z", False, 50)]


def test_emptied_bucket_disappears(spark, table):
    table.overwrite(rows(spark, 0, 40), "k", buckets=8)
    table.delete_keys(rows(spark, 0, 40).select("k"))
    assert table.count() == 0 and folders(table) == {}
    table.merge_rows(rows(spark, 3, 5))
    assert table.count() == 2


def test_merge_finds_keys_of_another_integer_type(spark, table):
    table.overwrite(rows(spark, 0, 100), "k", buckets=8)
    table.merge_rows(spark.range(0, 100).selectExpr("CAST(id AS INT) AS K", "'b' AS v"))
    assert table.count() == 100
    assert table.read().filter("v = 'b'").count() == 100


def test_batch_with_repeated_key_is_refused(spark, table):
    table.overwrite(rows(spark, 0, 10), "k")
    batch = rows(spark, 0, 2).unionByName(rows(spark, 1, 3))
    with pytest.raises(DuplicateKeyError):
        table.merge_rows(batch)
    assert table.count() == 10


def test_append_and_compact(spark, table):
    table.create(rows(spark, 0, 1).schema)
    for i in range(5):
        table.append(rows(spark, i, i + 1), compact_after=3)
    assert table.count() == 5
    assert max(len(v) for v in folders(table).values()) < 4


def test_failed_write_changes_nothing(spark, table):
    table.overwrite(rows(spark, 0, 10), "k")
    broken = spark.range(0, 10).selectExpr("id AS k", "raise_error('lost') AS v")
    with pytest.raises(Exception, match="lost"):
        table.overwrite(broken)
    assert table.count() == 10
    table.overwrite(rows(spark, 0, 3))
    assert table.count() == 3


def test_abandoned_folder_is_ignored(spark, table):
    table.overwrite(rows(spark, 0, 10), "k")
    rows(spark, 0, 99).write.parquet(f"{table.path}/data/v=7")
    assert table.count() == 10
    table.append(rows(spark, 10, 12))
    assert table.count() == 12 and table.current().number == 8


def test_second_writer_is_noticed(spark, table):
    table.overwrite(rows(spark, 0, 10), "k")
    version = table.current()
    version.number += 1
    table._commit(version)
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(version)


def test_truncate_and_drop(spark, table):
    table.overwrite(rows(spark, 0, 10), "k")
    table.truncate()
    assert table.exists() and table.count() == 0 and table.columns() == ["k", "v"]
    table.drop()
    assert not table.exists()
    table.drop()


def test_prune_keeps_what_is_named(spark, table):
    for i in range(4):
        table.overwrite(rows(spark, 0, 10 + i), "k", buckets=2)
    table.merge_rows(rows(spark, 0, 1, "b"))
    table.prune(keep=1)
    assert table.count() == 13
    assert len(table._versions.names()) == 1
    named = {store.number_of(p) for ps in folders(table).values() for p in ps}
    left = {
        int(f[2:])
        for f in table._folder.names("data")
        if any(b.startswith("_bucket=") for b in table._folder.names(f"data/{f}"))
    }
    assert left == named


def test_warehouse_listing(spark):
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    warehouse.table("RAW", "A").overwrite(rows(spark, 0, 1), "k")
    warehouse.table("RAW", "B").overwrite(rows(spark, 0, 1), "k")
    assert warehouse.schemas() == ["RAW"] and warehouse.tables("RAW") == ["A", "B"]
    assert warehouse.table("RAW", "A") is warehouse.table("RAW", "A")


def test_bucket_counts():
    assert [buckets_for(n) for n in (0, 2_000_000, 2_000_001, 10**12)] == [1, 1, 2, 8192]
