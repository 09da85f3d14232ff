"""Streams over several polls, restarts included."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import wal
from tidemark.plans import flows
from tidemark.plans.store import SnapshotTable
from tidemark.sources.dbapi import DbApiSource
from tidemark.sources.scans import FrameSource, TableSpec, fresh_folder
from tidemark.streaming import streams

USERS = TableSpec.of("users", "k")


def log(spark, n):
    action = F.when(F.col("id") % 5 == 0, "DELETE").when(F.col("id") % 3 == 0, "INSERT").otherwise("UPDATE")
    key = (F.col("id") * 7 % 40).cast("string")
    return spark.range(n).select(
        F.col("id").alias("lsn"),
        F.concat(F.lit("table public.users: "), action, F.lit(": k[bigint]:"), key).alias("data"),
    )


def test_log_stream_over_a_driver(spark, values):
    """Offsets come from the log's positions; a restart goes on behind the last one."""
    folder, checkpoint = fresh_folder(spark, "log"), fresh_folder(spark, "stream")
    lines = log(spark, 300)
    users = spark.range(60).selectExpr("id AS k", "'new' AS v")
    source = FrameSource({"users": users})
    target = SnapshotTable(spark, fresh_folder(spark, "users"))
    target.overwrite(spark.range(0, 60, 2).selectExpr("id AS k", "'old' AS v"), "k")
    files = {"lines": f"read_parquet('{folder}/*.parquet')"}
    driver = DbApiSource(spark, "duckdb:connect", tables=files)

    for low, high in ((0, 100), (100, 250), (250, 300)):
        lines.filter(f"lsn >= {low} AND lsn < {high}").write.mode("append").parquet(folder)
        stream = driver.changelog(TableSpec.of("lines", num_partitions=3))
        query = streams.stream_wal(stream, source, USERS, target, "public", checkpoint, {"k": "bigint"})
        query.awaitTermination()

    net = wal.net_changes(wal.parse_changes(lines, "public", "users", {"k": "bigint"}), ["k"])
    dead = {r["k"] for r in net.filter("op = 'D'").collect()}
    live = {r["k"] for r in net.filter("op <> 'D'").collect()}
    want = {k: "old" for k in range(0, 60, 2) if k not in dead} | {k: "new" for k in live}
    assert values(target.read()) == sorted(want.items(), key=repr)


def test_newest_version_per_key(spark, values):
    rows = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (None, 1, "x"), (None, 2, "y")], "k bigint, at bigint, v string"
    )
    got = streams.newest_per_key(rows, ["k"], "at")
    assert values(got, "v") == [("c",), ("x",), ("y",)]


def test_cdc_stream_makes_and_merges(spark, values):
    folder, checkpoint = fresh_folder(spark, "rows"), fresh_folder(spark, "stream")
    target = SnapshotTable(spark, fresh_folder(spark, "target"))
    schema = "k bigint, at bigint, v string"
    for batch in ([(1, 1, "a"), (2, 1, "b"), (1, 2, "aa")], [(2, 3, "bb"), (3, 3, "c")], []):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(folder)
        changed = spark.readStream.schema(schema).parquet(folder)
        streams.stream_cdc(changed, ["k"], "at", target, checkpoint).awaitTermination()
    assert values(target.read(), "k", "v") == [(1, "aa"), (2, "bb"), (3, "c")]


def test_older_rows_never_replace_newer_ones(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    folder = tmp_path / "in"
    kind = "k bigint, v string, at timestamp_ntz"
    for name, rows in {"a": [(1, "new", 5), (2, "x", 1)], "b": [(1, "old", 3), (2, "y", 2)]}.items():
        frame = spark.createDataFrame([(k, v, datetime(2024, 1, d)) for k, v, d in rows], kind)
        frame.coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(kind).parquet(str(folder))
        streams.stream_cdc(stream, ["k"], "at", table, str(tmp_path / "check")).awaitTermination()
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, "new"), (2, "y")]


def test_batches_in_any_order_and_again(spark, values):
    """Each order of three batches, and a second stream over all of them, give one target."""
    lines = log(spark, 120)
    users = spark.range(60).selectExpr("id AS k", "'new' AS v")
    net = wal.net_changes(wal.parse_changes(lines, "public", "users", {"k": "bigint"}), ["k"])
    live = [(r["k"], "new") for r in net.filter("op <> 'D'").collect()]
    dead = {r["k"] for r in net.filter("op = 'D'").collect()}
    want = sorted(live + [(k, "old") for k in range(0, 60, 2) if k not in dead | {k for k, _ in live}])
    for parts in ((2, 0, 1), (1, 2, 0)):
        target = SnapshotTable(spark, fresh_folder(spark, "users"))
        target.overwrite(spark.range(0, 60, 2).selectExpr("id AS k", "'old' AS v"), "k")
        folder, checkpoint = fresh_folder(spark, "lines"), fresh_folder(spark, "stream")

        def poll(checkpoint):
            read = spark.readStream.schema("lsn bigint, data string").parquet(folder)
            source = FrameSource({"users": users})
            streams.stream_wal(read, source, USERS, target, "public", checkpoint, {"k": "bigint"}).awaitTermination()

        for part in parts:
            lines.filter(f"lsn >= {part * 40} AND lsn < {part * 40 + 40}").write.mode("append").parquet(folder)
            poll(checkpoint)
        assert sorted(map(tuple, target.read().collect())) == want
        assert target.current().applied["lsn"] == 119
        poll(fresh_folder(spark, "stream"))
        assert sorted(map(tuple, target.read().collect())) == want


def test_a_batch_that_was_committed_is_not_applied_again(spark, monkeypatch):
    target = SnapshotTable(spark, fresh_folder(spark, "users"))
    target.overwrite(spark.range(5).selectExpr("id AS k", "'old' AS v"), "k")
    net = spark.createDataFrame([(1, 7, "U")], "k bigint, lsn bigint, op string")
    order = flows.BatchOrder(target, "stream", 3)
    assert not order.done and not order.behind(net)
    order.remember(net, ["k"])
    assert flows.BatchOrder(target, "stream", 3).done and flows.BatchOrder(target, "stream", 2).done
    assert not flows.BatchOrder(target, "stream", 4).done and not flows.BatchOrder(target, "other", 0).done
