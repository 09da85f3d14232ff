"""What the physical plans must and must not hold, at a size where nothing is broadcast."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
# Queries that write tables or run streams, and so have run when they return.
WRITERS = {
    n for n in QUERIES
    if n.startswith(("sink_", "sync_", "stream_", "table_", "target_", "truncate_", "drop_"))
} | {"scan_paged", "changelog_commit", "run_log_append", "event_log_append", "log_export_csv", "state_reset_all"}


@pytest.fixture(scope="module")
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


OWN = {name for module in entry.MODULES for name in module.QUERIES}


@pytest.mark.parametrize("name", sorted(OWN - WRITERS))
def test_plan_scales(spark, no_broadcast, name):
    plan = plan_of(spark, name)
    for never in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "PythonUDF", "BatchEvalPython"):
        assert never not in plan
    # The only window is a fixture's row_number = 1, cut down before its shuffle.
    assert plan.count("- Window [") == plan.count("row_number(), 1, Partial")


def test_log_prefix_reaches_the_scan(spark):
    from tidemark.operators import wal
    from tidemark.sources.scans import fresh_folder

    path = fresh_folder(spark, "lines")
    spark.createDataFrame([(1, "BEGIN")], "lsn bigint, data string").write.parquet(path)
    df = wal.parse_changes(spark.read.parquet(path), "data", "users", {"pkid": "bigint"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(data,table data.users: )" in plan


def test_net_changes_use_a_hash_aggregate(spark):
    plan = plan_of(spark, "wal_net_changes")
    assert "partial_max" in plan and "SortAggregate" not in plan


def test_report_reads_what_it_needs(spark):
    plan = plan_of(spark, "tables_per_database")
    assert "ReadSchema: struct<user_id:bigint>" in plan
