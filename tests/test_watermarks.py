"""Watermarks of every type: kept as text, compared in their type."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, DecimalType, LongType, StringType, TimestampType

from tidemark.functions import watermarks
from tidemark.plans import flows
from tidemark.plans.store import SnapshotTable
from tidemark.sources.scans import FrameSource, TableSpec, fresh_folder

SPEC = TableSpec.of("t", "id", cdc_column="at")
VALUES = [0, -5, 10**17, Decimal("12.50"), 1.5, date(2024, 2, 29), datetime(2024, 2, 29, 1, 2, 3, 456789), "", "é", b"\x00\xff"]


@pytest.mark.parametrize("value", VALUES)
def test_text_and_type_give_the_value_back(value):
    text, name = watermarks.to_text(value)
    assert watermarks.from_text(text, name) == value and type(watermarks.from_text(text, name)) is type(value)


def test_no_watermark_and_no_type_for_it():
    assert watermarks.to_text(None) == (None, None) and watermarks.from_text(None, None) is None
    with pytest.raises(TypeError):
        watermarks.to_text(True) or watermarks.to_text([1])
    with pytest.raises(TypeError):
        watermarks.to_text([1])


def test_stored_time_of_rows_without_a_text():
    now = datetime(2024, 1, 1)
    assert watermarks.stored(None, None, now) == now and watermarks.stored("7", "bigint", now) == 7


def test_usable_only_with_a_column_of_its_kind():
    assert watermarks.usable(0, LongType()) == 0 and watermarks.usable(7, DecimalType(10, 2)) == 7
    assert watermarks.usable(7, StringType()) is None and watermarks.usable("x", LongType()) is None
    assert watermarks.usable(datetime(2024, 1, 1), DateType()) and watermarks.usable(datetime(2024, 1, 1), TimestampType())
    assert watermarks.usable(b"x", BinaryType()) == b"x" and watermarks.usable(None, LongType()) is None


@pytest.mark.parametrize(
    "kind, value",
    [
        ("int", "id - 3"),
        ("bigint", "id * 1000000000000"),
        ("decimal(12,3)", "id / 8"),
        ("double", "id * 0.1"),
        ("date", "date_add(DATE '2024-01-01', CAST(id AS INT))"),
        ("timestamp_ntz", "TIMESTAMP_NTZ '2024-01-01 00:00:00.000001' + make_dt_interval(id)"),
        ("timestamp", "TIMESTAMP '2024-01-01 00:00:00 America/New_York' + make_dt_interval(id)"),
        ("string", "lpad(CAST(id AS STRING), 3, '0')"),
        ("binary", "CAST(lpad(CAST(id AS STRING), 3, '0') AS BINARY)"),
    ],
)
def test_second_run_reads_newer_rows_only(spark, kind, value):
    """Strictly above the stored watermark, after a way through text."""
    rows = spark.range(20).selectExpr("id", f"CAST({value} AS {kind}) AS at")
    table = SnapshotTable(spark, fresh_folder(spark, "table"))
    first = flows.sync_cdc(FrameSource({"t": rows.filter("id < 12")}), SPEC, table)
    mark = watermarks.from_text(*watermarks.to_text(first.watermark))
    second = flows.sync_cdc(FrameSource({"t": rows}), SPEC, table, mark)
    assert (first.row_count, second.row_count, table.count()) == (12, 8, 20)
    third = flows.sync_cdc(FrameSource({"t": rows}), SPEC, table, second.watermark)
    assert third.row_count == 0 and third.watermark == second.watermark


def test_a_watermark_of_another_type_reads_all_rows(spark):
    rows = spark.range(5).selectExpr("id", "CAST(id AS STRING) AS at")
    table = SnapshotTable(spark, fresh_folder(spark, "table"))
    table.overwrite(rows, "id")
    assert flows.sync_cdc(FrameSource({"t": rows}), SPEC, table, datetime(2024, 1, 1)).row_count == 5


def test_old_control_tables_get_the_new_columns(spark):
    from tidemark import schemas as s
    from tidemark.plans.store import Warehouse

    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    old = flows.control_table(warehouse, "replication_state", s.STATE)
    old.append(spark.createDataFrame([("d", "t")], "source_db string, table_name string").selectExpr(
        "*", *[f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in s.STATE.fields[2:]]
    ))
    new = flows.control_table(warehouse, "replication_state", s.with_watermark(s.STATE))
    assert new.columns() == s.with_watermark(s.STATE).names and new.count() == 1
    assert new.read().filter(F.col("watermark_text").isNull()).count() == 1
