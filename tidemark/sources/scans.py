"""Scans of source tables.

The operators work on any DataFrame that reads a source table. Over JDBC, or over
parquet, Catalyst carries the filters, column choices and aggregates below to the
scan, so ``scan_incremental`` fetches new rows only and ``source_count`` no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions import key_list, typed_literal
from tidemark.operators.merge import rows_by_keys
from tidemark.sources.splits import parts_for


@dataclass(frozen=True)
class TableSpec:
    """A source table: name, key columns, watermark column and read options."""

    name: str
    keys: tuple[str, ...] = ()
    cdc_column: str | None = None
    partition_column: str | None = None
    num_partitions: int | None = None  # None: by the table's size
    fetch_size: int = s.DEFAULT_FETCH_SIZE

    @staticmethod
    def of(name: str, keys: str | Sequence[str] | None = None, **options: Any) -> TableSpec:
        return TableSpec(name, tuple(key_list(keys)), **options)

    @property
    def range_column(self) -> str | None:
        return self.partition_column or (self.keys[0] if self.keys else None)

    @property
    def split_columns(self) -> tuple[str, ...]:
        return (self.partition_column,) if self.partition_column else self.keys

    def parts(self, rows: int) -> int:
        return self.num_partitions or parts_for(rows, s.DEFAULT_PARTITIONS)


class Source(Protocol):
    """Where source tables come from.

    ``one_snapshot`` says that all parts of a split read see the same rows.
    """

    one_snapshot: bool

    def read(self, spec: TableSpec) -> DataFrame:
        """All rows, lazily."""

    def read_ranges(self, spec: TableSpec, lower: Any, upper: Any) -> DataFrame:
        """All rows, in strides of ``spec.range_column`` where the source reads by query."""

    def read_split(self, spec: TableSpec, rows: int) -> DataFrame:
        """All rows, of which there are about ``rows``, in parts of equal size by key."""

    def read_keys(self, spec: TableSpec, keys: DataFrame) -> DataFrame:
        """Rows whose key is in ``keys``."""

    def probe(self, spec: TableSpec) -> tuple[int, Any, Any]:
        """Row count, and lowest and highest value of ``spec.range_column``."""

    def columns(self, spec: TableSpec) -> list[tuple[str, str]]:
        """Ordered column names and type names."""

    def catalog(self) -> DataFrame:
        """``(table_id, ordinal, column_name, data_type)`` of all tables, in one read.

        A source that has no catalog of its own leaves the method out.
        """


def probe_rows(df: DataFrame, column: str | None) -> tuple[int, Any, Any]:
    """Count, minimum and maximum in one pass."""
    bounds = [F.min(column), F.max(column)] if column else [F.lit(None), F.lit(None)]
    return tuple(df.agg(F.count("*"), *bounds).first())


class ParquetSource:
    """Source tables kept as parquet, ``<root>/<name>.parquet``.

    Spark splits files by itself, so parts by key need no work: a table is read once.
    """

    one_snapshot = True

    def __init__(self, spark: SparkSession, root: str, suffix: str = ".parquet") -> None:
        self.spark, self.root, self.suffix = spark, root.rstrip("/"), suffix

    def read(self, spec: TableSpec) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{spec.name}{self.suffix}")

    def read_ranges(self, spec: TableSpec, lower: Any, upper: Any) -> DataFrame:
        return self.read(spec)

    def read_split(self, spec: TableSpec, rows: int) -> DataFrame:
        return self.read(spec)

    def read_keys(self, spec: TableSpec, keys: DataFrame) -> DataFrame:
        return rows_by_keys(self.read(spec), keys, spec.keys)

    def probe(self, spec: TableSpec) -> tuple[int, Any, Any]:
        return probe_rows(self.read(spec), spec.range_column)

    def columns(self, spec: TableSpec) -> list[tuple[str, str]]:
        return columns_of(self.read(spec))


def range_filters(column: str, lower: Any, upper: Any, count: int) -> list[Column]:
    """Conditions of even strides between the bounds, disjoint and complete.

    The outer two are open, and the first takes the NULLs.
    """
    value, stride = F.col(column), _stride(lower, upper, count)
    starts = [_bound(lower + i * stride) for i in range(count)]
    if count == 1:
        return [F.lit(True)]
    first = (value < starts[1]) | value.isNull()
    inner = [(value >= a) & (value < b) for a, b in zip(starts[1:], starts[2:])]
    return [first, *inner, value >= starts[-1]]


def _stride(lower: Any, upper: Any, count: int) -> Any:
    """An even step of the bounds' own type, whole days for dates, never zero."""
    step = (upper - lower) // count
    if isinstance(lower, datetime):
        return max(step, timedelta(microseconds=1))
    return timedelta(days=max(step.days, 1)) if isinstance(lower, date) else max(step, 1)


def _bound(value: Any) -> Any:
    return typed_literal(value, "timestamp_ntz") if isinstance(value, datetime) else value


def columns_by_table(
    source: Source, specs: Sequence[TableSpec]
) -> dict[str, list[tuple[str, str]] | Exception]:
    """Columns of many tables of one source, read from its catalog at once where it has one.

    A table that is not found, or cannot be read, gets the error in place of its columns.
    """
    if not hasattr(source, "catalog"):
        found: dict[str, list[tuple[str, str]] | Exception] = {}
        for spec in specs:
            try:
                found[spec.name] = source.columns(spec)
            except Exception as error:  # belongs to this table; the others go on
                found[spec.name] = error
        return found
    names = [spec.name for spec in specs]
    listed: dict[str, list[tuple[str, str]]] = {}
    rows = source.catalog().filter(F.col("table_id").isin(names)).orderBy("table_id", "ordinal")
    for row in rows.collect():  # one row per column of a registered table
        listed.setdefault(row["table_id"], []).append((row["column_name"], row["data_type"]))
    return {n: listed.get(n) or LookupError(f"source table {n!r} not found") for n in names}


class FrameSource:
    """Source tables given as DataFrames, for tests and derived inputs."""

    one_snapshot = True

    def __init__(self, frames: dict[str, DataFrame]) -> None:
        self.frames = frames

    def read(self, spec: TableSpec) -> DataFrame:
        if spec.name not in self.frames:
            raise LookupError(f"source table {spec.name!r} not found")
        return self.frames[spec.name]

    def read_ranges(self, spec: TableSpec, lower: Any, upper: Any) -> DataFrame:
        return self.read(spec)

    def read_split(self, spec: TableSpec, rows: int) -> DataFrame:
        return self.read(spec)

    def read_keys(self, spec: TableSpec, keys: DataFrame) -> DataFrame:
        return rows_by_keys(self.read(spec), keys, spec.keys)

    def probe(self, spec: TableSpec) -> tuple[int, Any, Any]:
        return probe_rows(self.read(spec), spec.range_column)

    def columns(self, spec: TableSpec) -> list[tuple[str, str]]:
        return columns_of(self.read(spec))


# --- probes ---------------------------------------------------------------------------


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def source_columns(catalog: DataFrame, schema: str) -> DataFrame:
    """Columns of a schema's tables from an ``information_schema.columns`` read."""
    return (
        catalog.filter(F.col("table_schema") == schema)
        .select(
            F.col("table_name").alias("table_id"),
            F.col("ordinal_position").alias("ordinal"),
            "column_name",
            "data_type",
        )
        .orderBy("table_id", "ordinal")
    )


def source_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("cnt"))


def source_max_watermark(df: DataFrame, cdc_column: str | None) -> DataFrame:
    """Highest watermark value; NULL without a watermark column or rows."""
    if not cdc_column:
        return df.agg(F.max(F.lit(None).cast("timestamp_ntz")).alias("max_val"))
    return df.agg(F.max(cdc_column).alias("max_val"))


# --- scans ----------------------------------------------------------------------------


def newer_than(df: DataFrame, cdc_column: str | None, watermark: Any, lookback: str = "") -> DataFrame:
    """Rows strictly above the watermark; without one, all rows.

    ``lookback`` (an interval such as ``'10 minutes'``) reads further back, for
    rows that were committed late. The merge that follows makes that harmless.
    """
    if watermark is None or not cdc_column:
        return df
    start: Column = typed_literal(watermark, df.schema[cdc_column].dataType)
    if lookback:
        start = start - F.expr(f"INTERVAL '{lookback}'")
    return df.filter(F.col(cdc_column) > start)


def scan_full(source: Source, spec: TableSpec) -> DataFrame:
    return source.read(spec)


def scan_incremental(
    source: Source, spec: TableSpec, watermark: datetime | str | None, lookback: str = ""
) -> DataFrame:
    return newer_than(source.read(spec), spec.cdc_column, watermark, lookback)


def scan_partitioned(
    source: Source, spec: TableSpec, lower: Any, upper: Any, watermark: Any = None
) -> DataFrame:
    """N range reads; the bounds set the stride only and never drop a row."""
    return newer_than(source.read_ranges(spec, lower, upper), spec.cdc_column, watermark)


def scan_auto(
    source: Source,
    spec: TableSpec,
    watermark: Any = None,
    threshold: int = s.LARGE_TABLE_ROWS,
) -> tuple[DataFrame, int]:
    """A single read, or reads of equal parts above ``threshold`` rows; with the source count.

    The probe, answered by the source itself, gives the count; the source then splits
    by what its key's order says, so a key may have any type and any number of columns.
    A table without a key or partition column is read at once.
    """
    count = source.probe(spec)[0]
    if count > threshold and spec.split_columns:
        return newer_than(source.read_split(spec, count), spec.cdc_column, watermark), count
    return scan_incremental(source, spec, watermark), count


def scan_by_keys(source: Source, spec: TableSpec, keys: DataFrame) -> DataFrame:
    return source.read_keys(spec, keys)


def scan_paged(df: DataFrame, keys: Sequence[str], batch_size: int, page: str = "page") -> DataFrame:
    """All rows in key order with the number of the ``batch_size`` page they fall in.

    A range shuffle sorts in parallel; a row's index is its position in its range
    plus the sizes of the ranges before it, so no task sees the whole order. The
    hash behind the keys lets repeated keys split over ranges. Ranges are drawn
    from a sample, hence they are cut once with ``checkpoint()``: the sizes and
    the rows then come from the same ranges, also after a lost executor. Needs
    the session's shared checkpoint folder.
    """
    order = [*keys, F.xxhash64(*df.columns)]
    position = F.monotonically_increasing_id()  # range number above 33 bits, index below
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", position)
        .checkpoint()
    )
    number = F.shiftright("_position", 33)
    # One row per shuffle partition: bounded by spark.sql.shuffle.partitions.
    sizes = ranged.groupBy(number.alias("_range")).count().orderBy("_range").collect()
    starts, before = [], 0
    for row in sizes:
        starts.append((row["_range"], before))
        before += row["count"]
    offsets = df.sparkSession.createDataFrame(starts, "_range bigint, _start bigint")
    index = F.col("_start") + F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.withColumn("_range", number)
        .join(F.broadcast(offsets), "_range")
        .withColumn(page, F.floor(index / batch_size).cast("bigint"))
        .drop("_range", "_start", "_position")
    )


# --- shared work folder ---------------------------------------------------------------


def work_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; on a cluster a
    machine-local folder would lose data, so that is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.tidemark.workDir", None
    )
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.tidemark.workDir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the work folder."""
    return f"{work_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
