"""Source tables and change logs over any Python DB-API driver.

For sources without a JDBC driver at hand. Every task opens its own connection,
from a ``module:function`` name and its arguments, and streams Arrow batches of
``fetchsize`` rows. Values always travel as statement parameters.

Comparison filters, such as the watermark's, go into the source's WHERE clause.
"""

from __future__ import annotations

import importlib
import json
import math
from collections.abc import Iterator, Mapping, Sequence
from datetime import date
from decimal import Decimal
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark import schemas as s
from tidemark.sources.dialects import dialect_of_module
from tidemark.sources.scans import TableSpec
from tidemark.sources.splits import conditions, ends_sql

FORMAT = "tidemark_dbapi"
LOOKUP_CHUNK = 500

# information_schema type names and the Spark types they are read as.
SQL_TYPES = {
    "smallint": "smallint",
    "tinyint": "smallint",
    "integer": "int",
    "int": "int",
    "mediumint": "int",
    "bigint": "bigint",
    "real": "float",
    "float": "double",
    "double": "double",
    "double precision": "double",
    "numeric": "decimal(38,10)",
    "decimal": "decimal(38,10)",
    "money": "decimal(19,4)",
    "boolean": "boolean",
    "bool": "boolean",
    "bit": "boolean",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "timestamp without time zone": "timestamp_ntz",
    "datetime": "timestamp_ntz",
    "datetime2": "timestamp_ntz",
    "timestamp with time zone": "timestamp",
    "bytea": "binary",
    "blob": "binary",
    "varbinary": "binary",
}

_COMPARISONS = {
    GreaterThan: ">",
    GreaterThanOrEqual: ">=",
    LessThan: "<",
    LessThanOrEqual: "<=",
    EqualTo: "=",
}


def _quoted(name: str, quotes: str) -> str:
    left, right = quotes[0], quotes[-1]
    return left + name.replace(right, right * 2) + right


class Connection:
    """A DB-API connection, opened where it is used."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.module, _, function = options["connect"].partition(":")
        self.function = function or "connect"
        self.arguments = json.loads(options.get("connectargs", "{}"))
        root = importlib.import_module(self.module.partition(".")[0])
        style = getattr(root, "paramstyle", "pyformat")
        self.mark = "?" if style in ("qmark", "numeric") else "%s"

    def batches(
        self, sql: str, parameters: Sequence[Any], size: int
    ) -> Iterator[tuple[list[str], list[tuple]]]:
        """Column names with rows, ``size`` at a time."""
        connect = getattr(importlib.import_module(self.module), self.function)
        connection = connect(**self.arguments)
        try:
            cursor = connection.cursor()
            cursor.execute(sql, list(parameters))
            names = [d[0] for d in cursor.description]
            while rows := cursor.fetchmany(size):
                yield names, rows
        finally:
            connection.close()

    def rows(self, sql: str, parameters: Sequence[Any] = ()) -> list[tuple]:
        return [row for _, rows in self.batches(sql, parameters, 1000) for row in rows]


def _as_text(value: Any) -> str:
    """A value of a type that Spark has none for: structures as JSON, all else as printed."""
    if isinstance(value, (dict, list, tuple)):
        return json.dumps(value, default=str)
    if isinstance(value, (bytes, bytearray, memoryview)):
        return bytes(value).hex()
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


def _converted(values: Sequence[Any], kind: pa.DataType) -> list[Any]:
    """A driver's values as Arrow takes them for a column of this type."""
    if pa.types.is_string(kind):
        return [v if v is None or isinstance(v, str) else _as_text(v) for v in values]
    if pa.types.is_binary(kind):
        return [v if v is None else bytes(v) for v in values]
    if pa.types.is_boolean(kind):
        return [any(v) if isinstance(v, (bytes, bytearray)) else None if v is None else bool(v) for v in values]
    if pa.types.is_decimal(kind):
        places = Decimal(1).scaleb(-kind.scale)
        return [v if v is None else Decimal(str(v)).quantize(places) for v in values]
    return list(values)


def _to_arrow(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(_converted(c, f.type), f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def range_conditions(column: str, lower: int, upper: int, count: int, mark: str) -> list[tuple]:
    """``(condition, parameters)`` of ``count`` strides; the outer two are open, NULLs go first."""
    stride = max((upper - lower) // count, 1)
    starts = [lower + i * stride for i in range(1, count) if lower + i * stride <= upper]
    if not starts:
        return [("", [])]
    first = (f"({column} < {mark} OR {column} IS NULL)", [starts[0]])
    middle = [
        (f"({column} >= {mark} AND {column} < {mark})", [a, b]) for a, b in zip(starts, starts[1:])
    ]
    return [first, *middle, (f"{column} >= {mark}", [starts[-1]])]


class _Range(InputPartition):
    def __init__(self, condition: str, parameters: list) -> None:
        self.condition, self.parameters = condition, parameters


class _Table:
    """SELECT statements of one source table."""

    def __init__(self, options: Mapping[str, str], schema: StructType) -> None:
        self.options, self.schema = dict(options), schema
        self.quotes = options.get("quotes", '""')
        self.table = options["dbtable"]
        self.size = int(options.get("fetchsize", s.DEFAULT_FETCH_SIZE))

    def name(self, column: str) -> str:
        return _quoted(column, self.quotes)

    def select(self, conditions: Sequence[str]) -> str:
        columns = ", ".join(self.name(c) for c in self.schema.names)
        where = " AND ".join(c for c in conditions if c)
        return f"SELECT {columns} FROM {self.table}" + (f" WHERE {where}" if where else "")

    def arrow(self, conditions: Sequence[str], parameters: Sequence[Any]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        statement = self.select(conditions)
        for _, rows in Connection(self.options).batches(statement, parameters, self.size):
            yield _to_arrow(rows, schema)


class DbApiReader(DataSourceReader):
    """Batch read of a table, in ranges when a partition column is given."""

    def __init__(self, options: Mapping[str, str], schema: StructType) -> None:
        self.table = _Table(options, schema)
        self.mark = Connection(options).mark
        self.conditions: list[str] = []
        self.parameters: list[Any] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for each in filters:
            sign = _COMPARISONS.get(type(each))
            if not isinstance(each, (In, IsNotNull)) and sign is None or len(each.attribute) != 1:
                yield each
                continue
            column = self.table.name(each.attribute[0])
            if sign:
                self.conditions.append(f"{column} {sign} {self.mark}")
                self.parameters.append(each.value)
            elif isinstance(each, In):
                marks = ", ".join([self.mark] * len(each.value))
                self.conditions.append(f"{column} IN ({marks})")
                self.parameters += each.value
            else:
                self.conditions.append(f"{column} IS NOT NULL")

    def partitions(self) -> list[InputPartition]:
        options = self.table.options
        if "splitcolumns" in options:
            return self._split([self.table.name(c) for c in json.loads(options["splitcolumns"])])
        column = options.get("partitioncolumn")
        if not column:
            return [_Range("", [])]
        ranges = range_conditions(
            self.table.name(column),
            int(options["lowerbound"]),
            int(options["upperbound"]),
            int(options.get("numpartitions", s.DEFAULT_PARTITIONS)),
            self.mark,
        )
        return [_Range(*r) for r in ranges]

    def _split(self, columns: list[str]) -> list[InputPartition]:
        """Parts of equal size of the whole table; their ends come from the source."""
        options = self.table.options
        sql = ends_sql(columns, self.table.table, int(options["rows"]), int(options["numpartitions"]))
        ends = Connection(options).rows(sql) if sql else []
        return [_Range(*c) for c in conditions(columns, ends, lambda v: (self.mark, [v]))]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        yield from self.table.arrow(
            [*self.conditions, partition.condition], [*self.parameters, *partition.parameters]
        )


class ChangeLogReader(DataSourceStreamReader):
    """Stream of a log table by position. The checkpoint keeps the offset.

    Nothing is consumed in the source: a batch that is read again reads the same.
    """

    def __init__(self, options: Mapping[str, str], schema: StructType) -> None:
        self.table = _Table(options, schema)
        self.connection = Connection(options)
        self.column = self.table.name(options.get("offsetcolumn", "lsn"))
        self.start = int(options.get("startoffset", -1))
        self.parallel = int(options.get("numpartitions", s.DEFAULT_PARTITIONS))

    def initialOffset(self) -> dict:
        return {"lsn": self.start}

    def latestOffset(self) -> dict:
        top = self.connection.rows(f"SELECT max({self.column}) FROM {self.table.table}")[0][0]
        return {"lsn": self.start if top is None else max(int(top), self.start)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, high = start["lsn"], end["lsn"]
        count = max(1, min(self.parallel, high - low))
        edges = [low + (high - low) * i // count for i in range(count)] + [high]
        condition = f"{self.column} > {self.connection.mark} AND {self.column} <= {self.connection.mark}"
        return [_Range(condition, [a, b]) for a, b in zip(edges, edges[1:])]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        yield from self.table.arrow([partition.condition], partition.parameters)


class DbApiDataSource(DataSource):
    """``spark.read`` and ``spark.readStream`` format over a DB-API connection."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _plain(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def schema(self) -> StructType:
        raise ValueError("give the schema with .schema(...); DbApiSource reads it from the catalog")

    def reader(self, schema: StructType) -> DataSourceReader:
        return DbApiReader(self._plain(), schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ChangeLogReader(self._plain(), schema)


def register(spark: SparkSession) -> None:
    """Make the format known, with filter push-down; its code travels to the executors."""
    import tidemark
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(tidemark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DbApiDataSource)


class DbApiSource:
    """Source tables over a DB-API driver.

    ``connect`` names the driver's connect function, ``arguments`` its keyword
    arguments. Quotes and the schema follow the driver's dialect where they are not
    given. ``tables`` says what stands in FROM for a table; by default the quoted
    ``schema.table``, or ``table`` alone where neither names a schema. Values of
    types that Spark has none for (uuid, json, time) come as texts.
    """

    one_snapshot = False  # every part is a query of its own

    def __init__(
        self,
        spark: SparkSession,
        connect: str,
        arguments: Mapping[str, Any] | None = None,
        schema: str | None = None,
        quotes: str | None = None,
        tables: Mapping[str, str] | None = None,
        types: Mapping[str, str] | None = None,
    ) -> None:
        register(spark)
        dialect = dialect_of_module(connect)
        default = dialect.schema if dialect else s.DEFAULT_SOURCE_SCHEMA
        self.spark, self.schema = spark, schema or default
        self.quotes = quotes or ("".join(dialect.quote) if dialect else '""')
        self.tables, self.types = dict(tables or {}), dict(types or {})
        self.base = {"connect": connect, "connectargs": json.dumps(dict(arguments or {}))}

    def _from(self, spec: TableSpec) -> str:
        quoted = ".".join(_quoted(n, self.quotes) for n in (self.schema, spec.name) if n)
        return self.tables.get(spec.name, quoted)

    def _options(self, spec: TableSpec) -> dict[str, str]:
        return self.base | {
            "dbtable": self._from(spec),
            "quotes": self.quotes,
            "fetchsize": str(spec.fetch_size),
        }

    def columns(self, spec: TableSpec) -> list[tuple[str, str]]:
        """Ordered columns with the source's own type names."""
        found = [(r["column_name"], r["data_type"]) for r in self._listed() if r["table_id"] == spec.name]
        if not found:
            raise LookupError(f"source table {self.schema}.{spec.name} not found")
        return found

    def _listed(self) -> list[dict[str, Any]]:
        """The schema's columns, one row each; the connection's own database where none is named."""
        connection = Connection(self.base)
        place = f"table_schema = {connection.mark}" if self.schema else "table_schema = DATABASE()"
        sql = (
            "SELECT table_name, ordinal_position, column_name, data_type "
            f"FROM information_schema.columns WHERE {place} ORDER BY table_name, ordinal_position"
        )
        names = ("table_id", "ordinal", "column_name", "data_type")
        return [dict(zip(names, row)) for row in connection.rows(sql, [self.schema] if self.schema else [])]

    def catalog(self) -> DataFrame:
        """Columns of all tables of the schema with the source's own types, in one query."""
        kinds = "table_id string, ordinal int, column_name string, data_type string"
        return self.spark.createDataFrame([tuple(r.values()) for r in self._listed()], kinds)

    def spark_schema(self, spec: TableSpec) -> str:
        if spec.name in self.types:
            return self.types[spec.name]
        return ", ".join(
            f"`{name}` {SQL_TYPES.get(kind.lower().partition('(')[0].strip(), 'string')}"
            for name, kind in self.columns(spec)
        )

    def read(self, spec: TableSpec) -> DataFrame:
        reader = self.spark.read.format(FORMAT).options(**self._options(spec))
        return reader.schema(self.spark_schema(spec)).load()

    def probe(self, spec: TableSpec) -> tuple[int, Any, Any]:
        """Computed by the source: one row comes back."""
        column = _quoted(spec.range_column, self.quotes) if spec.range_column else "NULL"
        sql = f"SELECT COUNT(*), MIN({column}), MAX({column}) FROM {self._from(spec)}"
        return tuple(Connection(self.base).rows(sql)[0])

    def read_ranges(self, spec: TableSpec, lower: Any, upper: Any) -> DataFrame:
        if isinstance(lower, date):  # strides are whole numbers
            return self.read(spec)
        lower, upper = math.floor(lower), math.ceil(upper)
        options = self._options(spec) | {
            "partitioncolumn": spec.range_column,
            "lowerbound": str(lower),
            "upperbound": str(upper),
            "numpartitions": str(spec.num_partitions or s.DEFAULT_PARTITIONS),
        }
        reader = self.spark.read.format(FORMAT).options(**options)
        return reader.schema(self.spark_schema(spec)).load()

    def read_split(self, spec: TableSpec, rows: int) -> DataFrame:
        options = self._options(spec) | {
            "splitcolumns": json.dumps(spec.split_columns),
            "rows": str(rows),
            "numpartitions": str(spec.parts(rows)),
        }
        reader = self.spark.read.format(FORMAT).options(**options)
        return reader.schema(self.spark_schema(spec)).load()

    def read_keys(self, spec: TableSpec, keys: DataFrame) -> DataFrame:
        """Rows by key: every task looks its own keys up in the source, in batches."""
        schema = StructType.fromDDL(self.spark_schema(spec))
        table = _Table(self._options(spec), schema)
        names = [table.name(k) for k in spec.keys]

        def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mark = Connection(table.options).mark
            one = "(" + " AND ".join(f"{n} = {mark}" for n in names) + ")"
            for batch in batches:
                rows = [tuple(r.values()) for r in batch.to_pylist()]
                for start in range(0, len(rows), LOOKUP_CHUNK):
                    part = rows[start : start + LOOKUP_CHUNK]
                    condition = "(" + " OR ".join([one] * len(part)) + ")"
                    if len(names) == 1:
                        condition = f"{names[0]} IN ({', '.join([mark] * len(part))})"
                    yield from table.arrow([condition], [v for row in part for v in row])

        wanted = keys.select(*spec.keys).distinct()
        return wanted.mapInArrow(lookup, schema)

    def changelog(self, spec: TableSpec, start: int = -1) -> DataFrame:
        """A stream of the log table's ``(lsn, data)`` lines."""
        reader = self.spark.readStream.format(FORMAT).options(**self._options(spec))
        return reader.option("startoffset", str(start)).schema("lsn bigint, data string").load()


__all__ = ["FORMAT", "DbApiDataSource", "DbApiSource", "range_conditions", "register"]
