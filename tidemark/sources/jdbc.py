"""Source tables over JDBC.

Spark pushes the watermark filter and the column choice into the source's SQL, and
the source answers counts and bounds. Range reads use Spark's own partitioned read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from math import ceil, floor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark import schemas as s
from tidemark.functions import any_null
from tidemark.operators.merge import rows_by_keys
from tidemark.sources.dialects import Dialect, dialect_of
from tidemark.sources.scans import TableSpec, source_columns
from tidemark.sources.splits import conditions, ends_sql, key_spans, span_condition

#: Runs of keys that a lookup asks the source for.
SPANS = 256


def read_options(
    dialect: Dialect, url: str, schema: str | None, spec: TableSpec
) -> dict[str, str]:
    """Options of a plain read of one table."""
    table = dialect.quoted(schema, spec.name) if schema else dialect.quoted(spec.name)
    return {
        "url": url,
        "driver": dialect.jdbc_driver,
        "dbtable": table,
        "fetchsize": str(spec.fetch_size),
        "preferTimestampNTZ": "true",
        "pushDownPredicate": "true",
    }


def probe_query(dialect: Dialect, table: str, column: str | None) -> str:
    """SQL for a table's row count and the bounds of one column."""
    name = dialect.quoted(column) if column else "NULL"
    return f"SELECT COUNT(*) AS cnt, MIN({name}) AS lo, MAX({name}) AS hi FROM {table}"


def range_options(spec: TableSpec, lower: Any, upper: Any) -> dict[str, str]:
    """Further options of a range read."""
    if not spec.range_column:
        raise ValueError(f"{spec.name}: a range read needs a partition column or a key")
    if isinstance(lower, (float, Decimal)) or isinstance(upper, (float, Decimal)):
        lower, upper = floor(lower), ceil(upper)  # numeric bounds are read as whole numbers
    return {
        "partitionColumn": spec.range_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(spec.num_partitions or s.DEFAULT_PARTITIONS),
    }


def span_predicates(
    dialect: Dialect, keys: Sequence[str], spans: Sequence[tuple], texts: Sequence[bool], parts: int
) -> list[str]:
    """Predicates that hold the spans of keys, dealt out to at most ``parts`` queries.

    ``texts`` says which keys are texts: their spans follow the bytes, as Spark's order does.
    """
    columns = [dialect.quoted(k) for k in keys]
    ordered = [dialect.bytewise % c if text else c for c, text in zip(columns, texts)]
    found = [
        span_condition(columns, ordered, low, high, lambda v: (dialect.literal(v), []))[0]
        for low, high in spans
    ]
    return [" OR ".join(found[i::parts]) for i in range(min(parts, len(found)))]


class JdbcSource:
    one_snapshot = False  # every part is a query of its own

    def __init__(
        self,
        spark: SparkSession,
        driver: str,
        host: str,
        port: int,
        database: str,
        schema: str | None = None,
        options: Mapping[str, str] | None = None,
    ) -> None:
        self.dialect = dialect_of(driver)
        self.spark, self.schema = spark, schema or self.dialect.schema or database
        self.url = self.dialect.jdbc_url(host, port, database)
        self.options = dict(options or {})

    def _options(self, spec: TableSpec) -> dict[str, str]:
        return read_options(self.dialect, self.url, self.schema, spec) | self.options

    def read(self, spec: TableSpec) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self._options(spec)).load()

    def read_ranges(self, spec: TableSpec, lower: Any, upper: Any) -> DataFrame:
        options = self._options(spec) | range_options(spec, lower, upper)
        return self.spark.read.format("jdbc").options(**options).load()

    def read_split(self, spec: TableSpec, rows: int) -> DataFrame:
        """Parts of equal size; the source says where they end, one row a part."""
        options = self._options(spec)
        table = options.pop("dbtable")
        columns = [self.dialect.quoted(c) for c in spec.split_columns]
        query = ends_sql(columns, table, rows, spec.parts(rows))
        if not query:
            return self.read(spec)
        ends = self.spark.read.format("jdbc").options(**options, query=query).load().collect()
        predicates = [text for text, _ in conditions(columns, ends, lambda v: (self.dialect.literal(v), []))]
        return self.spark.read.jdbc(
            options.pop("url"), table, predicates=predicates, properties=options
        )

    def read_keys(self, spec: TableSpec, keys: DataFrame) -> DataFrame:
        """The source returns the runs the keys lie in; a semi-join leaves the keys themselves.

        One way at every number of keys: the driver sees ``SPANS`` runs at most.
        """
        wanted = keys.select(*spec.keys).filter(~any_null(spec.keys)).distinct()
        spans = key_spans(wanted, spec.keys, SPANS)
        if not spans:
            return self.read(spec).limit(0)
        texts = [isinstance(wanted.schema[k].dataType, StringType) for k in spec.keys]
        options = self._options(spec)
        read = self.spark.read.jdbc(
            options.pop("url"),
            options.pop("dbtable"),
            predicates=span_predicates(self.dialect, spec.keys, spans, texts, spec.parts(0)),
            properties=options,
        )
        return rows_by_keys(read, wanted, spec.keys)

    def probe(self, spec: TableSpec) -> tuple[int, Any, Any]:
        """Computed by the source: one row comes back."""
        options = self._options(spec)
        options["query"] = probe_query(self.dialect, options.pop("dbtable"), spec.range_column)
        return tuple(self.spark.read.format("jdbc").options(**options).load().first())

    def catalog(self) -> DataFrame:
        """Columns of all tables of the schema with the source's own types, in one query."""
        options = {k: v for k, v in self._options(TableSpec.of("")).items() if k != "dbtable"}
        options["query"] = (
            "SELECT table_schema, table_name, ordinal_position, column_name, data_type "
            "FROM information_schema.columns"
        )
        found = self.spark.read.format("jdbc").options(**options).load()
        return source_columns(found.toDF(*[c.lower() for c in found.columns]), self.schema)

    def columns(self, spec: TableSpec) -> list[tuple[str, str]]:
        """Ordered columns with the source's own type names."""
        mine = self.catalog().filter(F.col("table_id") == spec.name)
        found = [(r["column_name"], r["data_type"]) for r in mine.orderBy("ordinal").collect()]
        if not found:
            raise LookupError(f"source table {self.schema}.{spec.name} not found")
        return found
