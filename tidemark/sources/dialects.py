"""Source dialects: driver names, JDBC addresses and quoting."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dialect:
    name: str
    drivers: tuple[str, ...]
    jdbc_driver: str
    url: str  # with %s for host, port and database
    quote: tuple[str, str]
    schema: str | None  # where tables are that no schema is named for
    binary: str  # a binary literal, with %s for its hexadecimal digits
    bytewise: str  # a text column, for %s, in the order of its bytes
    booleans: tuple[str, str] = ("0", "1")
    escapes: bool = False  # whether a backslash in a text literal needs one before it

    def jdbc_url(self, host: str, port: int, database: str) -> str:
        return self.url % (host, port, database)

    def quoted(self, *names: str) -> str:
        left, right = self.quote
        return ".".join(left + n.replace(right, right * 2) + right for n in names)

    def literal(self, value: Any) -> str:
        """A value as SQL text; the source casts texts to what they are compared with."""
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return self.booleans[value]
        if isinstance(value, (int, float, Decimal)):
            return str(value)
        if isinstance(value, (bytes, bytearray)):
            return self.binary % bytes(value).hex()
        text = str(value).replace("'", "''")
        return "'" + (text.replace("\\", "\\\\") if self.escapes else text) + "'"


# The DB-API drivers a source may name, by dialect.
DIALECTS = (
    Dialect(
        "postgresql",
        ("psycopg2",),
        "org.postgresql.Driver",
        "jdbc:postgresql://%s:%d/%s?sslmode=require",
        ('"', '"'),
        "public",
        "'\\x%s'::bytea",
        'CAST(%s AS text) COLLATE "C"',
        ("FALSE", "TRUE"),
    ),
    Dialect(
        "sqlserver",
        ("pymssql", "mssql"),
        "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        "jdbc:sqlserver://%s:%d;databaseName=%s",
        ("[", "]"),
        "dbo",
        "0x%s",
        "CAST(%s AS nvarchar(4000)) COLLATE Latin1_General_100_BIN2_UTF8",
    ),
    Dialect(
        "mysql",
        ("pymysql", "mysql"),
        "com.mysql.cj.jdbc.Driver",
        "jdbc:mysql://%s:%d/%s",
        ("`", "`"),
        None,
        "x'%s'",
        "CAST(%s AS BINARY)",
        ("FALSE", "TRUE"),
        escapes=True,
    ),
)


def dialect_of(driver: str) -> Dialect:
    for dialect in DIALECTS:
        if driver in dialect.drivers:
            return dialect
    raise ValueError(f"unknown driver {driver!r}")


def dialect_of_module(module: str) -> Dialect | None:
    """Dialect of a DB-API driver's module; None where it is of no known one."""
    root = module.partition(":")[0].partition(".")[0]
    return next((d for d in DIALECTS if root in d.drivers), None)


def source_addresses(databases: DataFrame) -> DataFrame:
    """Dialect and JDBC address of every ``(database_id, driver, host, port, source_db_name)``.

    An unknown driver gives no address and an error text, so one bad row does not
    stop the others.
    """

    def by_driver(value) -> Column:
        column = F.lit(None).cast("string")
        for dialect in DIALECTS:
            column = F.when(F.col("driver").isin(*dialect.drivers), value(dialect)).otherwise(column)
        return column

    url = by_driver(lambda d: F.format_string(d.url, "host", "port", "source_db_name"))
    dialect = by_driver(lambda d: F.lit(d.name))
    error = F.concat(F.lit("unknown driver "), F.coalesce("driver", F.lit("none")))
    return databases.select(
        "database_id",
        dialect.alias("dialect"),
        url.alias("url"),
        F.when(dialect.isNull(), error).alias("error"),
    )
