"""Helpers of the operators: cut lineage, size-checked broadcasts, code that travels with a job."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType

from tidemark.sources.scans import work_folder

#: A table of at most so many narrow rows (a few numbers each) may be broadcast.
BROADCAST_ROWS = 200_000


def by_value(module: str) -> None:
    """Send a module's functions to executors by value, so that they need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


#: Bytes of texts that a Python worker gets at a time.
BATCH_BYTES = 8 << 20


def by_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds, also of very long texts, unless the session is stricter."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark.conf.get(key).lower().rstrip("b")
    if not size.lstrip("-").isdigit() or not 0 < int(size) < BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The frame, written once to the shared checkpoint folder and read from there."""
    work_folder(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame) -> DataFrame:
    """A cut, narrow frame with a broadcast hint if it has few rows; else Spark shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: A table of at most so many bytes of values may be broadcast, whatever its columns hold.
BROADCAST_BYTES = 16 << 20


def measured(df: DataFrame) -> DataFrame:
    """A cut frame with a broadcast hint if its values take few bytes; else Spark shuffles."""

    def width(field: StructField) -> Column:
        if isinstance(field.dataType, (StringType, BinaryType)):
            return F.octet_length(field.name)
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            return F.octet_length(F.to_json(F.struct(field.name)))
        return F.lit(0)

    row = sum((F.coalesce(width(f), F.lit(0)) for f in df.schema.fields), F.lit(8 * len(df.columns)))
    return F.broadcast(df) if (df.agg(F.sum(row)).first()[0] or 0) <= BROADCAST_BYTES else df


def hash_sample(df: DataFrame, column: str, rows: int, total: int) -> list:
    """At most ``rows`` distinct values of the column, in the order of a hash.

    About twice as many of ``total`` rows lie below a cut of the hash. Each task sends
    only these, so what reaches the driver does not grow with the tasks or the copies.
    """
    hashed = F.xxhash64(column)
    share = 2 * rows / max(1, total)
    near = df if share >= 1 else df.where(hashed <= int((share - 0.5) * (1 << 64)))
    found = near.select(hashed.alias("_hash"), column).distinct().collect()
    return [r[1] for r in sorted(found, key=lambda r: r[0])[:rows]]


def text_of(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def text_key(text: Column) -> Column:
    """Tells rows of one id apart; with the id it names a row's content."""
    return F.xxhash64(text_of(text))


def fresh(name: str, columns: list[str]) -> str:
    """A column name that none of the given ones equals, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_rows(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows whose id and text key are in ``gone`` (a cut frame: _id, _key).

    Few rows to drop are broadcast, so that the texts stay where they are; many are
    joined by a shuffle.
    """
    gone = measured(gone.select("_id", "_key").distinct())
    same = docs[id_col].eqNullSafe(gone["_id"]) & (text_key(docs[text_col]) == gone["_key"])
    return docs.join(gone, same, "left_anti")
