"""Upsert, delete and change apply as pure DataFrame operators.

Each returns the whole new contents of a target, as anti-join plus union. Spark
shuffles or broadcasts the key side by its measured size. A broadcast key side
leaves the target unshuffled, and source rows go through no join.

``partitions`` asks for that many partitions by key instead, so that a write by
bucket can follow without a second shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import any_null, ntz
from tidemark.operators.wal import DELETE

LOADED_AT = "_LOADED_AT"


def add_load_timestamp(df: DataFrame, run_ts: datetime | str, name: str = LOADED_AT) -> DataFrame:
    return df.withColumn(name, ntz(run_ts))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts. NULL keys equal nothing."""
    return (
        df.filter(~any_null(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )


def has_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    return not duplicate_keys(df, keys).isEmpty()


def _by_key(df: DataFrame, keys: Sequence[str], partitions: int | None) -> DataFrame:
    return df.repartition(partitions, *keys) if partitions else df


def _without(
    target: DataFrame, doomed: DataFrame, keys: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Target rows whose key is not in ``doomed``; rows with NULL key parts all stay.

    NULL keys match nothing but hash alike, so in the join they would meet in one
    partition. They go around it: the second read of the target skips every row
    group without NULL keys by its statistics.
    """
    keyed = _by_key(target.filter(~any_null(keys)), keys, partitions)
    gone = _by_key(doomed.select(*keys).filter(~any_null(keys)), keys, partitions)
    kept = keyed.join(gone, list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(target.filter(any_null(keys)))


def _with(
    kept: DataFrame, rows: DataFrame, keys: Sequence[str], partitions: int | None
) -> DataFrame:
    """``kept`` and ``rows``; only rows with a whole key are partitioned by it."""
    if not partitions:
        return kept.unionByName(rows)
    keyed = _by_key(rows.filter(~any_null(keys)), keys, partitions)
    return kept.unionByName(keyed).unionByName(rows.filter(any_null(keys)))


def delete_by_keys(
    target: DataFrame, doomed: DataFrame, keys: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Target without the rows whose key is in ``doomed``."""
    return _without(target, doomed, keys, partitions)


def rows_by_keys(source: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current source rows whose key is in ``wanted``."""
    return source.join(wanted.select(*keys), list(keys), "left_semi").select(*source.columns)


def _shaped(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with the target's columns and types.

    Columns the target has kept after the source dropped them hold on to their
    values in matched rows, as an UPDATE of the source's columns would leave them.
    """
    have = {c.upper() for c in source.columns}
    unknown = have - {c.upper() for c in target.columns}
    if unknown:
        raise ValueError(f"columns missing from the target: {sorted(unknown)}; reload the table")
    kept = [c for c in target.columns if c.upper() not in have]
    if kept:
        old = target.filter(~any_null(keys)).select(*keys, *kept)
        source = source.join(old, list(keys), "left")
    return source.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """MERGE: matched rows take the source's values, others are inserted, the rest stays.

    Source keys must be unique (``has_duplicate_keys``). NULL keys match nothing
    and are inserted.
    """
    if not keys:
        raise ValueError("merge needs at least one key column")
    rows = _shaped(source, target, keys)
    return _with(_without(target, source, keys, partitions), rows, keys, partitions)


def apply_changes(
    target: DataFrame,
    source: DataFrame,
    net: DataFrame,
    keys: Sequence[str],
    policy: str = "last_change",
    partitions: int | None = None,
) -> DataFrame:
    """Apply net changes (``net_changes`` under the same policy) to a target.

    Upserted values are the current source rows, not the log image.
    ``last_change`` makes every touched key equal the source, so an upserted key
    that the source no longer has leaves the target as well. ``delete_wins``
    repeats a merge followed by a delete, which leaves such a key alone.
    """
    fetched = rows_by_keys(source, net.filter(F.col("op") != DELETE), keys)
    return apply_fetched(target, fetched, net, keys, policy, partitions)


def apply_fetched(
    target: DataFrame,
    fetched: DataFrame,
    net: DataFrame,
    keys: Sequence[str],
    policy: str = "last_change",
    partitions: int | None = None,
) -> DataFrame:
    """``apply_changes`` with the source rows of the upserted keys read already."""
    if policy == "delete_wins":
        dead = net.filter(F.col("op") == DELETE).select(*keys)
        replaced = dead.unionByName(fetched.select(*keys))
    else:
        replaced = net.select(*keys)
    rows = _shaped(fetched, target, keys)
    return _with(_without(target, replaced, keys, partitions), rows, keys, partitions)
