"""Shaping of a decoded change log: one text line per change, ordered by ``lsn``.

A line reads ``table <schema>.<table>: <ACTION>: <column>[<type>]:<value> ...``.
Text values are quoted with ``'`` and may contain anything, look-alike lines
included, so every pattern below walks the line from its start over whole
``column[type]:value`` fields. The loops are possessive: the regex engine then
runs them without recursion or backtracking, however long a value is.

An update that changes the key carries ``old-key: ... new-tuple: ...``. It is
read as a delete of the old key and an upsert of the new one.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemark.functions import any_null, cut_text

INSERT, UPDATE, DELETE = "I", "U", "D"
OTHER = "?"  # a line of the table that is no row change
POLICIES = ("last_change", "delete_wins")

_NAME = r'(?:"[^"]*+"|[^ .:"\[]++)'
_TYPE = r"\[[^\[\]]*+(?:\[\])*+\]"
_VALUE = r"(?:B?'[^']*+(?:''[^']*+)*+'|[^ ']++)"
_FIELD = rf"{_NAME}{_TYPE}:{_VALUE} "
_TABLE = rf"(?s)^table {_NAME}\.{_NAME}: "
_HEAD = rf"{_TABLE}(?:INSERT|UPDATE|DELETE): "
_OLD = "old-key: "
_NEW = rf"(?:old-key: (?:{_FIELD})*+new-tuple: )?+"


def _printed(name: str) -> str:
    """An identifier as the log prints it: quoted unless plain lower case."""
    return name if re.fullmatch(r"[a-z_][a-z0-9_$]*", name) else f'"{name}"'


def relation(schema: str, table: str) -> str:
    """A table's name as the log prints it."""
    return f"{_printed(schema)}.{_printed(table)}"


def by_relation(lines: DataFrame, relations: Sequence[str]) -> DataFrame:
    """Lines of the named tables with the table in ``relation``, also such as are no row change.

    Writing the result with ``partitionBy("relation")`` reads a log once for all
    of its tables, without a shuffle.
    """
    name = F.regexp_extract("data", rf"(?s)^table ({_NAME}\.{_NAME}): ", 1)
    return lines.withColumn("relation", name).filter(F.col("relation").isin(list(relations)))


def filter_table(lines: DataFrame, schema: str, table: str) -> DataFrame:
    """Lines of exactly one table. A prefix test, so the parquet scan can use it."""
    return lines.filter(F.col("data").startswith(f"table {relation(schema, table)}: "))


def parse_action(lines: DataFrame) -> DataFrame:
    """Add ``op`` (I, U or D); lines that are no row change are dropped."""
    word = F.regexp_extract("data", rf"{_TABLE}(INSERT|UPDATE|DELETE): ", 1)
    return lines.withColumn("op", F.substring(word, 1, 1)).filter(F.col("op") != "")


def _raw_field(name: str, lead: str) -> Column:
    """Printed value of one column, found field by field behind ``lead``; '' if absent."""
    column = rf"\Q{_printed(name)}\E"
    skipped = rf"(?:(?!{column}\[){_FIELD})*+"
    return F.regexp_extract(
        "data", rf"{_HEAD}{lead}{skipped}{column}{_TYPE}:({_VALUE})(?: |$)", 1
    )


def _typed(raw: Column, key_type: DataType | str) -> Column:
    """A printed value unquoted and cast; NULL when absent, null or not castable."""
    inside = F.replace(F.regexp_replace(raw, r"^B?'|'$", ""), F.lit("''"), F.lit("'"))
    text = F.when(raw.endswith("'"), inside).when((raw != "") & (raw != "null"), raw)
    return text.try_cast(key_type)


def parse_keys(lines: DataFrame, keys: Mapping[str, DataType | str]) -> DataFrame:
    """Add every key column (name to type) and ``old_key``, set when the key changed."""
    # A cheap test first: the pattern runs only on lines that may hold an old key.
    is_key_change = (F.col("op") == UPDATE) & F.col("data").contains(_OLD)
    raw = lines.withColumns(
        {f"_new_{k}": _raw_field(k, _NEW) for k in keys}
        | {f"_old_{k}": F.when(is_key_change, _raw_field(k, _OLD)) for k in keys}
    )
    typed = raw.withColumns(
        {k: _typed(F.col(f"_new_{k}"), t) for k, t in keys.items()}
        | {f"_old_{k}": _typed(F.col(f"_old_{k}"), t) for k, t in keys.items()}
    )
    old = F.struct(*[F.col(f"_old_{k}").alias(k) for k in keys])
    changed = ~any_null([f"_old_{k}" for k in keys]) & ~old.eqNullSafe(
        F.struct(*[F.col(k) for k in keys])
    )
    return typed.withColumn("old_key", F.when(changed, old)).drop(
        *[f"_{side}_{k}" for side in ("new", "old") for k in keys]
    )


def split_key_changes(parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per touched key: a key change becomes D (old key) and U (new key)."""
    new = F.struct("op", *keys)
    old = F.struct(F.lit(DELETE).alias("op"), *[F.col(f"old_key.{k}").alias(k) for k in keys])
    rows = F.when(F.col("old_key").isNotNull(), F.array(old, new)).otherwise(F.array(new))
    others = [c for c in parsed.columns if c not in {"op", "old_key", *keys}]
    return parsed.select(*others, F.inline(rows))


def parse_changes(
    lines: DataFrame, schema: str, table: str, keys: Mapping[str, DataType | str], others: bool = False
) -> DataFrame:
    """Log lines to ``(lsn, op, key columns)`` for one table.

    A line whose key cannot be read keeps NULL key parts: see ``rejected_changes``.
    The action stands right behind the table's name, whose length is known here.
    With ``others``, lines that are no row change stay as well, as ``OTHER``.
    """
    head = len(f"table {relation(schema, table)}: ")
    known, action = known_action(schema, table), F.substring("data", head + 1, 1)
    mine = filter_table(lines, schema, table)
    if others:
        acted = mine.withColumn("op", F.when(known, action).otherwise(OTHER))
    else:
        acted = mine.filter(known).withColumn("op", action)
    parsed = parse_keys(acted, keys)
    return split_key_changes(parsed, list(keys)).select("lsn", "op", *keys)


def known_action(schema: str, table: str) -> Column:
    """Whether a line of the table is a row change."""
    head = len(f"table {relation(schema, table)}: ")
    return F.substring("data", head + 1, 8).isin("INSERT: ", "UPDATE: ", "DELETE: ")


def rejected_lines(
    lines: DataFrame, schema: str, table: str, keys: Mapping[str, DataType | str]
) -> DataFrame:
    """``(lsn, data, reason)`` of a table's lines that cannot be applied as they are."""
    acted = (
        filter_table(lines, schema, table)
        .withColumn("_known", known_action(schema, table))
        .withColumn("op", F.substring("data", len(f"table {relation(schema, table)}: ") + 1, 1))
    )
    unread = F.concat_ws(", ", *[F.when(F.col(k).isNull(), k) for k in keys])
    reason = F.when(~F.col("_known"), F.lit("not a row change")).otherwise(
        F.concat(F.lit("no readable key: "), unread)
    )
    parsed = parse_keys(acted, keys).filter(~F.col("_known") | any_null(list(keys)))
    return parsed.select("lsn", "data", reason.alias("reason"))


def rejected_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes without a readable key. Flows count them instead of losing them silently."""
    return changes.filter(any_null(keys))


def split_changes(changes: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Upserted and deleted keys, NULL keys dropped, in log order of no significance."""
    keyed = changes.filter(~any_null(keys))
    return keyed.filter(F.col("op") != DELETE), keyed.filter(F.col("op") == DELETE)


def net_changes(
    changes: DataFrame, keys: Sequence[str], policy: str = "last_change", with_rejects: bool = False
) -> DataFrame:
    """One row per key: ``op`` that decides, and ``lsn`` of its last change.

    ``last_change`` lets the highest ``lsn`` decide; ``delete_wins`` deletes every
    key that has a delete anywhere in the batch (all upserts run before all
    deletes). Where one ``lsn`` holds both, the upsert decides.

    Three maxima over a long are all the state there is, so Spark uses a hash
    aggregate with a map-side partial step: a key with a third of the log
    reaches the shuffle as one row per map task. ``with_rejects`` keeps changes
    without a whole key, as one row for each such key with the numbers of its
    ``lines`` and of its ``others``; see ``reject_counts``.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}, expected one of {POLICIES}")

    def last(op: str) -> Column:
        return F.max(F.when(F.col("op") == op, F.col("lsn")))

    counts = []
    if with_rejects:
        counts = [F.count("*").alias("lines"), F.count_if(F.col("op") == OTHER).alias("others")]
    else:
        changes = changes.filter(~any_null(keys))
    grouped = changes.groupBy(*keys).agg(
        last(INSERT).alias("_i"), last(UPDATE).alias("_u"), last(DELETE).alias("_d"), *counts
    )
    i, u, d = F.col("_i"), F.col("_u"), F.col("_d")
    upserted = F.coalesce(F.greatest(i, u), u, i)
    if policy == "delete_wins":
        deleted = d.isNotNull()
    else:
        deleted = d.isNotNull() & (upserted.isNull() | (d > upserted))
    updated = u.isNotNull() & (i.isNull() | (u >= i))
    op = F.when(deleted, DELETE).when(updated, UPDATE).otherwise(INSERT)
    counted = ["lines", "others"] if with_rejects else []
    return grouped.select(*keys, F.greatest(i, u, d).alias("lsn"), op.alias("op"), *counted)


def reject_counts(net: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Of net changes with rejects: changes without a readable key, and lines of another kind."""
    row = net.filter(any_null(keys)).agg(
        F.coalesce(F.sum(F.col("lines") - F.col("others")), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum("others"), F.lit(0)).alias("others"),
    ).first()
    return row["rejected"], row["others"]


def change_counts(net: DataFrame) -> DataFrame:
    """Distinct upserted and deleted keys with the mode text, as one row."""
    counted = net.agg(
        F.count_if(F.col("op") != DELETE).alias("upserts"),
        F.count_if(F.col("op") == DELETE).alias("deletes"),
    )
    text = F.format_string("WAL (%d upserts, %d deletes)", "upserts", "deletes")
    none = (F.col("upserts") + F.col("deletes")) == 0
    return counted.withColumn("mode", F.when(none, "WAL (no changes)").otherwise(text))


def preview(
    lines: DataFrame, schema: str, table: str, peek: int = 100, show: int = 10, width: int = 100
) -> DataFrame:
    """First ``show`` lines of a table among the first ``peek`` of the log, and their number.

    The array holds ``peek`` short texts at most, as the top-``peek`` sort comes first.
    """
    peeked = lines.orderBy("lsn").limit(peek)
    texts = filter_table(peeked, schema, table).agg(
        F.sort_array(
            F.collect_list(F.struct("lsn", cut_text("data", width).alias("text")))
        ).alias("found")
    )
    return texts.select(
        F.size("found").alias("total_found"), F.inline(F.slice("found", 1, show))
    ).select("lsn", "text", "total_found")
