"""Parts of equal size of a source table, by any key the source can order.

The source numbers its rows in key order and returns the keys at the parts' ends; over a
primary key that is a walk of its index. Conditions between these ends are disjoint and
complete whatever the columns' types, one column or several, and however uneven the values
lie. Order and comparison are both the source's own, so its collation does not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_PART = 250_000
#: Each part is a query of its own in the source.
MOST_PARTS = 512

#: A value as it stands in a condition: its text, and the parameters the text needs.
Bind = Callable[[Any], tuple[str, list[Any]]]
Condition = tuple[str, list[Any]]


def parts_for(rows: int, least: int) -> int:
    return max(least, min(MOST_PARTS, ceil(rows / ROWS_PER_PART)))


def ends_sql(columns: Sequence[str], table: str, rows: int, parts: int) -> str | None:
    """SQL for the keys of the last row of every part but the last; columns are quoted names."""
    numbers = sorted({rows * i // parts for i in range(1, parts)} - {0})
    if not numbers:
        return None
    names = ", ".join(columns)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (
        f"SELECT {names} FROM (SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) AS row_no "
        f"FROM {table} WHERE {whole}) numbered "
        f"WHERE row_no IN ({', '.join(map(str, numbers))}) ORDER BY row_no"
    )


def _compared(columns: Sequence[str], end: Sequence[Any], sign: str, bind: Bind) -> Condition:
    """The key as a whole above (``>``), from (``>=``) or up to (``<=``) an end."""
    strict = sign[0]
    options, parameters = [], []
    for i, column in enumerate(columns):
        texts = []
        for c, v in zip(columns[:i], end[:i]):
            text, values = bind(v)
            texts.append(f"{c} = {text}")
            parameters += values
        text, values = bind(end[i])
        texts.append(f"{column} {sign if i + 1 == len(columns) else strict} {text}")
        parameters += values
        options.append(" AND ".join(texts))
    return "(" + " OR ".join(f"({o})" for o in options) + ")", parameters


def key_spans(keys: DataFrame, columns: Sequence[str], spans: int) -> list[tuple[tuple, tuple]]:
    """Least and greatest key of at most ``spans`` runs of the sorted keys, one row a run.

    Few keys are spans of one key each, many are runs between which keys are missing. A
    range shuffle makes the runs, so the keys themselves never come to the driver.
    """
    key = F.struct(*columns)
    runs = (
        keys.repartitionByRange(spans, *columns)
        .groupBy(F.spark_partition_id().alias("_run"))
        .agg(F.min(key).alias("low"), F.max(key).alias("high"))
    )
    return [(tuple(r["low"]), tuple(r["high"])) for r in runs.collect()]


def span_condition(
    columns: Sequence[str], ordered: Sequence[str], low: Sequence[Any], high: Sequence[Any], bind: Bind
) -> Condition:
    """Keys from ``low`` to ``high``; ``ordered`` are the columns in the order of the keys' bytes."""
    if low == high:
        texts, parameters = [], []
        for column, value in zip(columns, low):
            text, values = bind(value)
            texts.append(f"{column} = {text}")
            parameters += values
        return "(" + " AND ".join(texts) + ")", parameters
    below, b = _compared(ordered, high, "<=", bind)
    above, a = _compared(ordered, low, ">=", bind)
    return f"({above} AND {below})", [*a, *b]


def conditions(columns: Sequence[str], ends: Sequence[Sequence[Any]], bind: Bind) -> list[Condition]:
    """One condition for each part; rows with a NULL in the key are in the first."""
    ends = [tuple(e) for e in ends]
    ends = [e for i, e in enumerate(ends) if i == 0 or e != ends[i - 1]]
    if not ends:
        return [("", [])]
    nulls = " OR ".join(f"{c} IS NULL" for c in columns)
    text, values = _compared(columns, ends[0], "<=", bind)
    found = [(f"({text} OR {nulls})", values)]
    for low, high in zip(ends, ends[1:]):
        above, a = _compared(columns, low, ">", bind)
        below, b = _compared(columns, high, "<=", bind)
        found.append((f"{above} AND {below}", [*a, *b]))
    found.append(_compared(columns, ends[-1], ">", bind))
    return found
