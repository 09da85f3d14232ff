"""Watermarks of any type that has an order, kept as a text with the type's name.

A time column in a control table holds only times. The text and type beside it hold
numbers, dates, texts and bytes too; comparing happens in the type, never as text.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

#: The types a watermark may have: name, Python type, to text, from text, and the columns it fits.
_KINDS = (
    ("timestamp_ntz", datetime, datetime.isoformat, datetime.fromisoformat, (TimestampNTZType, TimestampType, DateType)),
    ("date", date, date.isoformat, date.fromisoformat, (DateType,)),
    ("bigint", int, str, int, (NumericType,)),
    ("decimal", Decimal, str, Decimal, (NumericType,)),
    ("double", float, repr, float, (NumericType,)),
    ("string", str, str, str, (StringType,)),
    ("binary", (bytes, bytearray), lambda b: bytes(b).hex(), bytes.fromhex, (BinaryType,)),
)


def to_text(value: Any) -> tuple[str, str] | tuple[None, None]:
    """Text and type name; both None without a watermark."""
    for name, kind, text, _, _ in _KINDS:
        if isinstance(value, kind) and not isinstance(value, bool):
            return text(value), name
    if value is None:
        return None, None
    raise TypeError(f"a watermark cannot be a {type(value).__name__}")


def from_text(text: str | None, name: str | None) -> Any:
    """The value again; None without one."""
    if text is None:
        return None
    return next(parse for kind, _, _, parse, _ in _KINDS if kind == name)(text)


def stored(text: str | None, name: str | None, time: datetime | None) -> Any:
    """A table's watermark from its control row: the typed one, or the plain time of old rows."""
    return time if text is None else from_text(text, name)


def usable(value: Any, column: DataType) -> Any:
    """The watermark if it can be compared with the column; None, which reads all, if not.

    A column may have been replaced by another of a different type since the last run.
    """
    for _, kind, _, _, columns in _KINDS:
        if isinstance(value, kind):
            return value if isinstance(column, columns) else None
    return None
