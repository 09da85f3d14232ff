"""Small Column expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampType

STATUS_LENGTH = 500


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _literal_text(value: Any) -> str:
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        return value.isoformat(sep=" ")
    return str(value)


def watermark_value(column: str, data_type: DataType) -> Column:
    """A watermark as a plain UTC time, whatever the zones of the session and of Python."""
    value = F.col(column)
    if isinstance(data_type, TimestampType):
        zone = F.current_timezone()
        return F.convert_timezone(zone, F.lit("UTC"), value.cast("timestamp_ntz"))
    return value.cast("timestamp_ntz") if isinstance(data_type, DateType) else value


def typed_literal(value: Any, data_type: DataType | str) -> Column:
    """A literal of a given type, independent of the session or Python time zone.

    A time without a zone is UTC where the type has one.
    """
    if isinstance(value, (bytes, bytearray)):
        return F.lit(bytearray(value)).cast(data_type)
    text = None if value is None else _literal_text(value)
    if isinstance(value, datetime) and isinstance(data_type, TimestampType):
        text += "+00:00"
    return F.lit(text).cast(data_type)


def ntz(value: datetime | str | None) -> Column:
    """A zone-less timestamp literal."""
    return typed_literal(value, "timestamp_ntz")


def any_null(columns: Sequence[str]) -> Column:
    """True where at least one of the named columns is NULL."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def key_list(text: str | Sequence[str] | None) -> list[str]:
    """Key columns from a list or from a comma-separated registry entry."""
    if not text:
        return []
    parts = text.split(",") if isinstance(text, str) else text
    return [p.strip() for p in parts if p.strip()]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket number of a key; NULL key parts are allowed.

    The hash is the one ``repartition`` uses. So when the number of partitions is
    a multiple of ``buckets``, a partition by the same keys holds one bucket only.
    """
    return F.pmod(F.hash(*keys), F.lit(buckets)).cast("int")


def lsn_bytes(lsn: Column | str) -> Column:
    """Byte position of a ``HIGH/LOW`` hexadecimal log position."""
    parts = F.split(_as_column(lsn), "/")
    high = F.conv(parts[0], 16, 10).cast("bigint")
    low = F.conv(parts[1], 16, 10).cast("bigint")
    return F.shiftleft(high, 32) + low


def throughput(rows: Column | str, seconds: Column | str) -> Column:
    """Whole rows per second, 0 when either input is not positive."""
    rows, seconds = _as_column(rows), _as_column(seconds)
    rate = F.floor(rows / seconds).cast("bigint")
    return F.when((rows > 0) & (seconds > 0), rate).otherwise(F.lit(0).cast("bigint"))


def run_status(error: Column | str) -> Column:
    """``success``, or the error text behind ``error: ``, cut to what the log column holds."""
    error = _as_column(error)
    return F.when(error.isNull(), F.lit("success")).otherwise(
        F.substring(F.concat(F.lit("error: "), error), 1, STATUS_LENGTH)
    )


def is_error(status: Column | str) -> Column:
    return _as_column(status).startswith("error")


def cut_text(text: Column | str, width: int) -> Column:
    """Text of at most ``width`` characters, marked with ``...`` when it was longer."""
    text = _as_column(text)
    return F.when(
        F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))
    ).otherwise(text)
