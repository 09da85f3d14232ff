"""Column expressions shared by the operators."""

from tidemark.functions.exprs import (
    any_null,
    bucket_of,
    cut_text,
    is_error,
    key_list,
    lsn_bytes,
    ntz,
    run_status,
    throughput,
    typed_literal,
)

__all__ = [
    "any_null",
    "bucket_of",
    "cut_text",
    "is_error",
    "key_list",
    "lsn_bytes",
    "ntz",
    "run_status",
    "throughput",
    "typed_literal",
]
