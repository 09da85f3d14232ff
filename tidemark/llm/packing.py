"""Best-fit packing of documents into bins of fixed size, with conflicts.

Two pieces conflict, and never share a bin, if they have the same source or belong to
the same duplicate cluster. Bins are kept in the order of their residual space and carry
bitmaps of the sources and clusters they hold; for a piece the search starts at the
smallest residual that holds it and goes on to the successor until a bin is compatible:
that is the tightest one.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_value, cut, text_of
from tidemark.llm.exact_dedup import normalised

by_value(__name__)

#: Characters in a bin.
CAPACITY = 8_192
#: Pieces that are packed together on average.
SHARD = 4_096


def best_fit(
    sizes: Iterable[int], sources: Iterable[object], clusters: Iterable[object], capacity: int
) -> list[int]:
    """Bin number of each piece, in the order given; no size exceeds the capacity.

    A None source or cluster conflicts with nothing.
    """
    bits: dict[tuple[str, object], int] = {}

    def bit(kind: str, value: object) -> int:
        return 0 if value is None else 1 << bits.setdefault((kind, value), len(bits))

    residuals: list[tuple[int, int]] = []  # (space left, bin), ascending
    held: list[int] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        mask = bit("source", source) | bit("cluster", cluster)
        at = bisect_left(residuals, (size, -1))
        while at < len(residuals) and held[residuals[at][1]] & mask:
            at += 1
        if at < len(residuals):
            space, bin_ = residuals.pop(at)
        else:
            space, bin_ = capacity, len(held)
            held.append(0)
        held[bin_] |= mask
        insort(residuals, (space - size, bin_))
        placed.append(bin_)
    return placed


def pieces(docs: DataFrame, id_col: str, text_col: str, source_col: str, cluster: Column | None, capacity: int):
    """Each text cut into pieces of at most ``capacity`` characters; an empty text is one of 0."""
    text = text_of(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.when(F.length(text) > 0, F.xxhash64(normalised(F.col(text_col))) if cluster is None else cluster)
        .cast("string")
        .alias("cluster"),
        F.length(text).alias("_chars"),
    )
    last = F.greatest(F.ceil(F.col("_chars") / capacity).cast("int") - 1, F.lit(0))
    start = F.col("piece").cast("bigint") * capacity
    return rows.withColumn("piece", F.explode(F.sequence(F.lit(0), last))).select(
        "doc_id",
        "source",
        "cluster",
        "piece",
        start.alias("start"),
        F.least(F.lit(capacity).cast("bigint"), F.col("_chars") - start).alias("size"),
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    shard: int = SHARD,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, size, source, cluster and bin_id.

    Texts longer than a bin are cut into full pieces and a rest; nothing is dropped.
    ``cluster`` names the duplicate cluster, by default a hash of the text without white
    space, so that copies conflict. NULL and empty texts are one piece of size 0 in no
    cluster; a NULL source conflicts with nothing. Rows that repeat are pieces of their
    own. An empty table gives an empty result.

    Pieces are spread at random over as many groups as their number asks for, and each
    group is packed by best fit, largest first. A source or cluster of any size spreads
    likewise, and a task holds a few numbers for each of some thousand pieces.
    """
    rows = cut(pieces(docs, id_col, text_col, source_col, cluster, capacity))
    groups = max(1, -(-rows.count() // shard))
    spread = F.xxhash64("doc_id", "piece", "cluster", F.monotonically_increasing_id())
    rows = rows.withColumn("_group", F.pmod(spread, F.lit(groups)))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    names = ["doc_id", "piece", "start", "size", "source", "cluster"]

    def run(rows: pa.Table) -> pa.Table:
        columns = {n: rows.column(n).to_pylist() for n in names}
        size, doc, piece = columns["size"], columns["doc_id"], columns["piece"]
        ids = [(1,) if d is None else (0, d) for d in doc]
        order = sorted(range(rows.num_rows), key=lambda i: (-size[i], ids[i], piece[i]))
        sorted_ = {n: [column[i] for i in order] for n, column in columns.items()}
        bins = best_fit(sorted_["size"], sorted_["source"], sorted_["cluster"], capacity)
        first = rows.column("_group")[0].as_py() << 24
        found = rows.select(names).take(order)
        return found.append_column("bin_id", pa.array([first + b for b in bins], pa.int64()))

    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", bin_id bigint"
    return rows.groupBy("_group").applyInArrow(run, schema)
