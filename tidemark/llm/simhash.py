"""SimHash near-dedup: fingerprints, and a vantage-point tree over Hamming distance.

A vantage point divides the fingerprints into rings by their distance to it. Each level
of the tree measures the distance over one band of the bits, with a vantage of its own;
the rings on the way down name a shard. Two fingerprints that differ in at most ``r``
bits differ, by the triangle inequality, by at most ``r`` rings over all levels together
(the bands are disjoint), so a query visits its own shard and those few neighbours whose
ring numbers differ by at most ``r`` in sum. Everything else is pruned unseen. The pairs
are then checked bit by bit, so the links are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement, product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import components
from tidemark.llm.common import by_batches, by_value, cut, drop_rows, hash_sample, text_key, text_of

by_value(__name__)

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Shingles hashed at a time.
STEP = 1 << 16
#: Fingerprints looked at to choose vantage points; any choice gives the same links.
VANTAGE_SAMPLE = 2_000
#: Above so many distinct fingerprints the tree has 16 levels, below 8.
DEEP = 1 << 26


# --- fingerprints ---------------------------------------------------------------------


def _bits_of_bytes() -> np.ndarray:
    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text; zero if it has no word."""
    words = text.encode().lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    total, ones, table = len(words) - width + 1, np.zeros(64, np.int64), _bits_of_bytes()
    grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digests = map(xxhash.xxh64_intdigest, grams, repeat(SEED))
    for start in range(0, total, STEP):
        hashes = np.fromiter(digests, np.uint64, min(STEP, total - start))
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for i in range(8):
            ones[8 * i : 8 * i + 8] += np.bincount(octets[:, i], minlength=256) @ table
    majority = np.packbits(2 * ones > total, bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a bigint of the same bits."""

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            prints = (fingerprint(t.as_py(), shingle) for t in texts)
            yield pa.array(np.fromiter(prints, np.uint64, len(texts)).view(np.int64))

    return F.arrow_udf(each, "bigint")(text_of(text))


# --- vantage-point tree ---------------------------------------------------------------


def choose_vantage(sample: list[int], width: int) -> int:
    """One vantage per band of ``width`` bits: the sample's value whose rings are most even."""
    prints = np.array(sample or [0], np.int64).view(np.uint64)
    count, vantage = np.bitwise_count, 0
    for shift in range(0, 64, width):
        band = (prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        values = np.unique(band)
        crowding = [(np.bincount(count(band ^ v)).astype(float) ** 2).sum() for v in values]
        vantage |= int(values[int(np.argmin(crowding))]) << shift
    return vantage - (1 << 64) if vantage >> 63 else vantage


def _field(width: int) -> int:
    """Bits of a ring number, enough that a step off either end names no ring."""
    return (width + RADIUS).bit_length()


def shard(print_: Column, vantage: int, width: int) -> Column:
    """The rings on the way down the tree, packed into one number."""
    apart, parts = print_.bitwiseXOR(F.lit(vantage)), None
    for level in range(64 // width):
        mask = ((1 << width) - 1) << (level * width)
        mask -= (1 << 64) if mask >> 63 else 0
        ring = F.bit_count(apart.bitwiseAND(F.lit(mask))).cast("bigint")
        ring = F.shiftleft(ring, level * _field(width))
        parts = ring if parts is None else parts + ring
    return parts


def neighbour_steps(width: int, radius: int) -> list[int]:
    """What to add to a shard for those within ``radius`` rings; one of each pair x, -x, and 0."""
    levels, bits, steps = 64 // width, _field(width), {0}
    for size in range(1, radius + 1):
        for places in combinations_with_replacement(range(levels), size):
            for signs in product((1, -1), repeat=size):
                steps.add(sum(s << (p * bits) for s, p in zip(signs, places, strict=True)))
    return sorted(s for s in steps if s >= 0)


def links_between(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``a``, ``b`` of the distinct ``fp`` that differ in 1 to ``radius`` bits.

    Every fingerprint lies in one shard and asks there and in half of the neighbour
    shards (the other half asks it): 73 rows of two numbers each for radius 2. Shards
    meet their askers in an equi-join, which Spark splits where one is large.
    """
    if radius > RADIUS:
        raise ValueError(f"ring numbers leave room for a radius of {RADIUS} at most")
    count = prints.count()
    width = 8 if count <= DEEP else 4
    vantage = choose_vantage(hash_sample(prints, "fp", VANTAGE_SAMPLE, count), width)
    homes = prints.select(F.col("fp").alias("b"), shard(F.col("fp"), vantage, width).alias("shard"))
    steps = F.array(*(F.lit(s).cast("bigint") for s in neighbour_steps(width, radius)))
    askers = homes.select(F.col("b").alias("a"), F.col("shard").alias("home")).select(
        "a", F.explode(F.transform(steps, lambda s: F.col("home") + s)).alias("shard")
    )
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return askers.join(homes, "shard").where(apart.between(1, radius)).select("a", "b")


# --- the operator ---------------------------------------------------------------------


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """One row per document: ``_id``, ``_key`` (text key), ``fp``, ``component_id``, ``root``.

    Documents are linked when their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest id that links reach. NULL texts count as empty;
    texts without a word share fingerprint 0 and are linked like any other. Rows that
    repeat an id are rows of their own. A NULL id is never the smallest unless all of
    the component are NULL. ``root`` names the component by its least fingerprint, also
    where ids repeat. An empty table gives an empty result.

    Equal fingerprints are one node, so copies cost one row each and never form pairs.
    """
    by_batches(docs.sparkSession)
    rows = cut(
        docs.select(
            F.col(id_col).alias("_id"),
            text_key(F.col(text_col)).alias("_key"),
            fingerprint_column(F.col(text_col), shingle).alias("fp"),
        )
    )
    classes = cut(rows.groupBy("fp").agg(F.min("_id").alias("first")))
    roots = components.connected(links_between(classes.select("fp"), radius), "a", "b")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    return rows.join(named, "fp")


def simhash_stage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    If several rows of a group have that id, those with the least text key stay, and of
    wholly repeated rows one.
    """
    groups = cut(simhash_groups(docs, id_col, text_col))
    first = F.col("_id").eqNullSafe(F.col("component_id"))
    # One row per group unless ids repeat.
    keys = groups.where(first).groupBy("root", "_id", "_key").agg(F.count("*").alias("_n"))
    least = keys.groupBy("root").agg(
        F.min("_key").alias("_least"), F.min_by("_n", "_key").alias("_n"), F.count("*").alias("_keys")
    )
    odd = cut(least.where("_n > 1 or _keys > 1"))
    gone = groups.where(~first).select("_id", "_key")
    if odd.isEmpty():
        return drop_rows(docs, cut(gone), id_col, text_col)
    named = groups.where(first).join(odd, "root")
    lost = named.where("_key <> _least").select("_id", "_key")
    rest = drop_rows(docs, cut(gone.unionByName(lost)), id_col, text_col)
    repeated = cut(named.where("_key = _least and _n > 1").select("_id", "_key").distinct())
    same = rest[id_col].eqNullSafe(repeated["_id"]) & (text_key(rest[text_col]) == repeated["_key"])
    one = rest.join(repeated, same, "left_semi").dropDuplicates([id_col, text_col])
    return drop_rows(rest, repeated, id_col, text_col).unionByName(one)
