"""Merkle manifest of a table, its trees stored in van Emde Boas blocks.

Rows are leaves, a group's leaves (in id order) make a tree of 16 children a node, and
the groups' roots make one more tree. A tree is stored as aligned blocks of up to three
levels above their leaves: 4,096 leaves, whose roots are the leaves of the next tier's
blocks, until one block is left. Within a block the nodes lie in van Emde Boas order:
the tree is split at half its height, the upper part comes first and each lower part
after it, all split again. A node's place follows from its depth and number alone, so
building a block and finding a run of siblings need no pointers.

Building goes up the tiers, one row a block; proofs come down them, each block getting
the siblings above its root from the tier above. A hot group is many blocks in many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_batches, by_value, cut, measured

by_value(__name__)

FANOUT = 16
#: Levels of a block above its leaves.
HEIGHT = 3
BLOCK = FANOUT**HEIGHT
#: Columns that make a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows that a task hands on at once.
SHARE = 4_096

# --- one block ------------------------------------------------------------------------


def nodes_of(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def place(depth: int, number: np.ndarray, levels: int) -> np.ndarray:
    """Places in van Emde Boas order of nodes, by their depth (root 0) and number in it."""
    if levels == 1:
        return np.zeros_like(number)
    upper = levels // 2
    if depth < upper:
        return place(depth, number, upper)
    lower = levels - upper
    tree, inside = np.divmod(number, FANOUT ** (depth - upper))
    return nodes_of(upper) + tree * nodes_of(lower) + place(depth - upper, inside, lower)


@lru_cache
def places(depth: int, levels: int) -> np.ndarray:
    return place(depth, np.arange(FANOUT**depth), levels)


def levels_for(total: int) -> int:
    """Levels of the blocks of a tree of ``total`` leaves; a tree of one block has as many as it needs."""
    levels = 1
    while levels <= HEIGHT and FANOUT ** (levels - 1) < total:
        levels += 1
    return levels


def laid_out(leaves: Sequence[bytes], levels: int) -> bytes:
    """The block over these leaves. Nodes that a short last run leaves out are zeros."""
    counts = [len(leaves)]
    while len(counts) < levels:
        counts.insert(0, -(-counts[0] // FANOUT))
    at = [places(depth, levels)[:count] for depth, count in enumerate(counts)]
    nodes = np.zeros((1 + max(int(p[-1]) for p in at), 32), np.uint8)
    nodes[at[-1]] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, 32)
    for depth in range(levels - 2, -1, -1):
        runs = nodes[at[depth + 1]].tobytes().hex().encode()
        size = FANOUT * 64
        above = [sha256(runs[i : i + size]).digest() for i in range(0, len(runs), size)]
        nodes[at[depth]] = np.frombuffer(b"".join(above), np.uint8).reshape(-1, 32)
    return nodes.tobytes()


Step = tuple[int, str]


def climbs(block: bytes, count: int, levels: int) -> Iterator[tuple[str, list[Step]]]:
    """Each leaf with its steps to the block's root: its number in the run, and the run's others."""
    nodes = np.frombuffer(block, np.uint8).reshape(-1, 32)
    rows: list[str] = []
    for depth in range(levels):
        size = -(-count // FANOUT ** (levels - 1 - depth))
        rows.append(nodes[places(depth, levels)[:size]].tobytes().hex())
    for leaf in range(count):
        steps, number = [], leaf
        for row in rows[:0:-1]:
            number, slot = divmod(number, FANOUT)
            run = row[number * FANOUT * 64 : (number + 1) * FANOUT * 64]
            steps.append((slot, run[: slot * 64] + run[slot * 64 + 64 :]))
        yield rows[-1][leaf * 64 : leaf * 64 + 64], steps


def folded(leaf: str, steps: Sequence[Step]) -> str:
    """The root that a leaf and its siblings give."""
    for slot, others in steps:
        leaf = sha256(f"{others[: slot * 64]}{leaf}{others[slot * 64 :]}".encode()).hexdigest()
    return leaf


# --- trees as tables ------------------------------------------------------------------


def field_text(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf_of(values: Sequence[Column]) -> Column:
    """Digest of a row: each value with its length in bytes before it, ``-`` for NULL."""
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def group_key(group: Column) -> Column:
    """A key without NULLs, ordered as the groups are: NULL, then by bytes."""
    return F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group.cast("string")))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Cut rows with ``_index``, their number in ``_group`` by ``order``, and ``_total``, its size.

    A range shuffle sorts all groups together and splits a large one, also between equal
    rows; a row's number is its place in its range plus the group's rows in ranges before.
    The window below sees one row for each group and range, at most as many of a group as
    there are shuffle partitions.
    """
    keys = ["_group", *order, "_spread"]
    ranged = cut(
        rows.withColumn("_spread", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_spread")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_place", 33))
    )
    sizes = ranged.groupBy("_group", "_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy("_group")
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_group",
        "_range",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
        F.sum("_n").over(group).alias("_total"),
    )
    found = ranged.join(measured(cut(offsets)), ["_group", "_range"])
    return found.withColumn("_index", F.col("_place") + F.col("_offset")).drop("_place", "_range", "_offset")


def blocks_of(rows: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Cut blocks over numbered rows: ``_group``, ``_block``, ``_total``, ``_nodes``, ``_members``.

    A block has at most 4,096 members, structs of ``_slot`` and the ``kept`` columns.
    """

    def build(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for leaves, totals in batches:
            pairs = zip(leaves, totals)
            yield pa.array((laid_out(ls.as_py(), levels_for(t.as_py())) for ls, t in pairs), pa.binary(), size=len(totals))

    block = F.floor(F.col("_index") / BLOCK).cast("bigint")
    member = F.struct((F.col("_index") % BLOCK).cast("int").alias("_slot"), F.unhex("_leaf").alias("_leaf"), *kept)
    grouped = rows.groupBy("_group", block.alias("_block"), "_total").agg(
        F.array_sort(F.collect_list(member), lambda a, b: a["_slot"] - b["_slot"]).alias("_all")
    )
    nodes = F.arrow_udf(build, "binary")(F.transform("_all", lambda m: m["_leaf"]), F.col("_total"))
    members = F.transform("_all", lambda m: F.struct(m["_slot"], *[m[k].alias(k) for k in kept]))
    return cut(grouped.select("_group", "_block", "_total", nodes.alias("_nodes"), members.alias("_members")))


def root_of(nodes: Column) -> Column:
    return F.lower(F.hex(F.substring(nodes, 1, 32)))


def tiers_of(rows: DataFrame, kept: Sequence[str] = ()) -> list[DataFrame]:
    """Blocks over the rows, over these blocks' roots, and so on; three tiers hold 6 x 10^10 rows."""
    tiers = [blocks_of(rows, kept)]
    while True:
        parted = tiers[-1].where(F.col("_total") > BLOCK)
        if parted.isEmpty():
            return tiers
        above = parted.select(
            "_group",
            F.col("_block").alias("_index"),
            F.ceil(F.col("_total") / BLOCK).cast("bigint").alias("_total"),
            root_of(F.col("_nodes")).alias("_leaf"),
        )
        tiers.append(blocks_of(above))


STEP = pa.struct([("slot", pa.int32()), ("others", pa.string())])
STEPS = "array<struct<slot:int, others:string>>"


def steps_of(row: dict) -> Iterator[tuple[str, list[Step]]]:
    """The leaves of a block with their steps to the top: within the block, then above it."""
    above = [(s["slot"], s["others"]) for s in row["_steps"]]
    for leaf, own in climbs(row["_nodes"], row["_count"], levels_for(row["_total"])):
        yield leaf, own + above


def with_steps(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest tier's blocks with ``_count``, the ``_steps`` from their roots to the top, and
    ``above``'s other columns, which are texts.

    ``above`` has the steps from each group's root, by ``_group``. In every join a block is
    one row of either side.
    """
    names = [c for c in above.columns if c not in ("_group", "_steps")]
    known = None
    for tier in reversed(tiers):
        # Groups that are one block in this tier start here.
        tops = tier.where(F.col("_total") <= BLOCK).select("_group", "_block").join(above, "_group")
        tops = tops.select("_group", "_block", *names, "_steps")
        if known is not None:
            down = known.select("_group", F.col("_index").alias("_block"), *names, "_steps")
            tops = tops.unionByName(down)
        blocks = tier.withColumn("_count", F.size("_members")).join(measured(cut(tops)), ["_group", "_block"])
        if tier is not tiers[0]:
            known = leaves_with_steps(blocks, names)
    return blocks


def leaves_with_steps(blocks: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each leaf of the blocks: ``_group``, ``_index``, ``_leaf``, the named columns, and ``_steps``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                count, first = row["_count"], row["_block"] * BLOCK
                leaves, steps = zip(*steps_of(row))
                steps = [[{"slot": s, "others": o} for s, o in path] for path in steps]
                columns = {
                    "_group": pa.array([row["_group"]] * count, pa.string()),
                    "_index": pa.array(range(first, first + count), pa.int64()),
                    "_leaf": pa.array(leaves, pa.string()),
                    **{n: pa.array([row[n]] * count, pa.string()) for n in names},
                    "_steps": pa.array(steps, pa.list_(STEP)),
                }
                yield pa.RecordBatch.from_pydict(columns)

    texts = "".join(f", {n} string" for n in names)
    needed = blocks.select("_group", "_block", "_total", "_count", "_nodes", *names, "_steps")
    return needed.mapInArrow(each, f"_group string, _index bigint, _leaf string{texts}, _steps {STEPS}")


def audited(blocks: DataFrame) -> DataFrame:
    """Each member's ``_carry``, its leaf, the roots, the digest of its siblings and the root it folds to."""
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = f"_carry {blocks.schema['_members'].dataType.elementType['_carry'].dataType.simpleString()}"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("_members").flatten()
            carry, found = members.field("_carry"), members.field("_found")
            rows: list[tuple] = []
            start = at = 0
            for row in batch.drop_columns(["_members"]).to_pylist():
                for leaf, steps in steps_of(row):
                    proof = sha256("".join(others for _, others in steps).encode()).hexdigest()
                    now = found[at].as_py()
                    root = folded(leaf if now is None else now.hex(), steps)
                    rows.append((leaf, row["_subroot"], row["_root"], proof, root))
                    at += 1
                if at - start >= SHARE:
                    yield handed(carry.slice(start, at - start), rows)
                    rows, start = [], at
            if rows:
                yield handed(carry.slice(start, at - start), rows)

    def handed(carry: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, pa.string()) for column in zip(*rows)]
        return pa.RecordBatch.from_arrays([carry, *columns], ["_carry", *names])

    found = blocks.mapInArrow(each, ", ".join([schema, *[f"{n} string" for n in names]]))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


@dataclass(frozen=True)
class Manifest:
    """The stored trees: ``tiers`` over each group's rows, ``tops`` over the roots of ``groups``."""

    tiers: list[DataFrame]
    tops: list[DataFrame]
    groups: DataFrame

    def blocks(self) -> DataFrame:
        """All blocks, one row each, by tree (``rows`` of a group, or ``groups``), tier and number.

        ``nodes`` holds 32 bytes a node by its place, the block's root first.
        """
        parts = [
            tier.select(
                F.lit(tree).alias("tree"),
                F.lit(number).alias("tier"),
                F.when(F.col("_group") != "", F.expr("substring(_group, 2)")).alias("group_name"),
                F.col("_block").alias("block"),
                F.size("_members").alias("n_leaves"),
                F.col("_nodes").alias("nodes"),
            )
            for tree, tiers in (("rows", self.tiers), ("groups", self.tops))
            for number, tier in enumerate(tiers)
        ]
        return reduce(DataFrame.unionByName, parts)

    def root(self) -> str | None:
        """The root over all; None of an empty table."""
        row = self.tops[-1].select(root_of(F.col("_nodes"))).first()
        return row[0] if row else None

    def audit(self) -> DataFrame:
        """One row per leaf, folded with its siblings up to the root."""
        over_all = self.tops[-1].select(
            "_group", root_of(F.col("_nodes")).alias("_root"), F.array().cast(STEPS).alias("_steps")
        )
        roots = leaves_with_steps(with_steps(self.tops, over_all), ["_root"])
        above = roots.drop("_group").join(measured(self.groups), "_index").select(
            F.col("_name").alias("_group"), F.col("_leaf").alias("_subroot"), "_root", "_steps"
        )
        return audited(with_steps(self.tiers, measured(cut(above))))


def build(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: Sequence[str] = FIELDS,
    found: Column | None = None,
    carry: Sequence[str] | None = None,
) -> Manifest:
    """The manifest of a table.

    ``found`` is a row's leaf digest as read again (``leaf_of``), NULL where it is the same;
    ``audit`` checks it. ``carry`` names the columns that the audit hands back in ``_carry``
    (the id by default). Every row is a leaf, repeated rows too; rows of one id are ordered by
    their digest, and NULL ids and NULL groups come first. An empty table has no block. Texts
    are hashed where they are read; only digests, ids and groups are shuffled.
    """
    by_batches(docs.sparkSession)
    again = F.lit(None).cast("binary") if found is None else F.unhex(found)
    leaves = cut(
        docs.select(
            group_key(F.col(group_col)).alias("_group"),
            F.col(id_col).alias("_id"),
            leaf_of([F.col(f) for f in fields]).alias("_leaf"),
            again.alias("_found"),
            F.struct(*(carry or [id_col])).alias("_carry"),
        )
    )
    tiers = tiers_of(numbered(leaves, ["_id", "_leaf"]), ["_found", "_carry"])
    roots = [
        tier.where(F.col("_total") <= BLOCK).select("_group", root_of(F.col("_nodes")).alias("_leaf"))
        for tier in tiers
    ]
    roots = reduce(DataFrame.unionByName, roots).select(F.lit("").alias("_group"), F.col("_group").alias("_name"), "_leaf")
    groups = cut(numbered(roots, ["_name"]))
    return Manifest(tiers, tiers_of(groups), groups.select("_index", "_name"))
