"""Embedding near-dedup by crowded cells and a pivot-permutation index.

Where vectors of a bounded sample crowd, their mean directions are the centres of cells.
A vector within the linking angle of a centre lives in the cell of the nearest one, and
by the triangle bound all that it links with lie within twice that angle of the centre:
these are listed in the cell and verified pairwise, so no link of a vector that lives
in a cell is lost, however large its group.

For the vectors outside all cells, some of the sample are the pivots. Each vector is
described by its nearest pivots in order and stands in the inverted list of each of
them. Vectors that share enough pivots are candidates, counted in the list of the first
pivot they share, and their cosine is verified there in double precision.

Long lists are cut into blocks that meet pairwise, so a task holds two blocks at most,
whatever the list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import components
from tidemark.llm.common import by_value, cut, hash_sample, small

by_value(__name__)

COSINE = 0.93
#: Nearest pivots that describe a vector, and how many of them a candidate shares.
PREFIX = 6
SHARED = 2
#: Number of pivots: this many times the root of the number of vectors, within bounds.
PIVOTS_PER_ROOT = 1.0
LEAST_PIVOTS, MOST_PIVOTS = 32, 4_096
#: The sample has this many vectors for each pivot; a cell's centre has at least CROWD of
#: them within the linking angle.
SAMPLE_PER_PIVOT = 4
LEAST_SAMPLE, MOST_SAMPLE = 512, 4_096
CROWD = 3
#: Vectors of one block of a list, of one of a cell, and of one task's share on average.
BLOCK = 2_048
CELL_BLOCK = 8_192
SHARE = 30_000
#: Number of the list without a pivot; the lists of the cells have the numbers below it.
NO_PIVOT = -1
#: Rows of a cell's block that are compared with the others at a time.
TILE = 256


def usable(vector: Column) -> Column:
    """Not NULL, without NULL or non-finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def unit(rows: list | np.ndarray) -> np.ndarray:
    """Rows of unit length, in double precision and safe from overflow."""
    rows = np.asarray(rows, np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit rows of list values of equal length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return unit(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1))


def centres(units: np.ndarray, cosine: float) -> np.ndarray:
    """Mean directions of the crowds of a sample, the largest first.

    Each sample vector that has CROWD vectors of the sample (itself, too) within the
    linking angle is in the crowd of a centre or has been one's seed.
    """
    near = units @ units.T >= cosine
    hits, left, found = near.sum(axis=1), np.ones(len(units), bool), []
    while left.any():
        seed = int(np.argmax(np.where(left, hits, -1)))
        if hits[seed] < CROWD:
            break
        centre = unit(units[near[seed] & left].mean(axis=0, keepdims=True))
        found.append(centre)
        covered = left & (units @ centre[0] >= cosine)
        covered[seed] = True
        hits = hits - near[:, covered].sum(axis=1)
        left &= ~covered
    return np.concatenate(found) if found else np.empty((0, units.shape[1]))


def cells_of(units: np.ndarray, middles: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of the cell that each vector lives in, or of cells if in none; and where it is listed.

    A pair is verified in the cell with the lower number of those that the two live in,
    so a vector is listed in its own cell and in the reached ones of lower numbers.
    """
    numbers = np.arange(len(middles))
    if not len(middles):
        return np.zeros(len(units), int), np.zeros((len(units), 0), bool)
    close = units @ middles.T
    home = close.argmax(axis=1)
    home = np.where(close[np.arange(len(units)), home] >= cosine, home, len(middles))
    reach = math.cos(min(math.pi, 2 * math.acos(max(-1.0, min(1.0, cosine))))) - 1e-6
    return home, (close >= reach) & (numbers < home[:, None]) | (numbers == home[:, None])


DESCRIBED = "struct<pivots:array<int>,lists:array<int>,home:int>"


def described_column(
    vector: Column, pivots: dict[int, np.ndarray], middles: dict[int, np.ndarray], prefix: int, cosine: float
) -> Column:
    """Nearest pivots of the vector's own length, nearest first, its lists, and the list it lives in.

    A vector that lives in a cell has no pivots; one outside has NO_PIVOT as its home.
    """
    kind = pa.struct([("pivots", pa.list_(pa.int32())), ("lists", pa.list_(pa.int32())), ("home", pa.int32())])

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes = np.diff(batch.offsets.to_numpy())
            found: list = [{"pivots": [NO_PIVOT], "lists": [NO_PIVOT], "home": NO_PIVOT}] * len(batch)
            for size in map(int, np.unique(sizes)):
                if size not in pivots and size not in middles:
                    continue
                own = np.flatnonzero(sizes == size)
                for part in np.array_split(own, -(-len(own) // 4_096)):
                    units = matrix(batch.take(pa.array(part)))
                    home, listed = cells_of(units, middles.get(size, np.empty((0, size))), cosine)
                    outside = home == listed.shape[1]
                    near = [[NO_PIVOT]] * len(part)
                    if size in pivots:
                        order = np.argsort(-(units[outside] @ pivots[size].T), axis=1, kind="stable")[:, :prefix]
                        for row, numbers in zip(np.flatnonzero(outside), order.tolist(), strict=True):
                            near[row] = numbers
                    for k, row in enumerate(part):
                        cells = (NO_PIVOT - 1 - np.flatnonzero(listed[k])).tolist()
                        found[row] = (
                            {"pivots": near[k], "lists": near[k] + cells, "home": NO_PIVOT}
                            if outside[k]
                            else {"pivots": [], "lists": cells, "home": NO_PIVOT - 1 - int(home[k])}
                        )
            yield pa.array(found, kind)

    return F.arrow_udf(each, DESCRIBED)(vector)


def first_shared(a: np.ndarray, b: np.ndarray, pivot: int, shared: int) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (pivot numbers) share enough pivots, this one first."""
    names, places = np.unique(np.concatenate([a.ravel(), b.ravel()]), return_inverse=True)
    hot = np.zeros((len(a) + len(b), len(names)), np.float32)
    width = a.shape[1]
    hot[np.repeat(np.arange(len(hot)), width), places] = 1
    one, two, lower = hot[: len(a)], hot[len(a) :], names < pivot
    enough = min(shared, width)
    return ((one @ two.T) >= enough) & ((one[:, lower] @ two[:, lower].T) == 0)


def block_links(
    units: np.ndarray, pivots: np.ndarray, low: np.ndarray | None, pivot: int, shared: int, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of row numbers: within one chunk, or between the ``low`` rows and the rest."""
    left = right = np.arange(len(units))
    if low is not None:
        left, right = np.flatnonzero(low), np.flatnonzero(~low)
    near = first_shared(pivots[left], pivots[right], pivot, shared)
    if low is None:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    if not len(i):
        return i, j
    if len(i) * 8 > near.size:
        good = (units[left] @ units[right].T)[i, j] >= cosine
    else:
        good = np.concatenate(
            [
                np.einsum("nd,nd->n", units[left[i[k : k + 65_536]]], units[right[j[k : k + 65_536]]])
                for k in range(0, len(i), 65_536)
            ]
        ) >= cosine
    return left[i[good]], right[j[good]]


def roots_of(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row number that links reach, for each row of a block."""
    root = np.arange(count)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def cell_links(
    units: np.ndarray, lives: np.ndarray, low: np.ndarray | None, copies: np.ndarray, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links and least linked row number of each row, over all pairs of which one lives in the cell.

    Pairs are within one chunk, or between the ``low`` rows and the rest.
    """
    count = len(units)
    links, root = np.zeros(count, np.int64), np.arange(count)
    left = right = np.arange(count)
    if low is not None:
        left, right = np.flatnonzero(low), np.flatnonzero(~low)
    others = units[right].T
    for k in range(0, len(left), TILE):
        own = left[k : k + TILE]
        good = (units[own] @ others >= cosine) & (lives[own][:, None] | lives[right])
        if low is None:
            good &= own[:, None] < right
        i, j = np.nonzero(good)
        links[own] += good @ copies[right]
        links[right] += copies[own] @ good
        a, b = root[own[i]], root[right[j]]
        if (a != b).any():
            root = roots_of(count, a[a != b], b[a != b])[root]
    return links, root


RESULT = "_node bigint, _links bigint, _root bigint"


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    prefix: int = PREFIX,
    shared: int = SHARED,
) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` and ``kept``.

    Vectors are compared when labels are equal and not NULL and lengths are equal. NULL or
    zero vectors and those with NULL or non-finite components link with nothing. Equal
    vectors of a label are one class, whose members link with each other and share the
    class's links. ``component_id`` is the smallest id that links reach, NULL only if all
    of them are. Rows that repeat an id are vectors of their own. An empty table gives an
    empty result.

    Every vector is indexed; only the pivots and the centres of the cells come from a
    sample, the first in the order of a hash, and vectors of a length that no pivot has
    are all listed together. All links of a vector that lives in a cell are found.
    """
    good = usable(F.col(vector_col)) & F.col(label_col).isNotNull()
    rows = vectors.select(
        F.col(id_col).alias("_id"),
        F.when(good, F.col(label_col)).alias("_label"),
        F.when(good, F.col(vector_col)).alias("_vector"),
    )
    classes = cut(
        rows.where(F.col("_vector").isNotNull())
        .groupBy("_label", "_vector")
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_copies"))
        .withColumn("_node", F.monotonically_increasing_id())
    )
    count = classes.count()
    wanted = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, PIVOTS_PER_ROOT * count**0.5)))
    sampled = min(MOST_SAMPLE, max(LEAST_SAMPLE, SAMPLE_PER_PIVOT * wanted))
    by_size: dict[int, list] = {}
    for number, vector in enumerate(hash_sample(classes, "_vector", sampled, count)):
        by_size.setdefault(len(vector), []).append((number, vector))
    middles, free = {}, []
    for size, numbered in by_size.items():
        units_ = unit([v for _, v in numbered])
        middles[size] = centres(units_, cosine)
        home, listed_ = cells_of(units_, middles[size], cosine)
        free += [(n, size, u) for (n, _), u, h in zip(numbered, units_, home, strict=True) if h == listed_.shape[1]]
    outside: dict[int, list] = {}
    for _, size, unit_ in sorted(free, key=lambda x: x[0])[:wanted]:
        outside.setdefault(size, []).append(unit_)
    pivots = {size: np.stack(units_) for size, units_ in outside.items()}
    about = described_column(F.col("_vector"), pivots, middles, prefix, cosine)
    described = cut(
        classes.select("*", F.size("_vector").alias("_size"), about.alias("_about")).select(
            "_label", "_size", "_node", "_copies", "_vector", "_about.*"
        )
    )
    posts = described.withColumnRenamed("pivots", "_pivots").withColumn("_pivot", F.explode("lists"))
    posts = posts.withColumn("_lives", F.col("home") == F.col("_pivot"))
    lists = ["_label", "_size", "_pivot"]
    block_ = F.when(F.col("_pivot") < NO_PIVOT, CELL_BLOCK).otherwise(BLOCK)
    long_ = posts.groupBy(*lists).agg(F.count("*").alias("_n"))
    long_ = cut(long_.withColumn("_chunks", F.ceil(F.col("_n") / block_).cast("int")).where("_chunks > 1"))
    repeated = long_.agg(F.sum(F.col("_n") * (F.col("_chunks") - 1))).first()[0] or 0
    long_ = small(long_.drop("_n"))
    posts = posts.join(long_, lists, "left").withColumn("_chunks", F.coalesce("_chunks", F.lit(1)))
    posts = posts.withColumn("_chunk", F.pmod(F.xxhash64("_node"), F.col("_chunks")).cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("_chunks") - 1),
        lambda c: F.struct(F.least(c, "_chunk").alias("low"), F.greatest(c, "_chunk").alias("high")),
    )
    posts = posts.withColumn("_meet", F.explode(meets))
    block = F.xxhash64(*lists, "_meet")
    shares = max(1, -(-(count * prefix + repeated) // SHARE))
    posts = posts.select(
        F.pmod(block, F.lit(shares)).alias("_share"),
        block.alias("_block"),
        (F.col("_meet.low") != F.col("_meet.high")).alias("_two"),
        (F.col("_chunk") == F.col("_meet.low")).alias("_low"),
        *("_label", "_size", "_pivot", "_node", "_copies", "_lives", "_pivots", "_vector"),
    )

    def run(table: pa.Table) -> pa.Table:
        names = ("_block", "_size", "_pivot", "_two", "_low", "_node", "_copies", "_lives")
        number = {n: table.column(n).to_numpy() for n in names}
        listed, vectors_ = table.column("_pivots").combine_chunks(), table.column("_vector").combine_chunks()
        labels = table.column("_label").combine_chunks().dictionary_encode().indices.to_numpy()
        same = (labels, number["_size"], number["_pivot"], number["_two"], number["_block"])
        order = np.lexsort(same)
        keys = np.stack(same)[:, order]
        ends = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for own in np.split(order, ends):
            if len(own) < 2:
                continue
            take = pa.array(own)
            pivot, units, low = int(number["_pivot"][own[0]]), matrix(vectors_.take(take)), None
            if number["_two"][own[0]]:
                low = number["_low"][own].astype(bool)
            copies, nodes = number["_copies"][own], number["_node"][own]
            if pivot < NO_PIVOT:
                links, root = cell_links(units, number["_lives"][own].astype(bool), low, copies, cosine)
            else:
                width = len(listed[int(own[0])])
                near = listed.take(take).flatten().to_numpy().reshape(len(own), width)
                i, j = block_links(units, near, low, pivot, shared, cosine)
                links = np.bincount(i, copies[j], len(own)) + np.bincount(j, copies[i], len(own))
                root = roots_of(len(own), i, j)
            has = links > 0
            out.append((nodes[has], links[has].astype(np.int64), nodes[root[has]]))
        columns = [np.concatenate([o[k] for o in out]) if out else np.empty(0, np.int64) for k in range(3)]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("_node", "_links", "_root"), columns, strict=True)})

    found = cut(posts.groupBy("_share").applyInArrow(run, RESULT))
    roots = components.connected(found, "_node", "_root")
    named = (
        classes.join(found.groupBy("_node").agg(F.sum("_links").alias("_links")), "_node", "left")
        .join(roots, classes["_node"] == roots["node"], "left")
        .withColumn("_root", F.coalesce("root", "_node"))
    )
    least = named.groupBy("_root").agg(F.min("_first").alias("_least"))
    named = named.join(least, "_root").select(
        "_label",
        "_vector",
        (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("n_links"),
        F.col("_least").alias("_component"),
    )
    joined = rows.join(named, ["_label", "_vector"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("_id")).otherwise(F.col("_component"))
    return joined.select(
        F.col("_id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )
