import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    values = (None if row[f] is None else str(row[f]) for f in merkle.FIELDS)
    return digest("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row, by plain lists."""

    def levels(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            last = found[-1]
            found.append([digest("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
        return found

    def climb(trees, number, proof, now):
        for nodes in trees[:-1]:
            start = number - number % 16
            before, after = nodes[start:number], nodes[number + 1 : start + 16]
            proof += "".join(before + after)
            number, now = number // 16, digest("".join([*before, now, *after]))
        return proof, now

    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {
        s: sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for s in names
    }
    trees = {s: levels([leaf(r) for r in ordered[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    found = []
    for place, s in enumerate(names):
        for number, row in enumerate(ordered[s]):
            now = row
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and row["text"] is not None:
                now = {**row, "text": "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])}
            proof, folded = climb(trees[s], number, "", leaf(now))
            proof, folded = climb(top, place, proof, folded)
            root = top[-1][0]
            found.append((row["doc_id"], leaf(row), trees[s][-1][0], root, digest(proof), folded, folded == root))
    return sorted(found, key=repr)


def audit(docs):
    import string

    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = merkle.leaf_of([lowered if f == "text" else F.col(f) for f in merkle.FIELDS])
    result = merkle.build(docs, found=F.when(changed, found)).audit()
    names = ["_carry.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, result.select(*names).collect()), key=repr)


def rows_of(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string" + more)


def make(seed, count, sources=(None, "", "a", "é", "hot", "hot", "hot")):
    rng = random.Random(seed)
    return [
        {
            "doc_id": rng.choice([None, *range(count)]),
            "source": rng.choice(sources),
            "lang": rng.choice(["en", None]),
            "n_chars": rng.choice([None, -3, 7]),
            "text": rng.choice([None, "", "Ab Cd", "Öl É", f"Text {i}", "long " * 5000]),
        }
        for i in range(count)
    ]


@pytest.mark.parametrize("height", [1, 2, 3])
def test_against_brute_force(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 16**height)
    rows = make(height, 700)
    assert audit(rows_of(spark, [tuple(r.values()) for r in rows])) == brute(rows)


def test_many_groups_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = make(5, 300, [f"s{i}" for i in range(290)])
    assert audit(rows_of(spark, [tuple(r.values()) for r in rows])) == brute(rows)


def test_one_row_and_no_row(spark):
    rows = make(1, 1)
    assert audit(rows_of(spark, [tuple(r.values()) for r in rows])) == brute(rows)
    empty = rows_of(spark, [])
    assert audit(empty) == []
    assert merkle.build(empty).root() is None
    assert merkle.build(empty).blocks().collect() == []


def test_repeated_rows_and_clashing_columns(spark):
    row = {"doc_id": 5, "source": "a", "lang": None, "n_chars": 2, "text": "Ab"}
    clash = ", _group int, _leaf string, _index int, root string, leaf string"
    docs = rows_of(spark, [(*row.values(), 1, "x", 2, "y", "z")] * 40, clash)
    assert audit(docs) == brute([row] * 40)


@pytest.mark.parametrize("levels", [1, 2, 3, 4])
def test_layout_holds_each_node_once_with_lower_trees_together(levels):
    at = [merkle.places(depth, levels) for depth in range(levels)]
    assert sorted(np.concatenate(at)) == list(range(merkle.nodes_of(levels)))
    if levels == 4:  # two levels above, then lower trees of two levels: a node and its 16 children
        assert list(at[1]) == list(range(1, 17))
        assert at[2][0] == 17 and list(at[3][:16]) == list(range(18, 34)) and at[2][1] == 34


@pytest.mark.parametrize("count", [1, 2, 16, 17, 255, 256, 257, 4095, 4096])
def test_block_of_any_size_climbs_to_its_root(count):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(count)]
    levels = merkle.levels_for(count)
    block = merkle.laid_out(leaves, levels)
    found = list(merkle.climbs(block, count, levels))
    assert [leaf for leaf, _ in found] == [d.hex() for d in leaves]
    assert {merkle.folded(leaf, steps) for leaf, steps in found} == {block[:32].hex()}


def test_blocks_are_the_manifest(spark, whole):
    manifest = merkle.build(whole("documents"))
    blocks = manifest.blocks().collect()
    assert sum(b.n_leaves for b in blocks if b.tree == "rows") == 200
    assert {b.group_name for b in blocks if b.tree == "rows"} == {f"src{i}" for i in range(20)}
    top = [b for b in blocks if b.tree == "groups"]
    assert [bytes(b.nodes[:32]).hex() for b in top] == [manifest.root()]
