import math

import numpy as np
from conftest import groups

from tidemark.llm import embedding_dedup
from tidemark.llm.queries import op7_embedding_dedup

KIND = "vec_id bigint, embedding array<float>, label int"


def brute(rows):
    """Links, component and kept of each row in order."""
    units = []
    for _, v, label in rows:
        good = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, np.float32).astype(np.float64) if good else None)
    links = [
        (i, j)
        for i, a in enumerate(units)
        for j, b in enumerate(units[:i])
        if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b)
        and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93
    ]
    root = groups(range(len(rows)), links)
    members = {}
    for n in range(len(rows)):
        members.setdefault(root[n], []).append(rows[n][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    count = np.bincount([n for link in links for n in link], minlength=len(rows))
    return [(i, int(count[n]), least[root[n]], i == least[root[n]]) for n, (i, *_) in enumerate(rows)], len(links)


def result(spark, rows):
    found = embedding_dedup.near_vectors(spark.createDataFrame(rows, KIND)).collect()
    return [tuple(r) for r in found]


def clustered(rng, count, copies):
    rows = []
    for c in range(count):
        centre = rng.normal(size=32)
        for _ in range(copies[c % len(copies)]):
            v = centre + rng.normal(size=32) * rng.choice([0.02, 0.1, 0.2])
            rows.append((len(rows), [float(np.float32(x)) for x in v * rng.uniform(0.1, 9)], int(c % 3)))
    return rows


def test_recall_and_precision(spark):
    rows = clustered(np.random.default_rng(1), 60, [1, 2, 5, 30])
    want, links = brute(rows)
    got = result(spark, rows)
    found = {r[0]: r[1] for r in got}
    assert all(found[i] <= n for i, n, *_ in want)
    assert sum(found.values()) >= 0.9 * 2 * links


def test_long_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "LEAST_PIVOTS", 4)
    monkeypatch.setattr(embedding_dedup, "PIVOTS_PER_ROOT", 0.1)
    rows = clustered(np.random.default_rng(2), 8, [40])
    want, links = brute(rows)
    found = {r[0]: r[1] for r in result(spark, rows)}
    assert all(found[i] <= n for i, n, *_ in want)
    assert sum(found.values()) >= 0.9 * 2 * links


def test_a_third_in_one_group_of_similar_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL_BLOCK", 256)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(2_400, 64))
    v[:800] = rng.normal(size=64) + 0.23 * v[:800]
    v[800:1_000] = rng.normal(size=64) + 0.23 * v[800:1_000]
    v = rng.permutation(v).astype(np.float32)
    units = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    near = units @ units.T >= 0.93
    rows = [(n, x.tolist(), 0) for n, x in enumerate(v)]
    assert near.sum() > 500_000
    found = {r[0]: r[1] for r in result(spark, rows)}
    assert [found[n] for n in range(len(rows))] == (near.sum(axis=1) - 1).tolist()


def test_table_is_exact(spark, whole):
    rows = [tuple(r) for r in whole("embeddings").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, op7_embedding_dedup(spark, "/root/testdata/sf0.001").collect())) == sorted(brute(rows)[0])


def test_odd_rows(spark):
    v, nan, inf = [1.0, 2.0], float("nan"), float("inf")
    rows = [
        (1, v, 0), (2, v, 0), (2, v, 0), (None, v, 0), (3, v, None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0),
        (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [None, 1.0], 0), (10, [2.0, 4.0], 0), (11, v, 1), (12, [1.0, 2.0, 0.0], 0),
        (13, [3e38, 3e38], 2), (14, [1e-40, 1e-40], 2), (None, [5.0, -1.0], 4), (15, [-1.0, -2.0], 0),
    ]
    assert sorted(result(spark, rows), key=repr) == sorted(brute(rows)[0], key=repr)
    assert result(spark, []) == []
