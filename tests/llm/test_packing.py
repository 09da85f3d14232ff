import random
from collections import Counter

from tidemark.llm import packing
from tidemark.llm.queries import op3_best_fit_packing


def brute(sizes, sources, clusters, capacity):
    """The tightest compatible bin by looking at all; of equal ones the first."""
    bins, placed = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        fits = [
            (space, n)
            for n, (space, held) in enumerate(bins)
            if space >= size
            and (source is None or ("s", source) not in held)
            and (cluster is None or ("c", cluster) not in held)
        ]
        n = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append((capacity, set()))
        bins[n] = (bins[n][0] - size, bins[n][1] | {("s", source), ("c", cluster)})
        placed.append(n)
    return placed


def test_best_fit_against_brute_force():
    rng = random.Random(6)
    for _ in range(40):
        n = rng.randrange(1, 150)
        sizes = [rng.choice([0, 1, 5, 30, 99, 100, rng.randrange(101)]) for _ in range(n)]
        sources = [rng.choice([None, "hot", "hot", *"abcdefgh"]) for _ in range(n)]
        clusters = [rng.choice([None, *range(30)]) for _ in range(n)]
        assert packing.best_fit(sizes, sources, clusters, 100) == brute(sizes, sources, clusters, 100)


def check(rows, sizes, capacity):
    """Pieces cover each text once; no bin is too full or holds a conflict."""
    assert Counter() == Counter(sizes) - Counter(
        (doc, sum(r["size"] for r in rows if r.doc_id == doc)) for doc in {r.doc_id for r in rows}
    )
    bins = {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
    for held in bins.values():
        assert sum(r["size"] for r in held) <= capacity
        for kind in ("source", "cluster"):
            names = [r[kind] for r in held if r[kind] is not None]
            assert len(names) == len(set(names))
    return bins


def test_table(spark, whole):
    texts = [(r.doc_id, len(r.text)) for r in whole("documents").select("doc_id", "text").collect()]
    rows = op3_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    bins = check(rows, texts, packing.CAPACITY)
    assert len(bins) < len(rows)
    for r in rows:
        assert r.start == r.piece * packing.CAPACITY


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (None, "x" * 25), (3, "y" * 10), (4, "y " * 5), (5, "z"), (5, "z"), (6, "\u00e9" * 10)]
    docs = documents(rows, bin_id=("int", 1), piece=("int", 2))
    found = packing.pack(docs, capacity=10).collect()
    assert len(found) == 10
    assert sorted(r["size"] for r in found if r.doc_id is None) == [5, 10, 10]
    assert sum(r["size"] for r in found) == sum(len(t or "") for _, t in rows)
    spread = docs.withColumn("source", docs.doc_id.cast("string"))
    found = packing.pack(spread, capacity=30).collect()
    twins = [r.bin_id for r in found if r.doc_id == 5]
    assert twins[0] != twins[1]
    assert packing.pack(documents([])).collect() == []


def test_ids_of_text_with_an_empty_and_a_null_one(spark):
    rows = [(i, "w" * n, "s") for n, i in enumerate(["b", "", None, "a", "", None, "c"])]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    found = packing.pack(docs, capacity=10).collect()
    assert sorted((r.doc_id is None, r.doc_id or "") for r in found) == sorted((i is None, i or "") for i, *_ in rows)


def test_hot_source_and_many_groups(spark, documents):
    docs = documents([(i, "w" * (1 + i % 50) + str(i)) for i in range(600)])
    rows = packing.pack(docs, capacity=100, shard=64).collect()
    assert len(check(rows, [(r.doc_id, r["size"]) for r in rows], 100)) == 600
