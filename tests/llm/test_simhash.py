import random
import re

import xxhash
from conftest import groups
from pyspark.sql import functions as F

from tidemark.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


ODD = ["", " \n ", "One", "one", "two words", "Two Words", "É é Éé", "a b c", "A  B\tC", "a b c d", "K k K"]


def test_fingerprint(whole):
    for text in ODD + [r.text for r in whole("documents").collect()]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_long_text_in_steps(monkeypatch):
    monkeypatch.setattr(simhash, "STEP", 7)
    text = " ".join(f"w{i % 37}" for i in range(1000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_links_are_exact(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1, 1 << 63}
    for p in list(prints):
        for bits in range(4):
            q = p
            for b in rng.sample(range(64), bits):
                q ^= 1 << b
            prints.add(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    want = {
        (a, b)
        for i, a in enumerate(signed)
        for b in signed[:i]
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    }
    for deep in (1, 1 << 26):
        simhash.DEEP, before = deep, simhash.DEEP
        try:
            got = simhash.links_between(df).collect()
        finally:
            simhash.DEEP = before
        assert {(max(r), min(r)) for r in got} == {(max(p), min(p)) for p in want}


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2
    ]
    root = groups(range(len(rows)), links)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[root[n]] = min(i, least.get(root[n], i))
    return [(i, prints[n], least.get(root[n])) for n, (i, _) in enumerate(rows)]


def test_groups_of_odd_rows(documents):
    rows = list(enumerate(ODD)) + [(None, "One"), (None, "unlike anything"), (50, None), (3, "a b c"), (3, "zz yy xx")]
    got = simhash.simhash_groups(documents(rows, fp=("int", 1), root=("int", 1))).collect()
    assert sorted(((r._id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == sorted(brute(rows), key=repr)


def test_groups_of_table(spark, whole):
    rows = [(r.doc_id, r.text) for r in whole("documents").collect()]
    from tidemark.llm.queries import op9_simhash_dedup

    got = op9_simhash_dedup(spark, "/root/testdata/sf0.001").collect()
    want = [(i, f"{p:016x}", c) for i, p, c in brute(rows)]
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(want)


def test_stage_leaves_one_of_each_group(documents):
    rows = [(2, "a b c d"), (1, "A b c d"), (5, "x y z"), (5, "x y z"), (5, "q r s t"), (7, None), (6, ""), (None, "n")]
    kept = simhash.simhash_stage(documents(rows, component_id=("int", 0)))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, "A b c d"), (5, "x y z"), (5, "q r s t"), (6, ""), (None, "n")], key=repr
    )
    assert kept.columns[-1] == "component_id"


def test_empty_table(documents):
    assert simhash.simhash_groups(documents([])).collect() == []
    assert simhash.simhash_stage(documents([])).where(F.lit(True)).collect() == []
