import hashlib
import re
from collections import defaultdict

from tidemark.llm.exact_dedup import dedup_stage, exact_dedup

ROWS = [
    (1, "a b c"),
    (2, "abc"),
    (3, " a\tb\nc\x0b\x0c\r "),
    (4, None),
    (5, ""),
    (6, " \n"),
    (7, "a bc"),
    (8, "x" * 300 + "1"),
    (9, "x" * 300 + "2"),
    (10, "x" * 300 + " 1"),
    (None, "abc   "),
    (None, "lone"),
    (11, "tie one"),
    (11, "tie one"),
    (11, "tieone"),
    (12, "tie one"),
    (13, "xyz"),
    (14, "xyw"),
]


def brute(rows):
    sets = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        t = t or ""
        norm = re.sub(r"[\x20\x09-\x0D]+", "", t)
        sets[norm].append((-len(t), i is None, i or 0, n, i))
    found = []
    for members in sets.values():
        members.sort()
        for place, (*_, i) in enumerate(members):
            found.append((i, members[0][4], len(members), place == 0))
    return sorted(found, key=repr)


def test_against_brute_force(documents):
    got = exact_dedup(documents(ROWS)).select("_carry.doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS)


def test_stage_keeps_one_of_each_with_clashing_columns(documents):
    docs = documents(ROWS, keep_id=("int", 7), kept=("boolean", False), _id=("int", 1))
    kept = dedup_stage(docs)
    assert kept.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", "", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted({re.sub(r"[\x20\x09-\x0D]+", "", t or "") for _, t in ROWS})


def test_empty_table(documents):
    assert exact_dedup(documents([])).collect() == []
    assert dedup_stage(documents([])).collect() == []


def test_many_repeats_of_one_row(documents):
    found = exact_dedup(documents([(1, "same")] * 700 + [(2, "same")] * 5)).collect()
    assert sum(r.kept for r in found) == 1
    assert {(r.keep_id, r.group_size) for r in found} == {(1, 705)}


def test_hash_of_query(spark, whole):
    from tidemark.llm.queries import op10_exact_dedup

    texts = {r.doc_id: r.text for r in whole("documents").collect()}
    for r in op10_exact_dedup(spark, "/root/testdata/sf0.001").collect():
        norm = re.sub(r"[\x20\x09-\x0D]+", "", texts[r.doc_id])
        assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()


def test_only_dataframe_functions(documents):
    plan = exact_dedup(documents(ROWS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
