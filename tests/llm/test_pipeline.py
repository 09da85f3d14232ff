"""The pipeline, stage by stage, each against a plain reading of what it must do."""

import re

import corpus_pipeline
from test_secret_scan import plain_spans
from test_simhash import brute, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark, whole, tmp_path):
    docs = whole("documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        folder = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(folder)
        docs = spark.read.parquet(folder)
        seen[name] = before, docs.collect()
        if name != "packing":
            assert docs.columns == columns
    assert [name for name, _ in corpus_pipeline.STAGES] == list(seen)

    before, after = seen["toxicity"]
    assert {r.doc_id for r in after} < {r.doc_id for r in before} or len(after) == len(before)
    assert len(after) > 0.8 * len(before)

    before, after = seen["exact_dedup"]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", "", t)
    best = {}
    for r in before:
        key = norm(r.text)
        best[key] = min(best.get(key, (-len(r.text), r.doc_id)), (-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in after) == sorted(i for _, i in best.values())

    before, after = seen["simhash_dedup"]
    kept = [i for i, _, c in brute([(r.doc_id, r.text) for r in before]) if i == c]
    assert sorted(r.doc_id for r in after) == sorted(kept)
    assert len({plain_fingerprint(r.text) for r in after}) == len(after)

    before, after = seen["secret_scan"]
    texts = {r.doc_id: r.text for r in before}
    assert sorted(texts) == sorted(r.doc_id for r in after)
    for r in after:
        assert not plain_spans(r.text) and r.n_chars == len(r.text)
        assert r.text == texts[r.doc_id] or "[SECRET]" in r.text

    before, after = seen["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert sum(r["size"] for r in after) == sum(len(r.text) for r in before)


def test_run_gives_the_last_stage(spark, whole):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "piece", "start", "size", "source", "cluster", "bin_id"]
    assert 0 < found.select("doc_id").distinct().count() <= whole("documents").count()
