import random
import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity
from tidemark.llm.queries import op5_toxicity

DATA = "/root/testdata/sf0.1"


def test_quality_on_held_out_rows(spark):
    labels = dict(spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic").collect())
    rows = op5_toxicity(spark, DATA).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    score, label = np.array(held).T
    assert toxicity.rank_quality(score, label) > 0.85
    assert (score[label == 1] >= 0.3).mean() > 0.65
    assert (score[label == 0] >= 0.3).mean() < 0.06


def test_held_out_labels_do_not_matter(spark, documents):
    rng = random.Random(2)
    plain = ["".join(rng.choices("aeinorst", k=6)) for _ in range(400)]
    rows = []
    for i in range(240):
        words = rng.choices(plain, k=40)
        for at in range(0, 40, 8) if i % 3 == 0 else ():
            words[at + rng.randrange(7)] = rng.choice(["muckrake", "blackguard", "scoundrel"])
        rows.append((i, " ".join(words)))
    docs, labels = documents(rows), [(i, int(i % 3 == 0)) for i in range(240)]
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    make = lambda ls: spark.createDataFrame(ls, "doc_id bigint, toxic int")
    turned = [(i, 1 - y if i in held else y) for i, y in labels]
    scores = [
        sorted((r["_id"], r.score) for r in toxicity.toxicity(docs, make(ls)).collect()) for ls in (labels, turned)
    ]
    assert scores[0] == scores[1]
    right = [(s >= 0.3) == (i % 3 == 0) for i, s in scores[0] if i in held]
    assert np.mean(right) > 0.95
    kept = {r.doc_id for r in toxicity.toxicity_stage(docs, make(labels)).collect()}
    assert kept == {i for i, s in scores[0] if s < 0.3}


def test_odd_rows(spark, documents):
    docs = documents([(1, None), (2, ""), (None, "x"), (3, "y " * 50_000), (3, "y"), (4, "z" * 200_000)], _score=("int", 1))
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    found = toxicity.toxicity(docs, none).collect()
    assert len(found) == 6 and {r.score for r in found} == {0.0}
    assert not next(r for r in found if r["_id"] is None).held_out
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 7), (9, 0)], "doc_id bigint, toxic int")
    assert len(toxicity.toxicity(docs, odd).collect()) == 6
    stage = toxicity.toxicity_stage(docs, none)
    assert stage.columns == docs.columns and stage.count() == 6
    assert toxicity.toxicity(documents([]), none).collect() == []


@pytest.mark.parametrize("marks", [[1] * 40, [0] * 40, [1, 0] * 20])
def test_labels_without_evidence_drop_nothing(spark, documents, marks):
    """One class only, or classes whose texts do not differ: no document is dropped."""
    docs = documents([(i, f"plain words {i} of no kind") for i in range(40)] + [(99, None)])
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id bigint, toxic int")
    assert toxicity.toxicity_stage(docs, labels).count() == 41


def test_isotonic_curve():
    x, y = np.array([0.0, 1, 1, 2, 3, 4]), np.array([0.0, 1, 0, 0, 1, 1])
    at, value = toxicity.isotonic(x, y, np.ones(6))
    assert value == pytest.approx(sorted(value)) and value[-1] == 1 and at[0] == 0
