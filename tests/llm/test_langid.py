import random
import zlib

import numpy as np

from tidemark.llm import langid
from tidemark.llm.queries import op13_language_id

DATA = "/root/testdata/sf0.1"
SOUNDS = {"aa": "ka lo mi ne su".split(), "bb": "tra pel von gri sch".split(), "cc": "ийо ван ста рек".split()}


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def make(seed, count, langs=SOUNDS):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        lang = rng.choice(list(langs))
        words = ["".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(6, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string" + more)


def found(docs):
    return {r["_id"]: r for r in langid.identify(docs).collect()}


def brute_bag(text):
    """Shares of subword rows, one by one."""
    data, counts = langid.word_bytes(text), {}
    for size, mix in zip(langid.SIZES, langid._MIX):
        for i in range(len(data) - size + 1):
            part = data[i : i + size]
            inner = part[1:-1]
            if b" " in inner or not part.strip(b" "):
                continue
            row = (int.from_bytes(part, "little") * mix % 2**32) >> (32 - langid.TABLE_BITS)
            counts[row] = counts.get(row, 0) + 1
    return {row: n / sum(counts.values()) for row, n in counts.items()}


def test_quality_on_held_out_rows(spark):
    langs = dict(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect())
    rows = op13_language_id(spark, DATA).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    judged = [r for r in rows if r.held_out and langs[r.doc_id] is not None and r.lang_pred != "und"]
    right = np.array([r.lang_pred == langs[r.doc_id] for r in judged])
    kept = np.array([not r.rejected for r in judged])
    assert right.mean() > 0.97
    assert right[kept].mean() > 0.98 and kept.mean() > 0.9


def test_made_up_languages(spark):
    rows = make(1, 600)
    got = found(frame(spark, rows))
    right = [got[i].lang_pred == lang for i, _, lang in rows if held(i)]
    assert sum(right) >= 0.98 * len(right)


def test_held_out_languages_do_not_matter(spark):
    rows = make(2, 300)
    turned = [(i, t, "zz" if held(i) else lang) for i, t, lang in rows]
    a, b = found(frame(spark, rows)), found(frame(spark, turned))
    assert a == b and "zz" not in {r.lang_pred for r in b.values()}


def test_defined_cases(spark):
    rows = make(3, 200)
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !", None), (1003, "kalomi nesu", None), (None, "trapel", "bb")]
    got = found(frame(spark, rows + odd))
    for i in (1000, 1001, 1002):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[1003].lang_pred == "aa" and got[None].lang_pred == "bb" and not got[None].held_out


def test_nothing_to_learn_from(spark):
    rows = [(i, "some text", None) for i in range(5)]
    assert {(r.lang_pred, r.score) for r in found(frame(spark, rows)).values()} == {("und", 0.0)}
    assert langid.identify(frame(spark, [])).collect() == []
    one = found(frame(spark, [(i, "some text", "en") for i in range(9)]))
    assert {(r.lang_pred, r.score) for r in one.values()} == {("en", 1.0)}


def test_clashing_columns_and_repeated_rows(spark):
    rows = make(4, 90)
    clash = ", _id int, _text string, _lang string, _hash int, score double, lang_pred string, n int"
    docs = frame(spark, [(*r, 1, "x", "y", 2, 0.5, "z", 3) for r in rows + rows[:5]], clash)
    assert len(langid.identify(docs).collect()) == 95


def test_a_rare_language_is_learnt(spark):
    rare = [(10_000 + i, t, lang) for i, t, lang in make(6, 40, {"cc": 0})]
    common = make(5, 900, {"aa": 0, "bb": 0})
    got = found(frame(spark, common + rare))
    right = [got[i].lang_pred == lang for i, _, lang in rare if held(i)]
    assert right and all(right)


def test_bags_against_brute_force():
    for text in ("", "a", "ab", "Ab, cd  ef1gh", "Ünï çø", "日本語 text", "- -"):
        rows, shares = langid.bag(text)
        want = brute_bag(text)
        assert dict(zip(rows.tolist(), shares.tolist())).keys() == want.keys()
        assert np.allclose([want[r] for r in rows.tolist()], shares)


def test_scores_do_not_depend_on_how_texts_are_grouped(monkeypatch):
    rows = make(7, 120)
    model = langid.fit([(lang, t) for _, t, lang in rows])
    texts = [t for _, t, _ in rows] + ["", "x", "long tra pel " * 400]
    whole = model.logits(texts, model.columns())
    for share in (16, 100, 5_000):
        monkeypatch.setattr(langid, "SHARE", share)
        assert np.allclose(model.logits(texts, model.columns()), whole, atol=1e-9)
    one_by_one = np.concatenate([model.logits([t], model.columns()) for t in texts])
    assert np.allclose(one_by_one, whole, atol=1e-9)


def test_calibration_rejects_until_enough_is_right():
    rng = np.random.default_rng(1)
    right = rng.integers(0, 2, 4_000)
    sure = rng.random(4_000) < 0.7
    answer = np.where(sure | (rng.random(4_000) < 0.5), right, 1 - right)
    strength = np.where(sure, 3.0, 0.2)
    logits = np.zeros((4_000, 2))
    logits[np.arange(4_000), answer] = strength
    model = langid.Model(["a", "b"], np.zeros((1, 1)), np.zeros((1, 2)))
    langid.calibrate(model, right, logits)
    chances = model.scores(logits)
    kept = chances.max(axis=1) >= model.least
    assert (answer == right)[kept].mean() >= 0.99 and abs(kept.mean() - 0.7) < 0.03
