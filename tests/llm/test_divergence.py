import random
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import divergence
from tidemark.llm.divergence import Gathered, pieces_of

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = "lang string, source string, text string"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=30, ranks=50):
    """Rows (lang, source, part, item, value, rank) by plain dictionaries."""
    in_docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall(lowered(text or ""))
        groups[lang].add(source)
        in_docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    found = []
    for lang, sources in groups.items():
        kept = [t for t, n in in_docs[lang].items() if n >= least]

        def chances(source):
            of = counts[lang, source]
            total = sum(of[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (of[t] + 5) // (total + 5 * len(kept)) for t in kept}

        all_p = {s: chances(s) for s in [*sources, None]}
        for s in sources:
            pairs = [(sum(abs(all_p[s][t] - all_p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [
                (all_p[s][t] - all_p[None][t], t)
                for t in kept
                if counts[lang, s][t] and all_p[s][t] > all_p[None][t]
            ]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                found += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(items[:most], 1)]
    return sorted(found)


def result(docs, **options):
    return sorted(map(tuple, divergence.divergence(docs, **options).collect()))


def corpus(seed, count, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(words)] + ["é", "É", "ßx", "日本"]
    rows = []
    for _ in range(count):
        source = rng.choice([None, "", "a", "b", "hot", "hot", "hot", "é"])
        few = rng.sample(vocabulary, 12) + ["The", "the"] * 3
        text = rng.choice([" ", ", ", "1", "\n"]).join(rng.choices(few, k=rng.choice([1, 5, 40])))
        lang = rng.choice([None, "", "en", "en", "en", "de"])
        rows.append((lang, source, rng.choice([text, text, text, text.upper(), None, "", "12 34"])))
    return rows


def test_against_brute_force(spark):
    rows = corpus(1, 900)
    assert result(spark.createDataFrame(rows, COLUMNS)) == brute(rows)


@pytest.mark.parametrize("bits", [0, 3, 6])
def test_terms_that_share_a_digest_are_told_apart(spark, bits):
    rows = corpus(2, 500)
    assert result(spark.createDataFrame(rows, COLUMNS), least=8, ranks=7, digest_bits=bits) == brute(rows, 8, 7)


def test_small_pieces_and_tables_change_nothing(spark, monkeypatch):
    rows = corpus(3, 300)
    monkeypatch.setattr(divergence, "GATHERED", 20)
    monkeypatch.setattr(divergence, "PIECE", 16)
    monkeypatch.setattr(divergence, "CELLS", 50)
    assert result(spark.createDataFrame(rows, COLUMNS).repartition(7), least=5) == brute(rows, 5)


def test_a_vocabulary_too_large_for_the_tasks(spark, monkeypatch):
    rows = corpus(5, 300)
    monkeypatch.setattr(divergence, "KEPT_IN_TASKS", 3)
    assert result(spark.createDataFrame(rows, COLUMNS), least=5) == brute(rows, 5)


def test_groups_without_kept_terms(spark):
    rows = [("en", "a", "one"), ("en", "b", None), (None, None, None), ("de", "c", "zwei")]
    assert result(spark.createDataFrame(rows, COLUMNS)) == brute(rows)
    assert brute(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_empty_table_and_clashing_columns(spark):
    assert result(spark.createDataFrame([], COLUMNS)) == []
    rows = corpus(4, 200)
    clash = COLUMNS + ", term string, n int, digest int, value int, rank int, item string, p int"
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3, 4, "y", 5) for r in rows], clash)
    assert result(docs, least=4) == brute(rows, 4)


def test_ties_at_the_last_rank_go_by_item(spark):
    words = [f"t{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    rows = [("en", "a", " ".join(words))] * 30 + [("en", "b", "other " * 9)] * 30
    found = result(spark.createDataFrame(rows, COLUMNS))
    assert found == brute(rows)
    assert [r[3] for r in found if r[1] == "a" and r[2] == "term"] == sorted(words)[:50]


def test_counts_too_large_for_64_bits_times_the_scale(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(10**12, 3 * 10**12 + 1, 10**7)], "n bigint, t bigint, v bigint")
    got = row.select(divergence.probability(F.col("n"), F.col("t"), F.col("v"))).first()[0]
    assert got == 1 + 10**9 * (10**12 + 5) // (3 * 10**12 + 1 + 5 * 10**7)


def test_a_text_in_pieces_has_the_same_terms(monkeypatch):
    text = "Ab1cd\n" * 50 + "x" * 500 + " ÄÖ-ü\x85 "
    whole = TERM.findall(lowered(text))
    for size in (1, 7, 64, 10_000):
        monkeypatch.setattr(divergence, "PIECE", size)
        assert [t.decode() for part in pieces_of(text) for t in part] == whole


def test_digests_of_groups(spark):
    rows = spark.createDataFrame([("en", "a"), ("", ""), ("日", "é"), ("en", "b"), ("en", "a")], "lang string, source string")
    groups, seed = divergence.numbered_groups(rows)
    got = {(r["lang"], r["source"]): r["group"] for r in groups.collect()}
    assert got == {g: divergence.group_digest(seed, *g) for g in [("en", "a"), ("", ""), ("日", "é"), ("en", "b")]}


def test_documents_are_counted_once_a_term():
    found = Gathered(True, True)
    found.add(("en", "a"), "x x y")
    found.add(("en", "a"), "x")
    documents, times = found.groups["en", "a"]
    assert documents == {b"x": 2, b"y": 1} and times == {b"x": 3, b"y": 1} and found.size == 2
