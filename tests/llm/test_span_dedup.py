import random
import re

from tidemark.llm import span_dedup
from tidemark.llm.queries import op8_span_dedup

PASSAGE = (
    "The river ran low that summer and nobody spoke of it. Old boats lay in the reeds! "
    "Was it the third dry year in a row, or the fourth already? The ferryman knew. "
    "He kept a notch for every week without rain on the post by his door."
)


def brute(rows):
    """Clean text of each row when every run of any number of sentences counts; rows are unique."""
    split = {i: [s for s in re.findall(r".*?(?:[.!?]\s+|\n\s*|\Z)", t or "", re.S) if s] for i, t in rows}
    plain = {i: [" ".join(s.lower().split()) for s in parts] for i, parts in split.items()}
    full = {i: [n for n, s in enumerate(parts) if s] for i, parts in plain.items()}

    def runs():
        for i, places in full.items():
            for k in range(len(places)):
                key, words = (), 0
                for end, n in enumerate(places[k:], k + 1):
                    key, words = hash((key, plain[i][n])), words + len(plain[i][n].split())
                    if words >= 24 or end - k >= 3 and words >= 12:
                        yield key, i, k, end

    first, gone = {}, {}
    for key, i, k, _ in runs():
        first[key] = min(first.get(key, (i, k)), (i, k))
    for key, i, k, end in runs():
        if first[key] != (i, k):
            gone.setdefault(i, set()).update(full[i][k:end])
    return {
        i: "".join(s for n, s in enumerate(split[i]) if n not in gone[i]).rstrip() if i in gone else t for i, t in rows
    }


def test_random_texts_against_brute_force(documents):
    rng = random.Random(4)
    pool = [" ".join(rng.choices("abcdefg", k=rng.randrange(1, 9))) + rng.choice([". ", "! ", "\n", "? \n", " . "]) for _ in range(14)]
    rows = [(i, rng.choice(["", "\n ", " "]) + "".join(rng.choices(pool, k=rng.randrange(0, 14)))) for i in range(120)]
    got = {r.doc_id: r.text for r in span_dedup.span_dedup(documents(rows)).collect()}
    assert got == brute(rows)


def test_passage_stays_once_wherever_it_stands(documents):
    rng = random.Random(1)
    rows = []
    for i in range(40):
        own = [" ".join(f"{rng.choice('pqrst')}{rng.randrange(10**6)}" for _ in range(9)) + ". " for _ in range(6)]
        at = rng.randrange(7)
        rows.append((i, "".join(own[:at]) + PASSAGE + "\n" + "".join(own[at:])))
    got = span_dedup.span_dedup(documents(rows)).collect()
    texts = {r.doc_id: r.text for r in got}
    assert PASSAGE in texts[0] and texts[0] == rows[0][1]
    assert all("ferryman" not in texts[i] and "boats" not in texts[i] for i in range(1, 40))
    assert all(len(texts[i].split()) == 54 for i in range(1, 40))
    for r in got:
        ranges = [tuple(map(int, x.split(":"))) for x in r.removed.split(",") if x]
        whole = rows[r.doc_id][1]
        assert r.n_removed == len(whole) - len(r.text)
        assert all("ferryman" in whole[a:b] for a, b in ranges)


def test_runs_of_any_number_of_sentences(documents):
    rng = random.Random(8)
    sizes = [1, 1, 2, 3, 5, 11, 13, 15, 15, 23, 24, 30]
    pool = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) + ". " for n in sizes]
    rows = []
    for i in range(150):
        own = " ".join(f"x{rng.randrange(10**9)}" for _ in range(10)) + ". "
        at = rng.randrange(len(pool))
        rows.append((i, own + "".join(pool[at : at + rng.randrange(1, 7)]) + own.upper() + rng.choice(pool)))
    got = {r.doc_id: r.text for r in span_dedup.span_dedup(documents(rows)).collect()}
    assert got == brute(rows)


def test_end_of_a_passage_and_long_sentences(documents):
    rng = random.Random(9)
    text = lambda *sizes: "".join(" ".join(f"v{rng.randrange(10**9)}" for _ in range(n)) + ". " for n in sizes)
    passage, long_ = text(15, 15, 15, 15, 5), text(60)
    rows = [(0, passage + text(9)), (1, text(9) + passage + text(9)), (2, long_), (3, text(9) + long_), (4, long_)]
    got = {r.doc_id: r.text for r in span_dedup.span_dedup(documents(rows)).collect()}
    assert got[0] == rows[0][1] and got[2] == rows[2][1] and got[4] == ""
    assert len(got[1].split()) == 18 and len(got[3].split()) == 9


def test_odd_rows(documents):
    rows = [(1, None), (1, PASSAGE), (1, PASSAGE), (2, PASSAGE), (None, PASSAGE), (None, None), (3, ""), (4, PASSAGE + " " + PASSAGE)]
    docs = documents(rows, removed=("int", 1), _starts=("int", 2))
    got = sorted(((r.doc_id, r.text) for r in span_dedup.span_dedup(docs).collect()), key=repr)
    want = [(1, None), (1, ""), (1, ""), (2, ""), (None, PASSAGE), (None, None), (3, ""), (4, "")]
    assert got == sorted(want, key=repr)
    assert span_dedup.span_dedup(documents([])).collect() == []


def test_table_against_brute_force(spark, whole):
    rows = [(r.doc_id, r.text) for r in whole("documents").collect()]
    got = {r.doc_id: r.text for r in op8_span_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute(rows)
