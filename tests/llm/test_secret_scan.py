import hashlib
import random
import re

from tidemark.llm import secret_scan
from tidemark.llm.queries import op2_secret_scan

ASSIGN = r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""


def plain_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


ODD = [
    "token=secret:abcdefghij", "PASSWORD : 'hunter2hunter2'", 'api_key="abc" apikey=12345678', "password=secret=abcdefgh",
    "tokEN = x" * 3, "\u017fecret=abcdefgh1 to\u212aen=abcdefgh1", "é🎉 token: ABCDEFGH-1", "AKIAAKIA12345678 AKIA123",
    "f" * 31 + " " + "0123456789abcdef" * 2 + "g" + "a" * 40, "token=" + "a1" * 20, "secret=\nabcdefgh", "passwd\t=abcdefgh",
]


def test_base_spans_of_odd_and_random_texts():
    rng = random.Random(2)
    parts = ["token", "Secret", "api_key", "=", ":", " ", "'", '"', "AKIA", "ABCD1234", "0a1b2c3d", "x.y", "é", "\n"]
    texts = ODD + ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(3000)]
    for text in texts:
        got = [(kind, start, end) for start, end, kind, _ in secret_scan.base_spans(text)]
        assert got == plain_spans(text)


def test_automata_tell_formats_apart():
    rng = random.Random(3)
    keys = ["key-" + "".join(rng.choices("ABCDEF0123456789", k=24)) for _ in range(300)]
    plain = ["".join(rng.choices("aeinorst", k=9)) + "." + "".join(rng.choices("0123456789", k=8)) for _ in range(300)]
    model = secret_scan.fit({"assign": keys[:200], "access": [], "hex": []}, plain[:200])
    assert sum(model.score(k) >= model.threshold for k in keys[200:]) >= 85
    assert sum(model.score(p) >= model.threshold for p in plain[200:]) <= 1
    assert model.credentials[0].visits == sum(i % 3 > 0 for i in range(200))


def test_without_examples_nothing_is_added():
    model = secret_scan.fit({"assign": ["abcdefgh1"], "access": [], "hex": []}, ["x1" * 10] * 50)
    assert not model.credentials


def test_any_share_of_credentials_among_the_tokens():
    rng = random.Random(6)
    key = lambda: "".join(rng.choices("0123456789ABCDEF", k=28))
    word = lambda: "".join(rng.choices("aeinorst", k=9)) + "." + "".join(rng.choices("0123456789", k=8))
    known = [key() for _ in range(200)]
    for bare, plain in ((0, 400), (60, 240), (200, 200), (360, 40), (300, 0)):
        tokens = [key() for _ in range(bare)] + [word() for _ in range(plain)]
        rng.shuffle(tokens)
        model = secret_scan.fit({"assign": known, "access": [], "hex": []}, tokens)
        accepted = [t for t in tokens if model.score(t) >= model.threshold]
        assert sum("." not in t for t in accepted) >= 0.85 * bare
        assert sum("." in t for t in accepted) <= 0.02 * plain


def test_new_credentials_of_a_known_format(documents):
    rng = random.Random(4)
    key = lambda: "".join(rng.choices("0123456789ABCDEF", k=28))
    rows = [(i, f"some words token: {key()} and more") for i in range(150)]
    rows += [(1000 + i, f"see chapter{rng.randrange(10**9)}.of-the-book-{i} today") for i in range(150)]
    rows += [(2000 + i, f"bare {key()} here") for i in range(10)]
    found = {r._id: [s.kind for s in r.spans] for r in secret_scan.find_secrets(documents(rows)).collect()}
    assert all(found[i] == ["assign"] for i in range(150))
    assert sum(found.get(2000 + i) == ["format"] for i in range(10)) >= 8
    assert not any(1000 + i in found for i in range(150))


def test_query_has_base_spans_of_every_document(spark, whole):
    texts = {r.doc_id: r.text for r in whole("documents").collect()}
    for r in op2_secret_scan(spark, "/root/testdata/sf0.001").collect():
        base = plain_spans(texts[r.doc_id])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for k, *_ in base) for n in ("assign", "access", "hex")]
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(r.spans.split(",")) | {""}


def test_stage_masks_secrets_and_keeps_documents(documents):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (51, ""), (None, "token=abcdefgh1"), (0, "clean"), (0, "clean")]
    docs = documents(rows, _spans=("int", 1), spans=("int", 2))
    out = secret_scan.secrets_stage(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert not plain_spans(r.text) and (r.text is None or r.n_chars == len(r.text))
    want = []
    for i, t in rows:
        clean, end = "", 0
        for _, s, e in plain_spans(t):
            if s >= end:
                clean += t[end:s] + "[SECRET]"
            end = max(end, e)
        want.append((i, None if t is None else clean + t[end:]))
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert secret_scan.secrets_stage(documents([])).collect() == []
