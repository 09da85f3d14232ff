"""Log parsing: hand-made lines, and net changes against a plain loop."""

import random

import pytest

from tidemark.operators import merge, wal

LONG = "x''y " * 200_000


def parsed(spark, lines, keys, schema="data", table="users"):
    df = spark.createDataFrame(list(enumerate(lines)), "lsn bigint, data string")
    rows = wal.parse_changes(df, schema, table, keys).collect()
    return sorted((r["lsn"], r["op"], *[r[k] for k in keys]) for r in rows)


@pytest.mark.parametrize(
    "line, expected",
    [
        ("table data.users: INSERT: pkid[integer]:7 name[text]:'a'", [("I", 7)]),
        ("table data.users: UPDATE: name[character varying]:'it''s' pkid[bigint]:8", [("U", 8)]),
        ("table data.users: DELETE: pkid[integer]:9", [("D", 9)]),
        # The key's look-alike inside a text value, in another column's name, and in an array.
        ("table data.users: UPDATE: note[text]:'pkid[integer]:5 ' pkid[integer]:7", [("U", 7)]),
        ("table data.users: UPDATE: old_pkid[integer]:5 pkid[integer]:7", [("U", 7)]),
        ("table data.users: UPDATE: tags[text[]]:'{\"pkid[integer]:5\"}' pkid[integer]:7", [("U", 7)]),
        # Key changes, and full row images that change nothing about the key.
        (
            "table data.users: UPDATE: old-key: pkid[integer]:1 new-tuple: pkid[integer]:2 n[text]:'z'",
            [("D", 1), ("U", 2)],
        ),
        (
            "table data.users: UPDATE: old-key: pkid[integer]:1 n[text]:'new-tuple: pkid[integer]:3' "
            "new-tuple: pkid[integer]:1 n[text]:'b'",
            [("U", 1)],
        ),
        # Line breaks and very long values.
        ("table data.users: INSERT: n[text]:'a\nb' pkid[integer]:4", [("I", 4)]),
        (f"table data.users: INSERT: n[text]:'{LONG}' pkid[integer]:4", [("I", 4)]),
        # No change of this table.
        ("BEGIN 77", []),
        ("COMMIT 77", []),
        ("table data.users: TRUNCATE: (no-flags)", []),
        ("table data.users_archive: INSERT: pkid[integer]:7", []),
        ("table other.users: INSERT: pkid[integer]:7", []),
        ("table data.posts: INSERT: n[text]:'table data.users: DELETE: pkid[integer]:1'", []),
    ],
)
def test_one_line(spark, line, expected):
    assert parsed(spark, [line], {"pkid": "bigint"}) == [(0, *e) for e in sorted(expected)]


@pytest.mark.parametrize(
    "line",
    [
        "table data.users: DELETE: (no-tuple-data)",
        "table data.users: INSERT: name[text]:'a'",
        "table data.users: INSERT: pkid[integer]:null",
        "table data.users: INSERT: pkid[text]:'abc'",
    ],
)
def test_unreadable_key_is_rejected(spark, line):
    df = spark.createDataFrame([(1, line)], "lsn bigint, data string")
    changes = wal.parse_changes(df, "data", "users", {"pkid": "bigint"})
    assert wal.rejected_changes(changes, ["pkid"]).count() == 1
    assert wal.net_changes(changes, ["pkid"]).count() == 0


def test_text_and_composite_keys(spark):
    lines = [
        "table data.users: UPDATE: b[integer]:2 a[text]:'it''s' c[date]:'2024-01-02'",
        "table data.users: UPDATE: old-key: a[text]:'x' b[integer]:1 new-tuple: a[text]:'y' b[integer]:1",
    ]
    assert parsed(spark, lines, {"a": "string", "b": "int"}) == [
        (0, "U", "it's", 2),
        (1, "D", "x", 1),
        (1, "U", "y", 1),
    ]


def test_printed_identifiers(spark):
    line = 'table "My Schema"."Users": INSERT: "Key Id"[integer]:3'
    assert parsed(spark, [line], {"Key Id": "int"}, "My Schema", "Users") == [(0, "I", 3)]


def _log(seed, keys, length):
    rng = random.Random(seed)
    # A third of the log belongs to one key.
    pick = lambda: 0 if rng.random() < 0.34 else rng.randrange(keys)
    return [(lsn, rng.choice("IUUD"), pick()) for lsn in range(length)]


@pytest.mark.parametrize("policy", wal.POLICIES)
def test_net_changes_equal_a_replay(spark, policy):
    log = _log(1, 300, 4000)
    expected = {}
    for lsn, op, key in log:
        if policy == "delete_wins" and expected.get(key, ("",))[0] == "D":
            op = "D"
        expected[key] = (op, lsn)
    df = spark.createDataFrame(log, "lsn bigint, op string, k bigint").repartition(5)
    got = {r["k"]: (r["op"], r["lsn"]) for r in wal.net_changes(df, ["k"], policy).collect()}
    assert got == expected


def test_upsert_decides_at_equal_position(spark):
    df = spark.createDataFrame([(5, "D", 1), (5, "U", 1)], "lsn bigint, op string, k bigint")
    assert wal.net_changes(df, ["k"]).first()["op"] == "U"


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        wal.net_changes(spark.createDataFrame([], "lsn bigint, op string, k bigint"), ["k"], "x")


def test_converges_and_repeats(spark, values):
    """After an apply every touched key equals the source; applying again changes nothing."""
    log = spark.createDataFrame(_log(2, 200, 1500), "lsn bigint, op string, k bigint")
    net = wal.net_changes(log, ["k"])
    # The source is what the log leads to: keys whose last change is no delete.
    alive = net.filter("op <> 'D'")
    source = alive.selectExpr("k", "lsn * 10 AS v").unionByName(spark.range(200, 250).selectExpr("id AS k", "0L AS v"))
    target = spark.range(0, 400, 3).selectExpr("id AS k", "-1L AS v")
    once = merge.apply_changes(target, source, net, ["k"])
    twice = merge.apply_changes(once, source, net, ["k"])
    assert values(once) == values(twice)
    touched = once.join(net.select("k"), "k", "left_semi")
    assert values(touched, "k", "v") == values(alive.selectExpr("k", "lsn * 10"))
    untouched = once.join(net.select("k"), "k", "left_anti")
    assert values(untouched) == values(target.join(net.select("k"), "k", "left_anti"))


def test_preview_cuts_and_counts(spark):
    lines = [f"table data.users: INSERT: pkid[integer]:{i} n[text]:'{'z' * 200}'" for i in range(150)]
    df = spark.createDataFrame(list(enumerate(lines)), "lsn bigint, data string")
    rows = wal.preview(df, "data", "users").orderBy("lsn").collect()
    assert [r["lsn"] for r in rows] == list(range(10))
    assert {r["total_found"] for r in rows} == {100}
    assert all(len(r["text"]) == 103 and r["text"].endswith("...") for r in rows)
