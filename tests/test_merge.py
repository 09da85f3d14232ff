"""Upsert and delete edge cases."""

import pytest

from tidemark.operators import merge

COLUMNS = "k bigint, j bigint, v string"


def frame(spark, *rows, schema=COLUMNS):
    return spark.createDataFrame(list(rows), schema)


def test_upsert(spark, values):
    target = frame(spark, (1, 1, "a"), (2, 1, "b"))
    source = frame(spark, (2, 1, "B"), (3, 1, "C"))
    assert values(merge.merge_upsert(target, source, ["k"])) == [(1, 1, "a"), (2, 1, "B"), (3, 1, "C")]


def test_composite_key(spark, values):
    target = frame(spark, (1, 1, "a"), (1, 2, "b"))
    source = frame(spark, (1, 2, "B"), (2, 1, "C"))
    assert values(merge.merge_upsert(target, source, ["k", "j"])) == [
        (1, 1, "a"),
        (1, 2, "B"),
        (2, 1, "C"),
    ]


def test_null_keys_never_match(spark, values):
    target = frame(spark, (None, 1, "a"), (1, None, "b"))
    source = frame(spark, (None, 1, "A"), (1, None, "B"))
    merged = merge.merge_upsert(target, source, ["k", "j"])
    assert values(merged, "v") == [("A",), ("B",), ("a",), ("b",)]


def test_empty_source_and_target(spark, values):
    rows, nothing = frame(spark, (1, 1, "a")), frame(spark)
    assert values(merge.merge_upsert(rows, nothing, ["k"])) == [(1, 1, "a")]
    assert values(merge.merge_upsert(nothing, rows, ["k"])) == [(1, 1, "a")]


def test_merge_twice_equals_once(spark, values):
    target, source = frame(spark, (1, 1, "a"), (2, 2, "b")), frame(spark, (2, 3, "B"), (4, 4, "D"))
    once = merge.merge_upsert(target, source, ["k"])
    assert values(once) == values(merge.merge_upsert(once, source, ["k"]))


def test_dropped_source_column_keeps_target_values(spark, values):
    target = frame(spark, (1, 7, "a"), (2, 8, "b"))
    source = frame(spark, (2, "B"), (3, "C"), schema="k bigint, v string")
    assert values(merge.merge_upsert(target, source, ["k"])) == [(1, 7, "a"), (2, 8, "B"), (3, None, "C")]


def test_new_source_column_is_refused(spark):
    source = frame(spark, (1, 1, "a", 0), schema=COLUMNS + ", w int")
    with pytest.raises(ValueError, match="W"):
        merge.merge_upsert(frame(spark), source, ["k"])


def test_column_order_case_and_type(spark, values):
    target = frame(spark, (1, 1, "a"))
    source = frame(spark, ("B", 2, 1), schema="V string, J int, K int")
    merged = merge.merge_upsert(target, source, ["k"])
    assert merged.schema == target.schema
    assert values(merged) == [(1, 2, "B")]


def test_no_key(spark):
    with pytest.raises(ValueError):
        merge.merge_upsert(frame(spark), frame(spark), [])


def test_duplicate_keys(spark, values):
    df = frame(spark, (1, 1, "a"), (1, 1, "b"), (2, 1, "c"), (None, 1, "d"), (None, 1, "e"))
    assert values(merge.duplicate_keys(df, ["k", "j"])) == [(1, 1, 2)]
    assert merge.has_duplicate_keys(df, ["k"])
    assert not merge.has_duplicate_keys(df.filter("k IS NULL OR k = 2"), ["k"])


def test_delete(spark, values):
    target = frame(spark, (1, 1, "a"), (2, 1, "b"), (None, 1, "c"))
    doomed = frame(spark, (2,), (2,), (9,), (None,), schema="k bigint")
    assert values(merge.delete_by_keys(target, doomed, ["k"])) == [(1, 1, "a"), (None, 1, "c")]


def test_policies_differ_on_reinsert(spark, values):
    from tidemark.operators import wal

    log = frame(spark, (1, "D", 5), (2, "I", 5), schema="lsn bigint, op string, k bigint")
    target, source = frame(spark, (5, 1, "old")), frame(spark, (5, 1, "new"))

    def result(policy):
        net = wal.net_changes(log, ["k"], policy)
        return values(merge.apply_changes(target, source, net, ["k"], policy))

    assert result("last_change") == [(5, 1, "new")]
    assert result("delete_wins") == []


def test_policies_differ_on_key_gone_from_source(spark, values):
    from tidemark.operators import wal

    log = frame(spark, (1, "U", 5), schema="lsn bigint, op string, k bigint")
    target, source = frame(spark, (5, 1, "old")), frame(spark)

    def result(policy):
        net = wal.net_changes(log, ["k"], policy)
        return values(merge.apply_changes(target, source, net, ["k"], policy))

    assert result("last_change") == []
    assert result("delete_wins") == [(5, 1, "old")]
