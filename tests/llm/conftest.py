import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A documents table of (id, text) pairs, with any further columns."""

    def make(rows, **more):
        columns = COLUMNS + "".join(f", {name} {kind}" for name, (kind, _) in more.items())
        extra = [value for _, value in more.values()]
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t), *extra) for i, t in rows], columns
        )

    return make


@pytest.fixture
def whole(spark):
    """A table of the smallest data set."""
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


def groups(nodes, links):
    """Least node that links reach, for each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
