import random

from conftest import groups

from tidemark.llm.components import connected


def roots(spark, links):
    rows = connected(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()
    return {r.node: r.root for r in rows}


def check(spark, links):
    nodes = {n for link in links for n in link}
    want = {n: r for n, r in groups(nodes, links).items() if n != r}
    assert roots(spark, links) == want


def test_random_links(spark):
    rng = random.Random(1)
    check(spark, [(rng.randrange(400), rng.randrange(400)) for _ in range(260)])


def test_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)] + [(2000, 1049)]
    check(spark, chain + star)


def test_no_links_and_loops(spark):
    assert roots(spark, []) == {}
    assert roots(spark, [(5, 5), (-3, 5), (5, -3)]) == {5: -3}
