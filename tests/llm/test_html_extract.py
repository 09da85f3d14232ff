import random

import pytest

from tidemark.llm import html_extract
from tidemark.llm.queries import op1_html_extraction

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p><article>x';</script></head><body>"
    "<nav><ul><li><a href='/a'>Menu one</a></li><li><a href='/b'>Menu two</a></li></ul></nav>"
    "<header>Site head</header><div class=\"ad big\">Buy this now</div>{}"
    "<aside>Side words</aside><section id='comments'><article><p>Reader says</p></article></section>"
    "<footer>&copy; Foot &middot; words</footer></body></html>"
)
CASES = [
    ("<article><h1>Title</h1><p>One  two\n three</p><p>Four</p></article>", "Title One two three Four"),
    ("<article><p>a<b>b</b>c<br>d &amp; e&nbsp;f &#233; &lt;b&gt; &am</p></article>", "abc d & e f é <b> &am"),
    ("<article><p>One<p>Two<div class=ads>no</div><p>Three <!-- gone > --> end</article>", "One Two Three end"),
    ("<article><p>x</p><form>Name <input> <button>Go</button></form><script>no</script><p>y</p></article>", "x y"),
    ("<article><p>x</p><div class='cookie-notice'><p>We use</p></div><nav>in</nav><p>y &quot;z&quot;</p></article>", 'x y "z"'),
    ("<main><p title='a>b' data-x=\"<p>\">Quoted</p><p>1 < 2 and 3 > 2</p></main>", "Quoted 1 < 2 and 3 > 2"),
    ("<div>You are here</div><article><p>Body</p></article><div>Next page of many</div>", "Body"),
    ("<ARTICLE><P>Upper</P><UL><LI>item</LI></UL><P>" + "more words " * 30 + "</P></ARTICLE>", "Upper item" + " more words" * 30),
]


@pytest.fixture(scope="module")
def weights(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    return html_extract.train(pages)


@pytest.mark.parametrize("body, want", CASES)
def test_main_text(weights, body, want):
    assert html_extract.main_text(PAGE.format(body), weights) == want


@pytest.mark.parametrize("name", ["p", "div"])
def test_without_marks_the_best_run_is_found(weights, name):
    text = " ".join(f"word{i}" for i in range(60))
    menu = "".join(f"<li><a href=/{i}>entry {i}</a></li>" for i in range(12))
    page = f"<body><ul>{menu}</ul><{name}>x</{name}><p>{text}</p><p>{text}</p><ul>{menu}</ul></body>"
    found = html_extract.main_text(page, weights)
    assert text in found and "entry" not in found


@pytest.mark.parametrize(
    "name, gone",
    [
        ("share-price", False), ("search-results-story", False), ("adventure", False), ("social-history", False),
        ("ad", True), ("lead ad-slot", True), ("comment-list", True), ("readerComments", True), ("cookie_notice", True),
        ("ad2", True), ("newsletter-signup box", True), ("site-header", True), ("share-buttons", True),
    ],
)
def test_names_that_only_contain_a_mark_stay(weights, name, gone):
    page = f"<body><article><p>First words.</p><div class='{name}'><p>Middle words.</p></div><p>Last words.</p></article></body>"
    assert ("Middle" in html_extract.main_text(page, weights)) is not gone


def run_score(blocks, weights):
    """Words less the tags and marks between the first and the last block."""
    score = sum(map(weights.value, blocks)) - sum(map(weights.cost, blocks[1:]))
    return score - html_extract.BORDER * sum(a.inside != b.inside for a, b in zip(blocks, blocks[1:]))


def test_scan_finds_the_best_of_all_runs(weights):
    rng = random.Random(12)
    for _ in range(150):
        parts = []
        for n in range(rng.randrange(1, 14)):
            tag = rng.choice(["p", "div", "li", "h2", "td", "section"])
            words = " ".join(f"w{n}x{i}" for i in range(rng.randrange(0, 25)))
            parts.append(rng.choice(["", "<hr>", "<ul>", "</ul>", "<table>"]) + f"<{tag}>{words}</{tag}>")
        if rng.random() < 0.5:
            parts.insert(rng.randrange(len(parts) + 1), "<article>" + parts.pop() + "</article>")
        page = "".join(parts)
        blocks = html_extract.blocks_of(page)
        for weighing in (weights, html_extract.Weights()):
            runs = {
                " ".join(b.text for b in blocks[i:j]): run_score(blocks[i:j], weighing)
                for i in range(len(blocks))
                for j in range(i + 1, len(blocks) + 1)
            }
            text = html_extract.main_text(page, weighing)
            assert not blocks or runs[text] == pytest.approx(max(runs.values()))


def test_learnt_weights_change_the_cut(spark):
    """Where side boxes are tables and text stands in list items, learnt weights say so."""
    side = "<table><tr><td>" + "stock item price list " * 4 + "</td></tr></table>"
    text = "<ul>" + "".join(f"<li>{'story words go on ' * 5}{i}</li>" for i in range(4)) + "</ul>"
    pages = [f"<body>{side * 2}<article>{text}</article>{side}</body>" for _ in range(30)]
    learnt, page = html_extract.learn(pages), f"<body>{side * 3}<div>{text}</div>{side * 3}</body>"
    with_, without = (html_extract.main_text(page, w) for w in (learnt, html_extract.Weights()))
    assert "stock" not in with_ and with_.count("story") == 20
    assert "stock" in without


def test_few_marked_pages_among_many_are_all_learnt_from(spark):
    body = "concat('<body><nav>Menu</nav><article><p>Own text ', id, '</p></article></body>')"
    marked = spark.range(8).selectExpr(f"{body} AS html")
    rest = spark.range(50_000).selectExpr("concat('<body><p>Page ', id, '</p></body>') AS html")
    assert html_extract.train(marked.unionByName(rest)) == html_extract.train(marked) != html_extract.Weights()


def test_weights_have_their_signs(weights):
    assert min(weights.tags.values()) > 0 and min(weights.words.values()) > 0
    assert weights.tags["li"] > weights.tags["p"] and weights.words["p"] > weights.words["li"]


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "</", "<!--", "<script>never closed", "just text", "<a b='c", "&", "<p>" * 5000, "<![CDATA[x]]>y"])
def test_broken_pages_do_not_fail(weights, page):
    html_extract.main_text(page, weights)


def test_pages_table(spark, whole):
    """Against the marked part, whose place the generator fixes."""
    import html
    import re

    pages = {r.page_id: r.html for r in whole("pages").collect()}
    for r in op1_html_extraction(spark, "/root/testdata/sf0.001").collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]*>", "\0", inside)).replace("\0", " ").split())
        assert (r.text, r.n_chars) == (want, len(want))


def test_odd_rows(spark):
    kind = "page_id bigint, url string, html string, text int, _html int"
    rows = [(1, None, None, 1, 1), (None, "u", "<p>a</p>", 1, 1), (2, "u", "", 1, 1), (2, "u", "<p>" + "é " * 200_000, 1, 1)]
    got = html_extract.extract(spark.createDataFrame(rows, kind)).collect()
    assert [r.n_chars for r in got] == [0, 1, 0, 399_999]
    assert html_extract.extract(spark.createDataFrame([], kind)).collect() == []
