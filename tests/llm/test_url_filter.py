import math
import random
from collections import Counter, defaultdict

from tidemark.llm import url_filter

URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "http://x.com/a", "HTTP://WWW.EXAMPLE.COM/en/1", "https://example.com/en/",
    "https://m.example.com/en/7?x=://y", "https://www.example.com/EN/", "http://net/es/", "http://a.net/fr/b#c", "http://a.net/de/", "http://xnet/es/",
    "http://\u00c9A.org/q?z", "http://user@h.org:80/p/a", "x://a.com?b/", "http://examplexcom/en/",
]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    return host, path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def rule(host, path):
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def brute(urls):
    rows = [(*parts(u), *rule(*parts(u))) for u in urls]
    counts = {"allow": defaultdict(Counter), "block": defaultdict(Counter)}
    grams = lambda s: [("\x02" * 5 + s + "\x03")[i : i + 6] for i in range(len(s) + 1)]
    for host, path, _, verdict in rows:
        if verdict:
            for g in grams(host + path):
                for n in range(6):
                    counts[verdict][g[5 - n : 5]][g[5]] += 1

    def chance(kind, gram):
        p = 1 / 256
        for n in range(6):
            seen = counts[kind][gram[5 - n : 5]]
            total, kinds = sum(seen.values()), len(seen)
            if total + kinds:
                p = (seen[gram[5]] + kinds * p) / (total + kinds)
        return p

    score = {}
    for host, path, *_ in rows:
        own = grams(host + path)
        score[host, path] = sum(math.log(chance("allow", g)) - math.log(chance("block", g)) for g in own) / len(own)
    allow = [math.floor(score[h, p] / 0.01) for h, p, _, v in rows if v == "allow"]
    block = [math.floor(score[h, p] / 0.01) for h, p, _, v in rows if v == "block"]
    least = 0.0
    if allow and block:
        steps = sorted({*allow, *block, max(allow + block) + 1})
        quality = lambda t: sum(a >= t for a in allow) / len(allow) + sum(b < t for b in block) / len(block)
        least = max(steps, key=lambda t: (round(quality(t), 9), -abs(t), t)) * 0.01
    return [(h, p, r, v or ("allow" if score[h, p] >= least else "block")) for h, p, r, v in rows]


def judged(spark, urls):
    pages = spark.createDataFrame([(i, u, i) for i, u in enumerate(urls)], "page_id int, url string, rule int")
    rows = sorted(url_filter.judge_urls(pages).collect())
    return [(r.host, r.path, r.rule, r.verdict) for r in rows]


def test_odd_urls(spark):
    assert judged(spark, URLS) == brute(URLS)


def test_random_urls(spark):
    rng = random.Random(8)
    urls = []
    for _ in range(400):
        host = rng.choice(["a.com", "example.com", "www.example.com", "b.net", "c.org", "m.d.net"])
        urls.append(f"http://{host}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.choice(['news', 'casino', 'cheap'])}{rng.randrange(30)}")
    assert judged(spark, urls) == brute(urls)


def test_one_class_and_none(spark):
    for urls in (["http://a.com/x"] * 3 + ["http://b.org/x"], ["http://b.org/", None], []):
        assert judged(spark, urls) == brute(urls)
