import random

import numpy as np

from chatledger.llm import url_filter as U

RULE_TYPE = "verdict string, host string, path string"


def judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        (len(h + p), len(h), h + p, v) for v, h, p in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def held(spark, urls, rules, **options):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id bigint, url string, host string, keys string")
    got = {r.page_id: tuple(r)[1:] for r in U.filter_urls(df, spark.createDataFrame(rules, RULE_TYPE), **options).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert got[i] == judge(u, rules), u


def test_contract_rules(spark):
    urls = [
        None, "", "no scheme/en/", "http://", "http://com/", "http://com", "HTTP://WWW.Example.COM/en/x?y#z",
        "http://www.example.com/en", "http://a.www.example.com/en/", "http://notexample.com/en/", "https://x.net/es/1",
        "https://x.net/ES/1", "a://b://c.net/fr/", "http://net/fr/", "http://x.example.com#/en/", "http://x.com?/",
        "http://ÄB.com/", "http://x.com/\n/y", "http://..com/", "http://x.com./",
    ]
    held(spark, urls + urls, U.RULES)


def test_random_rules(spark):
    rnd = random.Random(5)
    host = lambda: ".".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4)))
    path = lambda: "/" + "".join(rnd.choice("xy/") for _ in range(rnd.randint(0, 4)))
    rules = {(host(), path() if rnd.random() < 0.8 else ""): rnd.choice(("allow", "block")) for _ in range(150)}
    rules = [(v, h, p) for (h, p), v in rules.items()]
    urls = [f"http://{host()}{path()}" for _ in range(800)]
    held(spark, urls, rules)
    held(spark, urls, rules, max_bytes=100)  # in parts


def test_many_path_lengths(spark, monkeypatch):
    """More lengths than are listed one by one: the same verdicts, also of clashing columns."""
    rnd = random.Random(8)
    path = lambda n: "/" + "".join(rnd.choice("ab/") for _ in range(n))
    long = path(1600)
    rules = [(rnd.choice(("allow", "block")), rnd.choice(("x.com", "com")), long[: n + 1]) for n in range(1500)]
    rules = list({(h, p): (v, h, p) for v, h, p in rules}.values())
    urls = [f"http://a.x.com{long[: rnd.randint(0, 1601)]}" for _ in range(30)] + ["http://b.com/", f"http://y.net{long}"]
    held(spark, urls, rules)
    monkeypatch.setattr(U, "MAX_LENGTHS", 3)
    hosts = [(rnd.choice(("allow", "block")), rnd.choice(("x.com", "com", "a.x.com")), path(n)) for n in range(6) for _ in range(4)]
    hosts = list({(h, p): (v, h, p) for v, h, p in hosts}.values())
    held(spark, [f"http://{rnd.choice(('a.x.com', 'x.com', 'q.com'))}{path(rnd.randint(0, 7))}" for _ in range(300)], hosts)


def test_no_rules_no_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    none = spark.createDataFrame([], RULE_TYPE)
    assert [tuple(r) for r in U.filter_urls(pages, none).collect()] == [(1, "a.b", "/c", None, "allow")]
    rules = spark.createDataFrame(U.RULES, RULE_TYPE)
    assert U.filter_urls(pages.limit(0), rules).count() == 0


def test_cascade_is_exact_and_small(spark):
    universe = spark.range(60_000).selectExpr("concat('k', id) key")
    listed = spark.range(0, 60_000, 25).selectExpr("concat('k', id) key")
    cascade = U.build(listed, universe, 60_000)
    rows = universe.select("key", *U._hashed("key")).toArrow().to_pydict()
    got = cascade.members(np.array(rows["h1"]), np.array(rows["h2"]))
    assert [k for k, m in zip(rows["key"], got) if m] == [k for k in rows["key"] if int(k[1:]) % 25 == 0]
    assert len(cascade.levels) > 2
    assert sum(bits for _, bits, _ in cascade.levels) < 2400 * 16
