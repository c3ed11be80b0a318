import random

from strandwise.llm.url_filter import RULES, CascadeParams, Rule, build_cascade, url_filter

URLS = [
    (1, "http://example.org/es/1"), (2, "https://a.EXAMPLE.org/en/12?x"), (3, "http://x.org"), (4, "http://x.org/"), (5, "ftp://b.com/fr/"),
    (6, "http://b.com/de/#f"), (7, "http://notexample.org/es/"), (8, None), (9, "no scheme"), (10, ""), (11, "http://"), (12, "http://org/a"), (13, "http://.org/a"),
    (14, "http://b.com:80/de/"), (15, "http://ÄB.org/É"), (16, "http://example.org/en/2"), (17, "http://b.com/fr/?q=://c.org/"), (18, "http://b.com?x=/de/"), (18, "http://b.com?x=/de/"), (None, "http://x.org/"), (19, "http://a\nb.org/p\nq?r\ns"),
]


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
    host, slash, path = rest.partition("/")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = slash + path
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.key), len(r.host)), default=None)
    return host, path, best and best.key, best.verdict if best else default


def check(spark, urls, rules):
    df = spark.createDataFrame([(*u, "x", "y") for u in urls], "page_id long, url string, host string, rule string")
    got = sorted(map(tuple, url_filter(df, rules).collect()), key=str)
    assert got == sorted([(i, *brute(u, rules)) for i, u in urls], key=str)


def test_the_rules(spark):
    check(spark, URLS, RULES)


def test_many_rules(spark):
    rng = random.Random(3)
    hosts = [".".join(rng.choice("abcdef") * rng.randint(1, 2) for _ in range(rng.randint(1, 3))) for _ in range(40)]
    rules = list({r.key: r for r in (Rule(rng.choice(hosts), "/" + rng.choice(["", "p", "q/", "longer/"]), rng.choice(["allow", "block"])) for _ in range(60))}.values())
    urls = [(i, f"http://{rng.choice(['', 'w.', 'x.y.'])}{rng.choice(hosts)}/{rng.choice(['', 'p', 'q/z', 'longer/x', 'r'])}") for i in range(300)]
    check(spark, urls, rules)


def test_no_rules_and_no_pages(spark):
    check(spark, URLS[:3], ())
    assert url_filter(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(4000).selectExpr("concat('k', id) AS key")
    listed = spark.range(0, 4000, 7).selectExpr("concat('k', id) AS key")
    cascade = build_cascade(listed, universe, 1, CascadeParams(hashes=2))
    assert len(cascade.levels) > 1
    from pyspark.sql import functions as F

    hit = universe.where(cascade.contains(F.col("key")))
    assert hit.exceptAll(listed).count() == 0 and listed.exceptAll(hit).count() == 0
