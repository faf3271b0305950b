import random

from tillstar.llm import url_filter


def plain(url, rules):
    """Host, path, rule and verdict by trying every rule."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fit = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def check(spark, urls, rules):
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    found = url_filter.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.EXAMPLE.NET/en/x?q#f", "http://example.net", "http://net/", "ftp://xnet/en/",
            "http://a.net?x=/en/", "http://É.example.com/de/ü", "x://y://example.com/de/", "http://.net/", "http://net./", "http://a..com/de/",
            "http://example.com/DE/", "http://example.net/en/\nmore", "http://b.org/fr/", "http://b.org/fr/"]
    check(spark, urls, RULES)


def test_nested_rules_over_partitions(spark):
    rng = random.Random(9)
    label, step = "abc-", ["", "/", "/a", "/a/", "/a/b", "/aa", "/b"]
    hosts = [".".join(rng.choice(label) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    rules = sorted({(rng.choice(hosts), rng.choice(step)) for _ in range(60)})
    rules = [(*r, rng.choice(["allow", "block"])) for r in rules]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(step)}{rng.choice(['', 'x', '/b?q'])}" for _ in range(300)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            check(spark, urls, rules)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_rules_that_clash_or_are_missing(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (1, "http://a.b/c")], "page_id bigint, url string")
    rules = spark.createDataFrame([("a.b", "/", "allow"), ("A.B", "/", "block"), (None, "/", "block"), ("b", None, "block")], "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()] == [("a.b/", "block")] * 2
    assert [r.verdict for r in url_filter.judge(pages, rules.limit(0), default="block").collect()] == ["block"] * 2
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_native_plan(spark):
    pages = spark.range(3).selectExpr("id AS page_id", "concat('http://h', id, '.net/') AS url")
    rules = spark.sql("SELECT 'net' AS host, '/' AS path, 'block' AS verdict")
    plan = url_filter.judge(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
