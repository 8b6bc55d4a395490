import random

from pyspark.sql import functions as F

from catalogia.llm.url_filters import RULES, filter_urls

SCHEMA = "page_id long, url string"


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h), len(p), h + p, v) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def run(spark, urls, rules, **more):
    pages = spark.createDataFrame(list(enumerate(urls)), SCHEMA).withColumn("host", F.lit("h")).withColumn("key", F.lit(1))
    rows = filter_urls(pages, spark.createDataFrame(rules, RULES), "page_id", **more).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}


def test_equals_brute_force(spark):
    r = random.Random(4)
    hosts = ["org", "example.org", "a.example.org", "b.a.example.org", "example.com", "com", "xexample.org", "org.example"]
    paths = ["/", "/en/", "/en/1", "/en/12", "/e", "", "/en", "/fr/1/2/3"]
    rules = list({(r.choice(hosts), r.choice(paths)): r.choice(["allow", "block"]) for _ in range(25)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"{r.choice(['http', 'https', ''])}://{r.choice(['', 'www.', 'A.B.'])}{r.choice(hosts)}{r.choice(paths)}"
            f"{r.choice(['', '?q=/en/1', '#x://y', '/more'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "http://", "http:///x", "HTTP://EXAMPLE.ORG/EN/", "a://b://example.org/",
             "http://É.Org/en/1", "http://example.org.", "http://" + "a." * 300 + "org/x", "x\ny://org/\nz"]
    assert run(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_frequent_domain_is_split(spark, monkeypatch):
    import catalogia.llm.url_filters as m
    monkeypatch.setattr(m, "SWEEP_ROWS", 3)
    rules = [("org", "/", "allow"), ("org", "/1", "block"), ("org", "/12", "allow")]
    urls = [f"http://h{i % 3}.org/{i}" for i in range(60)] * 2
    assert run(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_rules_without_meaning_and_empty_tables(spark):
    rules = [(None, "/", "block"), ("org", None, "block"), ("org", "/a", None), ("ORG", "/b", "allow"), ("org", "/b", "block")]
    assert run(spark, ["http://org/b", "http://net/"], rules) == {
        0: ("org", "/b", "org/b", "block"), 1: ("net", "/", None, "allow")}
    assert run(spark, ["http://org/b", None], []) == {0: ("org", "/b", None, "allow"), 1: ("", "", None, "allow")}
    assert run(spark, [], rules, default="block") == {}
