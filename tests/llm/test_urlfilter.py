import random
import re

from strata.llm import urlfilter as U

SCHEMA = "page_id long, url string, host string, rule string, best int"
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("A.Com", "/de/x", "allow"), ("a.com", "/de/x", "block"),
         (None, "/", "block"), ("net", None, "block"), ("net", "/", "other"), ("example.org", "", "block")]


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
        path = re.match(r"[^?#]*", rest[len(raw):])[0]
    fits = [(len(h + p), a == "block", h + p) for h, p, a in
            ((re.sub("[A-Z]", lambda m: m[0].lower(), h), p, a) for h, p, a in rules
             if h is not None and p is not None and a in ("allow", "block"))
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    _, block, rule = max(fits)
    return host, path, rule, "block" if block else "allow"


URLS = [None, "", "nothing", "http://", "http://org", "http://org/", "http://ORG/x", "https://a.Example.org/es/x?q#f",
        "https://example.org/en/14", "x://notexample.org/es/", "http://a.com/de/xyz", "http://a..com/fr/", "http://.com/fr/",
        "http://x.com/fr/?://y.org/", "http://x.net/", "ftp://u@h.com:80/de/", "http:///es/", "http://é.org/é/ü#",
        "http://x.com?/fr/", "http://" + "a." * 300 + "org/" + "p/" * 3000, "://org/\nx"]


def test_equals_plain(spark):
    rng = random.Random(1)
    urls = URLS + ["http://" + ".".join(rng.choices(["a", "example", "org", "com"], k=rng.randint(1, 4)))
                   + rng.choice(["", "/", "/es/", "/en/1", "/fr/x", "/de/x", "/de"]) for _ in range(150)] + URLS[4:8]
    df = spark.createDataFrame([(i, u, "h", "r", 0) for i, u in enumerate(urls)] + [(None, "http://org/", None, None, None)],
                               SCHEMA)
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    out, at = U.judge(df, rules)
    assert out.columns[:5] == df.columns and not set(at.values()) & set(df.columns)
    rows = out.collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        assert tuple(r[at[n]] for n in ("host", "path", "rule", "verdict")) == plain(r.url, RULES), r.url


def test_empty(spark):
    df = spark.createDataFrame([(1, "http://org/", None, None, None)], SCHEMA)
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    out, at = U.judge(df, rules.limit(0), default="block")
    assert [(r[at["rule"]], r[at["verdict"]]) for r in out.collect()] == [(None, "block")]
    assert U.judge(df.limit(0), rules)[0].collect() == []


def test_many_shapes_and_a_very_long_url(spark):
    long = "http://www.a.com/" + "x/" * 500_000
    rules = [("a.com", "/" + "x/" * k, "block" if k % 2 else "allow") for k in range(2000)] + [
        (".".join(["b"] * k) + ".org", "/" + "y" * k, "block") for k in range(1, 60)] + [
        ("c.net", "/" + "z" * k, "allow") for k in range(3000)]
    urls = [long, "http://a.com/x/x/x", "http://" + "b." * 30 + "org/" + "y" * 29, "http://c.net/zzz", "http://c.net", None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    out, at = U.judge(df, spark.createDataFrame(rules, "host string, path string, action string"))
    for r in out.collect():
        assert tuple(r[at[n]] for n in ("host", "path", "rule", "verdict")) == plain(r.url, rules), r.page_id


def test_a_hot_url_is_judged_once(spark):
    df = spark.range(30_000).selectExpr("id as page_id", "if(id % 3 = 0, 'http://example.org/es/1', concat('http://', id, '.com/fr/')) as url")
    out, at = U.judge(df, spark.createDataFrame(RULES, "host string, path string, action string"))
    assert {(r[0], r[1]): r[2] for r in out.groupBy(at["rule"], at["verdict"]).count().collect()} == {
        ("example.org/es/", "block"): 10_000, ("com/fr/", "allow"): 20_000}
