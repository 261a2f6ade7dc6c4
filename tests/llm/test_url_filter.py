import re

import pytest

from placelake.llm import url_filter as u

RULES = [("net", "/", "block", "net/"), ("example.net", "/en/", "allow", "example.net/en/"),
         ("example.com", "/de/", "block", "example.com/de/"), ("org", "/fr/", "allow", "org/fr/")]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[3]), default=None)
    return host, path, best and best[3], best and best[2]


@pytest.fixture(scope="module")
def model(spark):
    return u.fit_url_model(u.labelled_urls(spark))


def test_rules_equal_brute_force(spark, model):
    urls = [None, "", "example.net/en/", "http://example.net", "http://EXAMPLE.net/", "http://a.example.net/en/x?y", "x://example.net/EN/",
            "http://badexample.com/de/", "http://b.Example.com/de/1#f", "https://x.org/fr/", "https://org/fr/", "https://xorg/fr/a",
            "http://a?b://c/d", "a://b#c/d", "http://h/p://q", "http://KÉ.net/\n/x", "://x.net/", "http://x.example.net/en", "h://" + "a" * 50000,
            "http://cheap-pills.example.com/en/"]
    rows = spark.createDataFrame([(k, url, "x", "x") for k, url in enumerate(urls)] + [(None, urls[-1], "x", "x")] * 2,
                                 "page_id long, url string, host string, features string")
    got = u.url_verdicts(rows, model).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        host, path, rule, verdict = brute(urls[r["page_id"]] if r["page_id"] is not None else urls[-1])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow"))
    assert u.url_verdicts(rows.filter("false"), model).count() == 0


def test_urls_that_were_not_trained_on(spark, model):
    urls = [("https://www.cheap-pills.example.org/es/998.html", 1), ("http://m.spam-farm.example.com/fr/12", 1),
            ("https://casino-bonus.example.org/en/x", 1), ("http://discount-pills.example.com/en/5", 1),
            ("https://www.ththon.example.org/en/31", 0), ("http://thernd.example.com/es/640.html", 0),
            ("https://blog.tionble.example.org/en/12/", 0), ("http://news.garden.example.com/fr/3", 0)]
    rows = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(urls)], "page_id long, url string, label int")
    got = {r["page_id"]: r["score"] >= 0.5 for r in u.url_verdicts(rows, model, rules=[]).collect()}
    assert [got[k] for k in range(len(urls))] == [bool(y) for _, y in urls]


def test_no_python_in_the_plan(spark, model):
    rows = spark.range(10).selectExpr("id AS page_id", "concat('http://h', id, '.org/') AS url")
    plan = u.url_verdicts(rows, model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
