import pytest

from hourglass.llm.url_filter import RULES, filter_urls, rules_frame

PAGES = "page_id long, url string, host string, rule string"


def judged(spark, urls, rules=RULES):
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], PAGES)
    return {r["page_id"]: tuple(r)[1:] for r in filter_urls(pages, rules_frame(spark, rules)).collect()}


def brute(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
    tail = rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fit)[3:]) if fit else (host, path, None, "allow")


URLS = [None, "", "no scheme", "://", "http://", "http://com/", "http://COM", "http://a.com/x?y=1#z", "https://example.com/en/1",
        "https://WWW.example.com/en/1", "https://m.www.example.com/en/", "https://notexample.com/en/", "http://x.net/es/2",
        "http://net/fr/", "http://x.net/es", "http://a..com/", "http://.com/q", "http://x.net#/es/", "http://a.com?/en/",
        "http://u@example.com:80/en/", "http://ü.example.com/en/ä", "http://" + "a." * 3000 + "net/es/", "http://net/es/" + "x/" * 5000,
        "ftp://a://b.net/es/", "http://example.com/en/1", "http://example.com/en/1"]


def test_verdicts_match_brute_force(spark):
    got = judged(spark, URLS)
    assert got == {i: brute(u, RULES) for i, u in enumerate(URLS)}


def test_ties_prefixes_and_repeated_rules(spark):
    rules = [("allow", "b.com", "/xy"), ("block", "a.b.com", "/"), ("block", "b.com", "/xy"), ("allow", "b.com", ""), ("block", "b.com", "/xy")]
    urls = ["http://a.b.com/xyz", "http://b.com/xyz", "http://c.b.com/", "http://b.com"]
    assert judged(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


@pytest.mark.parametrize("rules", [RULES, ()])
def test_empty_sides(spark, rules):
    pages = spark.createDataFrame([], PAGES)
    assert filter_urls(pages, rules_frame(spark, rules)).collect() == []
    assert judged(spark, ["http://a.com/"], ())[0] == ("a.com", "/", None, "allow")


def test_null_keys_and_repeated_rows_stay(spark):
    pages = spark.createDataFrame([(None, "http://a.com/"), (None, None), (1, "http://a.com/"), (1, "http://a.com/")], "page_id long, url string")
    assert sorted(r["verdict"] for r in filter_urls(pages, rules_frame(spark)).collect()) == ["allow"] * 4


def test_no_python_in_the_plan(spark):
    plan = filter_urls(spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string"), rules_frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
