from strataspark.llm import url_filter


def judged(spark, urls):
    rows = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, Verdict string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict_) for r in url_filter.filter_urls(rows).collect()}


def test_rules_and_edges(spark):
    urls = [
        "http://A.Example.ORG/es/1?x", "https://example.org/en/12#a", "https://example.org/en/2", "http://x.com/fr/", "http://x.com/de/7",
        "http://x.com/fr", "http://notexample.org/es/", "http://org", "no scheme", None, "", "http://www.spam-farm.example.net/a", "ftp://a.org:80/x",
        "x://?://b.org/", "http://x.com/de/7",
    ]
    got = judged(spark, urls)
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[2][2:] == ("org/", "allow")
    assert got[3][2:] == ("com/fr/", "allow") and got[4][2:] == ("com/de/", "block") == got[14][2:]
    assert got[5][2:] == (None, "allow")
    assert got[6][2:] == ("org/", "allow")
    assert got[7] == ("org", "", None, "allow")
    assert got[8] == got[9] == got[10] == ("", "", None, "allow")
    assert got[11][2:] == ("spam-farm.*/", "block")
    assert got[12][2:] == (None, "allow")
    assert got[13] == ("", "", None, "allow")


def test_rule_without_literal_and_empty_table(spark):
    rules = (url_filter.Rule("*/ads", "block"), url_filter.Rule("b.c/x*y/", "block"))
    rows = spark.createDataFrame([(1, "http://q.z/ads1"), (2, "http://a.b.c/x-y/1"), (3, "http://b.c/xy")], "page_id long, url string")
    got = {r.page_id: r.rule for r in url_filter.filter_urls(rows, rules=rules).collect()}
    assert got == {1: "*/ads", 2: "b.c/x*y/", 3: None}
    assert url_filter.filter_urls(rows.limit(0)).count() == 0


def test_columns_of_these_names_stay_and_shuffled_rules_agree(spark, monkeypatch):
    urls = ["http://example.org/es/x", "https://A.com/de/", "http://spam-farm.io/", None, "", "no scheme", "http://", "http://x.net/" + "y" * 200_000, "http://example.org/es/x"]
    pages = spark.createDataFrame([(i, u, "keep", "h", 7) for i, u in enumerate(urls)], "page_id long, url string, tier string, Host string, found int")
    got = sorted(map(tuple, url_filter.filter_urls(pages).collect()))
    assert url_filter.filter_urls(pages).columns == ["page_id", "url", "tier", "Host", "found", "host_", "path", "rule", "verdict", "tier_"]
    assert [r[2:5] for r in got] == [("keep", "h", 7)] * len(urls)
    assert [(r[5], r[7], r[8], r[9]) for r in got[:4]] == [("example.org", "example.org/es/", "block", 0), ("a.com", "com/de/", "block", 0), ("spam-farm.io", "spam-farm.*/", "block", 1), ("", None, "allow", None)]
    assert all(r[5:] == ("", "", None, "allow", None) for r in got[3:7]) and len(got[7][6]) == 200_001 and got[8][5:] == got[0][5:]
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 0)
    assert sorted(map(tuple, url_filter.filter_urls(pages).collect())) == got
    assert url_filter.filter_urls(pages.limit(0)).count() == 0
