"""Rules against plain Python, and held-out accuracy of the regression."""

import pytest

from lexiloom.llm import url_filter
from lexiloom.llm.queries import URL_RULES
from lexiloom.llm.url_labels import labelled_urls

URLS = [None, "", "no scheme", "http://", "http://example.net/en/1", "https://A.EXAMPLE.net/EN/1", "http://x.org/fr/?q", "http://notnet/",
        "http://a.net", "http://a.net?x", "http://a.net/", "http://example.com/de/x", "http://sub.example.com/de/", "http://example.comm/de/",
        "ftp://u:p@host.org:80/fr/a#b", "a://b://c/d", "http://É.org/fr/", "http://net/x", "http://cheap-pills.example.com/", "http://x.net/" + "y" * 20_000]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    cut = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:cut]


def rule_of(host, path):
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(labelled_urls(spark))


def test_rules(spark, model):
    df = spark.createDataFrame([(i, u, "mine", "x") for i, u in enumerate([*URLS, URLS[4]])], "page_id long, url string, host string, _host string")
    judged = url_filter.judge(df, URL_RULES, model)
    assert judged.columns == ["page_id", "url", "_host", "host", "path", "rule", "verdict", "score"]
    rows = judged.collect()
    assert len(rows) == len(URLS) + 1 and {r._host for r in rows} == {"x"}
    for r in rows:
        rule = rule_of(*parts(r.url))
        assert (r.host, r.path) == parts(r.url) and r.rule == (rule and rule.text)
        assert r.verdict == (rule.verdict if rule else "block" if r.score > 0.5 else "allow")
    assert {r.verdict for r in rows if r.url and "cheap-pills" in r.url} == {"block"}
    assert url_filter.judge(df, [], model).where("rule IS NOT NULL").count() == 0
    assert url_filter.judge(df.limit(0), URL_RULES, model).count() == 0


def test_held_out_accuracy(spark):
    rows = [(r.url, r.label) for r in labelled_urls(spark).collect()]
    hits = 0
    for fold in range(3):
        learn = spark.createDataFrame(rows[fold::3] + rows[(fold + 1) % 3::3], "url string, label int")
        test = spark.createDataFrame(rows[(fold + 2) % 3::3], "url string, label int")
        hits += url_filter.judge(test, [], url_filter.train(learn)).where("(score > 0.5) = (label = 1)").count()
    assert hits / len(rows) > 0.7  # of words that no other labelled url may hold; half by chance


def test_labels_hold_no_host_of_the_test_pages(spark):
    def words(url):
        name = parts(url)[0].rsplit(".example.", 1)[0].rsplit(".", 1)[-1]
        return frozenset(name.split("-"))
    pages = {words(r.url) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").where("url LIKE '%.example.%'").collect()}
    for r in labelled_urls(spark).collect():
        assert not any(w and w <= words(r.url) for w in pages - {frozenset([""])}), r.url


def test_tables_of_one_class_and_none(spark):
    def score(rows):
        made = url_filter.train(spark.createDataFrame(rows, "url string, label int"))
        return url_filter.judge(spark.createDataFrame([("http://a/",)], "url string"), [], made).first().score
    assert score([]) == 0 and score([(None, 1), ("x", None)]) == 0 and score([("http://a/", 1)]) == 1


def test_rules_of_any_number(spark):
    """100,000 rules as a table, with repeated ones and rules for a domain, its parent and several paths."""
    made = spark.range(100_000).selectExpr("'block' AS verdict", "concat('h', id, '.com') AS host", "'/' AS path").unionByName(
        spark.createDataFrame([("allow", "h7.com", "/ok/"), ("allow", "h7.com", "/ok/"), ("block", "h7.com", "/ok/no"), ("allow", "com", "/"),
                               ("block", "www.h7.com", "/")], "verdict string, host string, path string"))
    urls = ["http://h7.com/", "http://h7.com/ok/x", "http://H7.com/ok/now", "http://www.h7.com/ok/", "http://a.b.h99999.com/z", "http://xh7.com/",
            "http://h7.com", "http://org/", None]
    got = {r.url: (r.rule, r.verdict) for r in url_filter.judge(
        spark.createDataFrame([(u,) for u in urls], "url string"), made, url_filter.Model([], 0.0, 0.0)).collect()}
    assert [got[u] for u in urls] == [
        ("h7.com/", "block"), ("h7.com/ok/", "allow"), ("h7.com/ok/no", "block"), ("www.h7.com/", "block"), ("h99999.com/", "block"),
        ("com/", "allow"), (None, "allow"), (None, "allow"), (None, "allow")]


def test_a_hot_host(spark):
    """A host of most rows: whole results with the broadcast of its rules switched off."""
    urls = spark.range(20_000).selectExpr("id", "if(id % 10 = 0, concat('http://s', id, '.org/fr/'), 'http://hot.example.net/en/') AS url")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = url_filter.judge(urls, URL_RULES, url_filter.Model([], 0.0, 0.0)).groupBy("rule", "verdict").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert sorted(map(tuple, rows)) == [("example.net/en/", "allow", 18_000), ("org/fr/", "allow", 2_000)]
