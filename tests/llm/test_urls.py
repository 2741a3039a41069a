import re

from samples import clashing

from imageset_spark.llm import url_rules
from imageset_spark.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "https://Example.ORG/es/x", "http://a.example.org/en/17?x=1", "http://a.example.org/en/2",
    "http://example.org", "http://notexample.org/es/", "https://x.com/fr/", "https://x.com/de/1#f", "https://com/de/",
    "https://x.com/d", "ftp://u@h.org:80/a", "http://b.org/p?u=http://x.com/de/", "://org/x", "http://org.com/fr/a/../b",
    "http://é.org/ü", "http:///es/", "http://a..org/x", "https://EXAMPLE.org/es/x",
]


def model(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fit, default=None)
    return host, path, rule and rule[1], rule[2] if rule else "allow"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(urls)], "page_id bigint, url string, html string")


def test_verdicts_match_the_model(spark):
    rules = url_rules.rule_table(spark, URL_RULES)
    urls = URLS + URLS[3:9] + ["https://x.com/de/1#f"] * 50
    out = url_rules.judge_urls(clashing(pages(spark, urls)), rules).collect()
    assert len(out) == len(urls)
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == model(r.url), r.url


def test_precedence_and_empty_tables(spark):
    rules = url_rules.rule_table(spark, [("allow", "a.b", "/x"), ("block", "b", "/xyz"), ("block", "c", "/"), ("allow", "c", "/")])
    out = url_rules.judge_urls(pages(spark, ["http://a.b/xyz", "http://q.c/", "http://a.b/x"]), rules).collect()
    # The same length in all: the longer host; equal rules: block.
    assert [(r.rule, r.verdict) for r in sorted(out, key=lambda r: r.page_id)] == [
        ("a.b/x", "allow"), ("c/", "block"), ("a.b/x", "allow")]
    none = rules.limit(0)
    assert {r.verdict for r in url_rules.judge_urls(pages(spark, URLS), none, default="block").collect()} == {"block"}
    assert url_rules.judge_urls(pages(spark, []), rules).collect() == []
