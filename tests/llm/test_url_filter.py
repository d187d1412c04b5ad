from pyspark.sql import functions as F

from hyetos.llm import url_filter
from hyetos.llm.queries import URL_RULES
from hyetos.llm.url_filter import judge, rules_frame

URLS = [
    "https://a.example.org/es/9", "https://example.org/es/", "http://EXAMPLE.org/en/17?x=/es/",
    "https://notexample.org/es/1", "https://b.com/fr/2", "https://b.com/de/2#top", "https://b.com",
    "https://org/", "https://example.org", "ftp://x.net/a", "no scheme/es/", "", None,
    "https://x.org?u=http://example.org/es/", "://example.org/es/1", "https://a.org:80/x",
    "https://../es/", "a://b://c.com/de/",
]


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        ends = [i for i, c in enumerate(rest) if c in "/?#"]
        host = rest[: ends[0]] if ends else rest
        path = rest[len(host):].split("?")[0].split("#")[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if host and r[0] and (host == r[0] or host.endswith("." + r[0]))
            and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return (host, path, best and best[0] + best[1], best[2] if best else default)


def test_judges_like_a_plain_loop(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(0, URLS[0], "x")],
                                  "page_id long, url string, rule string")
    more = URL_RULES + [("", "/", "block"), ("b.com", "", "block"), ("org", "", "block")]
    found = judge(pages, rules_frame(spark, more)).collect()
    assert len(found) == len(URLS) + 1
    for row in found:
        assert (row.host, row.path, row.rule, row.verdict) == plain(URLS[row.page_id], more)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, URLS[0])], "page_id long, url string")
    none = rules_frame(spark, [])
    assert judge(pages, none, "block").first().verdict == "block"
    assert judge(pages.limit(0), rules_frame(spark, URL_RULES)).count() == 0


def test_prefixes_that_collide_change_nothing(spark, monkeypatch):
    keyed = url_filter._keyed
    monkeypatch.setattr(url_filter, "_keyed", lambda df: keyed(df).withColumn("prefix", F.lit(1).cast("long")))
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for row in judge(pages, rules_frame(spark, URL_RULES)).collect():
        assert (row.host, row.path, row.rule, row.verdict) == plain(URLS[row.page_id], URL_RULES)
