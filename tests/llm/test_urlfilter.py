import time

from agendario.llm import urlfilter

SCHEMA = "page_id long, url string, html string, rule string, digest string"


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:end], rest[end:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[3], max(fits)[4]
    words = {w for label in host.split(".") for w in label.split("-")}
    return host, path, None, "block" if words & set(urlfilter.SUSPECT_WORDS) else "allow"


URLS = [
    "http://a.org/x", "https://WWW.Example.ORG/es/1", "http://example.org/en/12?q=/en/1", "http://example.org/en/2", "http://badexample.org/es/", "x://com", "http://b.com/fr/",
    "http://b.com/de", "http://b.com/de/#x", "http://net", "no scheme", "", None, "://", "http://É.com/fr/é", "http://cheap-pills.net/a", "http://spam.net", "a://b://c.com/de/", "http://x.com?/fr/", "http://u@y.org:80/",
]


def test_against_brute_force(spark):
    rows = [(i, u, None, "r", "d") for i, u in enumerate(URLS)] + [(None, URLS[0], "h", "r", "d"), (3, URLS[3], "h", "r", "d"), (3, URLS[3], "h", "r", "d")]
    rules = urlfilter.RULES + (("b.com", "", "allow"), ("example.org", "/es/", "allow"))
    expected = sorted([(r[0], *brute(r[1], rules)) for r in rows], key=repr)
    for most in (100, 0):
        got = urlfilter.judge(spark.createDataFrame(rows, SCHEMA), urlfilter.rule_table(spark, rules), max_broadcast_rules=most)
        assert sorted(map(tuple, got.collect()), key=repr) == expected


def test_a_host_of_very_many_labels_costs_no_more_than_the_rules_ask_for(spark):
    rows = [(1, "http://" + "a." * 20000 + "example.org/es/x", None, "", ""), (2, "http://" + "b" * 100000 + "/", None, "", ""), (3, "http://a.org/" + "x/" * 50000, None, "", "")]
    began = time.perf_counter()
    got = urlfilter.judge(spark.createDataFrame(rows, SCHEMA), urlfilter.rule_table(spark)).select("page_id", "rule", "verdict").orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(1, "example.org/es/", "block"), (2, None, "allow"), (3, "org/", "allow")]
    assert time.perf_counter() - began < 20


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert urlfilter.judge(none, urlfilter.rule_table(spark)).collect() == []
    one = spark.createDataFrame([(1, "http://a.org/", None, "", "")], SCHEMA)
    assert [tuple(r) for r in urlfilter.judge(one, urlfilter.rule_table(spark).limit(0)).collect()] == [(1, "a.org", "/", None, "allow")]
