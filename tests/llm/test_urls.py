import re

from lectern.llm import urls

URLS = [
    "http://example.net/en/1", "https://sub.example.net/en", "https://Example.NET/en/x?y#z", "http://notexample.net/en/", "http://net", "http://net/",
    "ftp://a.b.org/fr/?q", "http://org/fr", "http://www.casino-win.example.org/en/1", "http://mycasino.org/", "http://x.org/casino", "no scheme", "", None,
    "http://example.com/de/1", "http://example.com/de", "http://a.example.com/de/", "x://", "http://u:p@example.net:80/en/1", "http://a.org\n/fr/", "HTTP://A.ORG/fr/x/casino",
]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for name, verdict in urls.HOST_RULES:
        h, slash, p = name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p) and (best is None or len(name) > len(best[0])):
            best = name, verdict
    if best:
        return (host, path, *best)
    bad = any(re.search(rf"(^|[^a-z0-9]){w}([^a-z0-9]|$)", host) for w in urls.WORDS)
    return host, path, None, "block" if bad else "allow"


def test_like_every_rule_on_every_url(spark):
    rows = [(i, u, 1, "x") for i, u in enumerate(URLS * 2)] + [(None, URLS[0], 1, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule int, best string")
    got = sorted(urls.verdicts(pages).collect(), key=str)
    assert sorted([(r[0], *brute(r[1])) for r in rows], key=str) == [tuple(r) for r in got]
    assert urls.verdicts(pages.limit(0)).collect() == []
    assert urls.judge(pages, urls.default_rules()).columns == [*pages.columns, "__judged"]


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://common.example.net/{i}") for i in range(20)] + [(20, "http://rare.common.net/")], "page_id bigint, url string")
    rules = [urls.pattern_rule("r", "block", "rare", ["common", "rare"]), urls.pattern_rule("n", "block", "never", ["common", "never"])]
    addresses = pages.select(urls._tokens(urls.host_of(pages.url), urls.path_of(pages.url)).alias("tokens"))
    index = {r.rule: r.token for r in urls.index_rules(addresses, urls.rule_table(spark, rules)).collect()}
    assert index == {"r": "rare", "n": "never"}
    assert {r.page_id for r in urls.judge(pages, rules).where("__judged.verdict = 'block'").collect()} == {20}
