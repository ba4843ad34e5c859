"""URL filter: rules by hand, membership by sets, false positives removed."""

import re

from railflow.llm import urls as U

URLS = ["http://a.com/x", "HTTPS://www.Example.com/en/1.html", "http://m.example.com/en/1?x=1", "x.net/es/", None, "", "a://",
        "http://net/es/1#y", "http://a.net/fr/2/", "http://anet/fr/2", "https://www.example.com/de/5", "http://b.org",
        "http://b.org/?q=://c.net/es/", "ftp://B.ORG/#f", "http://example.com/en", "http://xexample.com/en/"]


def by_hand(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    plain = re.sub(r"^(www|m)\.(?=[^.]+\.)", "", host) + re.sub(r"(\.html|/)$", "", path) if host else None
    return host, path, rule, verdict, plain


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    listed = spark.createDataFrame([("https://b.org/",), ("http://www.xexample.com/en/",), (None,), ("http://b.org",)], "url string")
    names = {by_hand(u)[4] for u in ("https://b.org/", "http://www.xexample.com/en/")}
    for r in U.judge(pages, listed).collect():
        host, path, rule, verdict, plain = by_hand(URLS[r.page_id])
        assert (r.host, r.path, r.rule, r.canonical_url) == (host, path, rule, plain)
        assert r.verdict == (verdict or ("block" if plain in names else "allow"))
    assert U.judge(pages, listed).count() == len(URLS)
    assert all(not r.listed for r in U.judge(pages, listed.limit(0)).collect())
    assert U.judge(pages.limit(0), listed).collect() == []


def test_filter_has_no_false_negatives_and_the_join_no_false_positives(spark):
    listed = spark.range(5000).selectExpr("concat('h', id, '.org/p') AS u")
    asked = spark.range(2500, 12500).selectExpr("concat('h', id, '.org/p') AS u")
    for n in (None, 16):            # 16: a filter far too small lets nearly all pass
        rows = U.with_listed(asked, listed, "u", n).collect()
        assert len(rows) == 10_000
        inside = {r.u for r in rows if r.listed}
        assert inside == {f"h{i}.org/p" for i in range(2500, 5000)}
        assert inside <= {r.u for r in rows if r.maybe_listed}
        passed = sum(r.maybe_listed and not r.listed for r in rows)
        assert passed < 200 if n is None else passed > 5000


def test_filter_is_bounded():
    assert U.block_count(10 ** 12) == U.MAX_BLOCKS and U.block_count(0) == 1
