"""URL rules against a plain scan of all rules."""

import random

import pytest

from murmura.llm import urls

AWKWARD = [
    None, "", "no scheme", "://", "http://", "http://a.NET", "http://a.net/", "HTTP://Example.NET/en", "http://example.net/en/",
    "http://x.example.net/en/1?q=/de/", "http://notexample.net/en/x", "http://example.com/de/#x", "http://example.com/deep",
    "http://org/fr/", "http://a..org/fr/x", "http://net:80/", "x://y://net/", "http://\n.net/a\nb", "http://.net/", "http://É.ORG/fr/É",
    "http://example.net?/en/", "http://a.org/fr/" + "s/" * 20_000,
]


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (h.count("."), len(p), verdict == "block")
            best = max(best or (key,), (key, h + p, verdict))
    return host, path, *(best[1:] if best else (None, default))


def table(spark, texts):
    rows = [(i, u, "h", "p", "r", "f", "v") for i, u in enumerate(texts)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, path string, rule string, found string, verdict string")


def drawn(n, seed=5):
    r = random.Random(seed)
    host = lambda: ".".join(r.choice(["a", "b", "com", "net"]) for _ in range(r.randint(1, 4)))
    path = lambda: "".join("/" + r.choice(["", "en", "enter", "d", "de"]) for _ in range(r.randint(0, 4)))
    rules = [(r.choice(["allow", "block"]), host(), path()) for _ in range(n)]
    return rules, [f"http://{host()}{path()}{r.choice(['', '/', '?x=/en', '#/d'])}" for _ in range(600)]


@pytest.mark.parametrize("trie_chars", [urls.TRIE_CHARS, 0])
def test_judged_is_a_scan_of_all_rules(spark, trie_chars):
    rules, seen = drawn(150)
    for chosen, texts in ((rules, seen), (urls.RULES, AWKWARD + ["http://a.net/"] * 3)):
        got = urls.judged(table(spark, texts), urls.rule_table(spark, chosen), trie_chars=trie_chars).orderBy("page_id").collect()
        assert [tuple(r[1:]) for r in got] == [brute(u, chosen) for u in texts]


def test_rules_are_normalised_and_may_be_missing(spark):
    rules = [("block", None, "/"), (None, "a", "/"), ("block", "NET", None), ("maybe", "org", "/"), ("allow", "net", "")]
    pages = table(spark, ["http://net", "http://x.org/"])
    got = urls.judged(pages, urls.rule_table(spark, rules)).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in got] == [("net", "block"), (None, "allow")]
    got = urls.judged(pages, urls.rule_table(spark, []), default="block").collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "block")] * 2
    assert urls.judged(pages.limit(0), urls.rule_table(spark, rules)).count() == 0


def test_a_rule_of_any_depth_and_its_cost():
    trie = urls.Trie([("block", "net", "/a" * 5000), ("allow", ".".join("a" * 5000) + ".net", "/")])
    assert trie.find("net", "/a" * 5001) == ("net" + "/a" * 5000, "block")
    assert trie.find("x." + ".".join("a" * 5000) + ".net", "/")[1] == "allow"
