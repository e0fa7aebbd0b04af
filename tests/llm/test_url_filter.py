import random
import re

import pytest

from sluice.llm.url_filter import GlobAutomaton, UrlRule, judge_urls

RULES = [
    UrlRule("allow", "com"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"), UrlRule("block", "net", "/fr/"),
]


def as_regex(glob):
    out, i = "", 0
    while i < len(glob):
        if glob[i] == "\\":
            i += 1
            out += re.escape(glob[i])
        elif glob.startswith("**", i):
            out, i = out + ".*", i + 1
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(glob[i], re.escape(glob[i]))
        i += 1
    return re.compile(out, re.S)


def test_automaton_agrees_with_regular_expressions():
    globs = [g for r in RULES for g in r.globs()] + ["*a**b?c*", "**", "?", "", "\\*x", "*", "a*", "***b"]
    parts = ["com", "example", ".", "/", "en", "net", "es", "www", "a", "b", "c", "*x", "é", "?", "\U0001F600"]
    rng = random.Random(1)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + ["a/" * 500]
    found = GlobAutomaton(globs).matches(texts)
    for g, glob in enumerate(globs):
        want = [bool(as_regex(glob).fullmatch(t)) for t in texts]
        assert found[:, g].tolist() == want, glob


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    raw = re.match(r"[^/?#]*", rest)[0]
    host = raw.translate({c: c + 32 for c in range(65, 91)})
    path = re.match(r"[^?#]*", rest[len(raw):], re.S)[0]
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://Www.EXAMPLE.com/en/x?y#z", "http://example.com", "http://a.example.com/en/",
        "ftp://x.net/es/1", "http://net/fr/", "http://xnet/fr/", "x://y://z.net/es/", "http://a.com?b=/en/", "http://evil.org/x.com/",
        "http://example.com/en", "http://a.net/es/" + "q" * 100_000, "http://ÉXAMPLE.com/ü", "http://www.example.com:80/en/", "://.com/",
    ]
    rows = [(i, u, "taken") for i, u in enumerate(urls)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = judge_urls(df, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == brute(urls[r.page_id]), urls[r.page_id]
    assert judge_urls(df.limit(0), RULES).count() == 0
    with pytest.raises(ValueError):
        judge_urls(df, [])


def test_default_verdict_and_ties(spark):
    df = spark.createDataFrame([(1, "http://a.b/c/d")], "page_id long, url string")
    rules = [UrlRule("allow", "b", "/c/d"), UrlRule("block", "a.b", "/c")]
    assert judge_urls(df, rules).first().verdict == "block"  # equally long: the longer host
    assert judge_urls(df, RULES, default="block").first().verdict == "block"
