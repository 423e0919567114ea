from math import isclose, log

from tallyhouse.llm import urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    best = None
    for h, p, v in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return best or (None, None)


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/1", "http://example.net/en", "x://EXAMPLE.net/en/?q", "http://net/", "http://net", "http://a.net?x=/",
    "http://notexample.com/de/", "http://b.example.com/de/#a", "http://ÄB.org/fr/", "http://org/fr/x?y", "http://a.org/en/", "http://a.org#/fr/", "a://b://c.net/x\ny",
    "http://example.net:80/en/", "http://u@example.net/en/", "http://x.com/" + "long/" * 5000,
]


def test_rules(spark):
    rows = [(i, u, "h", 1.0) for i, u in enumerate([*URLS, *URLS[:3]])] + [(None, "http://a.net/", "h", 1.0)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string, score double")).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for i, u, *_ in rows:
        r = by_id[i]
        assert (r.host, r.path) == split(u), u
        name, verdict = rule(r.host, r.path)
        assert r.rule == name and (verdict is None or r.verdict == verdict) and r.verdict in ("allow", "block")


def training(n=400):
    good = [f"https://www.site{i}.org/fr/article-{i}" for i in range(n)]
    bad = [f"http://casino-win{i}.net/bonus?{i}" for i in range(n)]
    rest = [f"https://www.site{i}.com/article-{i}" for i in range(50)] + [f"http://casino-win{i}.com/bonus?{i}" for i in range(50)]
    return good + bad + rest


def test_model_separates_and_threshold_holds(spark):
    rows = list(enumerate(training()))
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    free = [r for r in got if r.rule is None]
    assert len(free) == 100
    assert sum((r.verdict == "block") == ("casino" in r.host) for r in free) >= 97
    assert all((r.score is None) == (r.rule is not None) for r in got) and len({r.threshold for r in got}) == 1


def test_scores_against_plain_counts():
    """The interpolated chances, from contexts and counts as strings."""
    good, bad, probe = ["ab/c1", "ab/d"], ["ba?x", "bb?xx"], "ab?x9"
    counts = {False: [{} for _ in range(4)], True: [{} for _ in range(4)]}
    plain = {False: [{} for _ in range(4)], True: [{} for _ in range(4)]}
    for side, texts in ((False, good), (True, bad)):
        for t in texts:
            c = urls._classes(t)
            for i in range(3, len(c)):
                for order in range(4):
                    gram = tuple(c[i - order : i + 1])
                    code = sum(x * urls.KINDS**k for k, x in enumerate(reversed(gram)))
                    counts[side][order][code] = counts[side][order].get(code, 0) + 1
                    plain[side][order][gram] = plain[side][order].get(gram, 0) + 1

    def chance(side, gram):
        p = 1 / urls.KINDS
        for order in range(4):
            context = gram[3 - order : 3]
            of = [(g, n) for g, n in plain[side][order].items() if g[:-1] == context]
            if not of:
                break
            n, kinds = sum(x for _, x in of), len(of)
            p = (plain[side][order].get(gram[3 - order :], 0) + kinds * p) / (n + kinds)
        return p

    c = urls._classes(probe)
    grams = [tuple(c[i - 3 : i + 1]) for i in range(3, len(c))]
    want = sum(log(chance(True, g)) - log(chance(False, g)) for g in grams) / len(grams)
    assert isclose(urls.Model(counts).score(probe), want, rel_tol=1e-12)
    assert isclose(sum(chance(True, (1, 2, 3, k)) for k in range(urls.KINDS)), 1.0)


def test_one_sided_and_empty(spark):
    got = urls.judge(spark.createDataFrame([(1, "http://a.net/"), (2, "http://b.com/")], "page_id long, url string")).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "allow"}
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
