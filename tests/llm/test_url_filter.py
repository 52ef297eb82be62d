import re

from helpers import collect
from layerwise.llm.url_filter import RULES, judge_urls

URLS = [(1, "https://WWW.A.Example.org/en/1?x#y"), (2, None), (3, "no scheme"), (4, "http://a.example.org"), (5, "ftp://b.com/fr/2"), (6, "x://b.com/de/3"),
        (7, "http://good.net/a"), (8, "http://bad.net/a"), (9, "http://m.bad.net/"), (9, "http://m.bad.net/"), (10, "http://notorg/"), (11, "http:///p"),
        (12, "a\nb://h.org/x\ny?z"), (13, "http://x.co.uk/"), (14, "http://com/fr/a"), (None, "http://notexample.org/es/")]


def parts(u):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def rule_of(host, path):
    fit = [(r, a) for a, r in RULES for h, p in [(r[:r.index("/")], r[r.index("/"):])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[0])) if fit else (None, None)


def run(spark, urls, outcomes):
    pages = spark.createDataFrame([(i, u, "h") for i, u in urls], "page_id long, url string, host string")
    return judge_urls(pages, spark.createDataFrame(outcomes, "url string, bad boolean"))


def test_parts_rules_and_reputation(spark):
    outcomes = [("http://bad.net/1", True)] * 60 + [("http://good.net/1", False)] * 60 + [("http://bad.net/", None), (None, True)]
    out = run(spark, URLS, outcomes)
    want = []
    for i, u in URLS:
        host, path = parts(u)
        rule, action = rule_of(host, path)
        want.append((i, host, path, rule, action))
    assert collect(out, "page_id", "host", "path", "rule") == sorted([w[:4] for w in want], key=str)
    verdict = {r.page_id: r.verdict for r in out.collect()}
    assert all(verdict[i] == a for i, _, _, _, a in want if a)
    assert verdict[8] == "block" and verdict[7] == "allow"
    bound = {r.page_id: r.bound for r in out.collect()}
    assert bound[8] > bound[9] > bound[7]  # a host without outcomes stands with its domain


def test_no_outcomes_and_empty_pages(spark):
    assert run(spark, URLS, []).count() == len(URLS)
    assert run(spark, URLS, []).filter("verdict is null").count() == 0
    assert run(spark, [], [("http://a.b/", True)]).count() == 0


def test_shrinkage_against_python(spark):
    """One suffix, one domain, many hosts: the host level is the classic beta-binomial estimate."""
    import math
    data = {f"h{i}.d.zz": (i % 7 * 3, 20 + i) for i in range(12)}
    outcomes = [(f"http://{h}/", j < k) for h, (k, n) in data.items() for j in range(n)]
    got = {r.host: r.bound for r in run(spark, [(i, f"http://{h}/") for i, h in enumerate(data)], outcomes).collect()}
    K, N = sum(k for k, _ in data.values()), sum(n for _, n in data.values())
    m = K / N
    for _ in range(2):  # suffix and domain levels have one member each: strength 1000 around the rate above
        m = (K + m * 1000) / (N + 1000)
    ss = sum(n * (k / n - m) ** 2 for k, n in data.values()) / N
    vv = m * (1 - m)
    noise = vv * len(data) / N
    s = 1000.0 if ss <= noise else round(min(1000.0, max(1.0, (vv - ss) / (ss - noise))), 6)
    for h, (k, n) in data.items():
        a, b = k + m * s, n - k + (1 - m) * s
        assert abs(got[h] - (a / (a + b) - 1.645 * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))))) < 2e-6
