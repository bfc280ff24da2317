"""URL filters against a plain loop over all rules."""

from __future__ import annotations

import random
import string

from termscope.llm import urls

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
PAGE = "page_id long, url string, heads string, chunk string, rule int, at string"
RULE = "host string, path string, verdict string, key string"


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([len(rest), *(rest.index(c) for c in "/?#" if c in rest)])
    host, path = rest[:cut].translate(LOWER), rest[cut:]
    return host, path[: min([len(path), *(path.index(c) for c in "?#" if c in path)])]


def brute(pages, rules, default):
    out = []
    for page_id, url in pages:
        host, path = parts(url)
        fit = {}
        for h, p, verdict in rules:
            if not h or any(c in h for c in "/?#"):
                continue
            h, p = h.translate(LOWER), p or ""
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                fit[h, p] = max(fit.get((h, p), ""), verdict)
        best = max(fit, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
        out.append((page_id, host, path, best and best[0] + best[1], fit[best] if best else default, len(fit)))
    return sorted(out, key=str)


def found(spark, pages, rules, default="allow"):
    docs = spark.createDataFrame([(i, u, "x", "y", 1, "z") for i, u in pages], PAGE)
    table = spark.createDataFrame([(h, p, v, "k") for h, p, v in rules], RULE)
    return sorted(map(tuple, urls.verdicts(docs, table, default).collect()), key=str)


def test_nested_rules_on_random_urls(spark):
    draw = random.Random(5)
    names = ["org", "com", "a", "b", "a.b", "", "é"]

    def host(n):
        return ".".join(draw.choice(names) for _ in range(draw.randint(1, n)))

    def path(n):
        return "".join(draw.choice(["/", "/a", "b", "ü", "/aa", "\U0010ffff", "\0"]) for _ in range(draw.randint(0, n)))

    rules = [(host(3), path(3), draw.choice(["allow", "block"])) for _ in range(150)]
    rules += [("ORG", "/", "allow"), ("org", "/", "block"), (None, "/", "block"), ("org", None, "allow"), ("or/g", "", "block")]
    urls_ = [f"{draw.choice(['http', 'x://y'])}://{host(5)}{path(5)}{draw.choice(['', '?q=/a', '#/b', '://'])}" for _ in range(600)]
    urls_ += ["http://ORG", "http://org/", "http://xorg/", "org/a", "", None, "://", "http://a.org?x", "http://x.org\n/a"]
    pages = list(enumerate(urls_))
    assert found(spark, pages, rules, "block") == brute(pages, rules, "block")


def test_hot_urls_long_texts_and_repeated_rows(spark):
    rules = [("org", "/", "allow"), ("a.org", "/x", "block"), ("a.org", "/x/y", "allow")]
    pages = [(7, "http://a.org/x/1")] * 400 + [(None, "http://b.a.org/x/y?" + "q" * 100_000)] * 2
    pages += [(1, "http://" + "a." * 20_000 + "org/" + "p" * 50_000), (2, "http://" + "." * 500)]
    assert found(spark, pages, rules) == brute(pages, rules, "allow")


def test_empty_tables(spark):
    pages, rules = [(1, "http://a.org/x")], [("org", "/", "block")]
    assert found(spark, pages, [], "block") == brute(pages, [], "block")
    assert found(spark, pages, [("", "/", "block")]) == brute(pages, [], "allow")
    assert found(spark, [], rules) == []


def test_no_python_and_no_broadcast_of_unknown_size(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    rules = spark.createDataFrame([("org", "/", "block")], "host string, path string, verdict string")
    plan = urls.verdicts(pages, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "broadcast" not in plan.lower()
