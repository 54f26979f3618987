import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import url_filter as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([i for c in "?#" if (i := path.find(c)) >= 0], default=len(path))]


def brute(url, rules, default="allow"):
    host, path = parts(url)
    rules = [(h, p or "", v) for h, p, v in rules]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)] if host else []
    best = max(fits, default=None)
    return (host, path, best[3] if best else None, best[4] if best else default)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = [
    None, "", "no scheme", "http://", "http://a.example.net", "http://a.example.net/", "https://A.Example.NET/en/x?y=/fr/", "http://net/en/", "http://xexample.net/en/", "http://example.com/de/1#t", "http://sub.example.com/de", "ftp://x.org/fr/#",
    "a://b://c.net/", "http://x.org?q=/fr/", "http://é.org/fr/é", "://org/fr/", "http://example.com\n/de/", "http://net./", "http://.net/x", "http://user@example.com:80/de/", "http://" + "a." * 300 + "net/" + "p" * 5000,
]


@pytest.mark.parametrize("most", [32, U.MAX_FILTER_BYTES])
def test_same_as_brute_force(spark, most):
    rng = random.Random(3)
    label = lambda: rng.choice(["a", "b", "net", "x.y", "é"])
    rules = RULES + [(f"{label()}.{label()}", rng.choice(["/", "/a", "", "/a/b"]), rng.choice(["allow", "block"])) for _ in range(40)] + [("a.b", None, "block"), (None, "/", "block"), ("", "/", "block")]
    seen, unique = set(), []
    for h, p, v in rules:
        if (h, p or "") not in seen:
            seen.add((h, p or ""))
            unique.append((h, p, v))
    urls = URLS + [f"http://{label()}.{label()}.{label()}/{rng.choice(['', 'a', 'a/b/c'])}" for _ in range(200)] + ["http://a.b/"] * 50
    pages = spark.createDataFrame([(i % 200 or None, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, html string, row int")
    listed = spark.createDataFrame(unique + unique[:3], U.LIST)
    got = U.judge_urls(pages, listed, max_filter_bytes=most)
    assert got.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    want = [(i % 200 or None, u, *brute(u, unique)) for i, u in enumerate(urls)]
    assert sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    bloom = U.build_filter(keys, 20_000)
    own = np.array([r.key for r in keys.collect()], np.int64)
    assert bloom.might_hold(own).all()
    others = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 100_000, np.int64)
    assert bloom.might_hold(others).mean() < 0.01
    small = U.build_filter(keys, 20_000, max_bytes=4096)
    assert small.words.nbytes <= 4096 and small.might_hold(own).all()


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], U.LIST)
    assert [(r.rule, r.verdict) for r in U.judge_urls(pages, none).collect()] == [(None, "allow")]
    assert U.judge_urls(pages.limit(0), spark.createDataFrame(RULES, U.LIST)).collect() == []
