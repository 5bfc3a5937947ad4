"""Urls against trying every rule; digests that collide; the mapped file."""

import random

import numpy as np
import pytest
import xxhash

from pledgeflow.llm import urls
from pledgeflow.llm.queries import URL_RULES
from tests.llm.cases import empty


def brute(url, rules):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
    fits = []
    for _, rule in rules:
        at = rule.find("/") if "/" in rule else len(rule)
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]):
            fits.append((len(rule), at, rule))
    return host, path, max(fits)[2] if fits else None


def made(n):
    r = random.Random(1)
    for _ in range(n):
        host = ".".join(r.choices(["a", "B", "example", "org", "com", "xorg"], k=r.randint(1, 4)))
        yield f"{r.choice(['http', 'HTTPS'])}://{host}{r.choice(['', '/', '/es/', '/en/1', '/en/12?x', '/fr', '/fr/x#/de/', '/de/', '?q=/es/', '#/'])}"


EDGE = [None, "", "no url", "://", "http://", "http:///org/", "a://b://org/", "http://Example.ORG/es/x", "http://org", "http://x.org?/", "http://.org/"]


def test_rules_are_those_of_a_full_search(spark, tmp_path):
    all_urls = [*made(800), *EDGE]
    pages = spark.createDataFrame([(n, u, "own") for n, u in enumerate(all_urls)], "page_id long, url string, verdict string")
    got = urls.judge_urls(pages, URL_RULES).orderBy("page_id").collect()
    verdicts = {rule: v for v, rule in URL_RULES}
    for r in got:
        host, path, rule = brute(all_urls[r["page_id"]], URL_RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdicts.get(rule, "allow")
    assert len({r["rule"] for r in got}) == 6
    assert {r["verdict"] for r in urls.judge_urls(pages, []).collect()} == {"allow"}
    none = spark.createDataFrame([], pages.schema)
    assert urls.judge_urls(none, URL_RULES).count() == 0 and empty(spark).count() == 0


def mapped(tmp_path, rules):
    file = tmp_path / "list"
    file.write_bytes(urls.UrlList.to_bytes(rules))
    return urls.UrlList(str(file))


def test_colliding_digests_are_told_apart_by_their_strings(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda key: len(key))
    known = mapped(tmp_path, [("block", "ab.c/x"), ("allow", "de.f/x"), ("block", "de.f/y")])
    assert known.find([b"ab.c/x", b"de.f/x", b"de.f/z", b"de.f/y", b"q"]) == [True, False, None, True, None]


def test_many_rules_repeats_and_bounds(tmp_path, monkeypatch):
    rules = [("block" if n % 3 else "allow", f"h{n}.net/{'p' * (n % 4)}") for n in range(5000)]
    known = mapped(tmp_path, rules + rules + [("allow", "h1.net/p")])
    assert (np.diff(known.digests.astype(object)) > 0).all() and len(known.digests) == 5000
    assert known.find([r.encode() for _, r in rules]) == [v == "block" for v, _ in rules]
    assert known.digests[0] == min(xxhash.xxh64_intdigest(r.encode()) for _, r in rules)
    monkeypatch.setattr(urls, "MAX_BYTES", 10)
    with pytest.raises(ValueError):
        urls.UrlList.to_bytes(rules)


def test_a_long_url_costs_no_more_than_its_text(tmp_path):
    import time
    import tracemalloc

    known = mapped(tmp_path, [*URL_RULES, ("block", "a.a.a.org/"), ("allow", "org/" + "x" * 3000)])
    long_url = "http://" + "a." * 500_000 + "org/" + "x" * 500_000
    tracemalloc.start()
    began = time.process_time()
    found = known.judge([urls.parts(long_url), urls.parts("http://" + "b." * 500_000 + "com/de/" + "y" * 1000)])
    took, (_, peak) = time.process_time() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found == [("org/" + "x" * 3000, False), ("com/de/", True)]
    assert took < 1 and peak < 50_000_000
