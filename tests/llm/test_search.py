"""Url filter, lexical search, whitening: each against a brute-force version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfwise.llm.lexical_search import Searcher, search
from shelfwise.llm.url_filter import judge
from shelfwise.llm.whitening import bidiagonalize, whiten


def parts(url):
    """Brute force: host and path of a url."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return host, tail[:end]


def verdict(url, rules, default="allow"):
    host, path = parts(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fits:
        return host, path, None, default
    h, p, v = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]))
    return host, path, h + p, v


def test_rules_of_all_depths(spark):
    rng = random.Random(5)
    hosts = ["org", "a.org", "b.a.org", "x.b.a.org", "ba.org", "com", "a.com", "c.a.com", "d.c.a.com", ""]
    paths = ["", "/", "/e", "/e/", "/e/1", "/e/12", "/e/2/x", "/é", "/E/1"]
    rules = {(rng.choice(hosts[:-1]), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(40)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = ["http://" + rng.choice(["", "www.", "m.", "notw"]) + rng.choice(hosts) + rng.choice(paths) + rng.choice(["", "?a=/e/", "#x", "tail"]) for _ in range(600)]
    urls += [None, "", "no scheme", "HTTP://A.ORG/e/1", "http://a.org", "http://a.org?x://b", "x://", "http://b.a.org\n/e/", "http://" + "a." * 300 + "org/e/1", "http://a.org/" + "e/" * 20000]
    rows = [(k, u, 1, 2) for k, u in enumerate(urls)] + [(None, urls[3], 1, 2), (3, urls[4], 1, 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host int, key int")
    table = spark.createDataFrame([*rules, (rules[0][0].upper(), rules[0][1], rules[0][2]), (None, "/", "block"), ("net", "/", None)], "host string, path string, verdict string")
    want = sorted([(k, *verdict(u, rules)) for k, u, _, _ in rows], key=repr)
    for size in (1_000_000, 50):
        got = judge(pages, table, rows_per_range=size)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_block_wins_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    schema = "host string, path string, verdict string"
    both = spark.createDataFrame([("a.org", None, "allow"), ("a.org", None, "block"), ("a.org", "", "allow")], schema)
    assert [r["verdict"] for r in judge(pages, both).collect()] == ["block"]
    none = spark.createDataFrame([], schema)
    assert [tuple(r)[3:] for r in judge(pages, none, default="block").collect()] == [(None, "block")]
    assert judge(pages.filter("page_id = 2"), both).count() == 0


def found_terms(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k):
    """Brute force: every item against every document."""
    counts = [(d, Counter(found_terms(t))) for d, t in docs]
    n, length = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(found_terms(t))
    out = []
    for i, ts in wanted.items():
        scores = []
        for d, c in counts:
            m = 10 + (90 * c.total() * n) // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            scores += [(-s, d is None, d or 0)] if s > 0 else []
        out += [(i, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def test_search_equals_brute_force(spark, odd_docs):
    rng = random.Random(3)
    names = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    docs = [(k // 2 if k % 50 == 0 else k, " ".join(rng.choices(names, k=rng.choice([1, 5, 40, 200])))) for k in range(700)]
    docs += [(r["doc_id"], r["text"]) for r in odd_docs.collect()] + [(10**15, "Über W1-w2,W3_é " * 50), (7, "w1"), (7, "w1")]
    items = [(k, " ".join(rng.choices(names, k=rng.choice([1, 3, 30])))) for k in range(40)]
    items += [(3, "stone river"), (None, "the bright"), (None, "w1 w2"), (99, None), (100, " ,;"), (101, "nowhere"), (102, "Über É w1")]
    table = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, item int, score int").repartition(5)
    queries = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, term int").repartition(2)
    want = ranked(docs, items, 10)
    for options in ({}, {"shard_bytes": 20_000, "span": 4, "block_terms": 60}, {"short": 1.0}, {"short": 0.0, "span": 8}):
        got = search(table, queries, **options)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == want, options


def test_search_without_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert [tuple(r)[:3] for r in search(docs, items).collect()] == [(1, 1, 1)]
    assert search(docs.filter("doc_id > 1"), items).count() == 0
    assert search(docs, items.filter("item_id > 1")).count() == 0


def test_spans_are_skipped():
    n = 6400
    rare = np.arange(0, 40)
    row = {
        "n": np.full(n, 10), "terms": np.array([0, 1]), "ends": np.array([len(rare), len(rare) + n]), "doc_ids": list(range(n)),
        "places": np.concatenate([rare, np.arange(n)]), "tfs": np.ones(len(rare) + n, int),
    }
    shard = Searcher(row, np.array([9000, 10]), n, 10 * n, 90, 10, 1 / 32, 64)
    walked = []
    plain = shard.candidates
    shard.candidates = lambda spans, *rest: walked.append(len(spans)) or plain(spans, *rest)
    assert [p for _, p in sorted(shard.best([0, 1], 0), reverse=True)] and sum(walked) == 1  # of 100 spans


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((300, 24)) * np.exp(-np.arange(24) / 6)).astype(np.float32).tolist()
    rows = [(k, v, 1, 2) for k, v in enumerate(vectors)] + [(7, vectors[3], 1, 2), (None, vectors[3], 1, 2), (900, vectors[5], 1, 2)]
    odd = [(901, None, 1, 2), (902, [], 1, 2), (903, [None, *vectors[0][1:]], 1, 2), (904, [float("nan"), *vectors[0][1:]], 1, 2), (905, [float("-inf"), *vectors[0][1:]], 1, 2), (906, [1.0], 1, 2)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, x int, n int").repartition(5)
    got = whiten(table).collect()
    x = np.floor(64 * np.array([v for _, v, _, _ in rows], np.float32).astype(float)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:16], q[:, ::-1][:, :16]
    assert len(got) == 16 * len(rows) and {r["n"] for r in got} == {n}
    want = {}
    for (i, _, _, _), v in zip(rows, x):
        deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s))
        for k, y in enumerate((v - s / n) @ q / np.sqrt(e)):
            want.setdefault((i, k + 1), []).append((deviation, y))
    signs = {}
    for r in got:
        fits = [y for d, y in want[r["vec_id"], r["component"]] if d == r["deviation"]]
        assert min(abs(abs(r["whitened"]) - abs(y)) for y in fits) < 1e-8
        signs.setdefault(r["component"], set()).update(np.sign(r["whitened"] * y) for y in fits if len(fits) == 1 and abs(y) > 1e-6)
        assert abs(r["explained"] / (e[r["component"] - 1] / np.trace(centred.T @ centred / n)) - 1) < 1e-9
        assert r["identity_error"] < 1e-9
    assert all(len(v) == 1 for v in signs.values())


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    line = whiten(spark.createDataFrame([(k, [1.0 * k, 2.0 * k, 0.0]) for k in range(4)], schema)).collect()
    assert {r["component"] for r in line} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in line)


@pytest.mark.parametrize("case", ["equal values", "pairs", "few rows", "steep"])
def test_components_of_one_value_are_all_found(case):
    rng = np.random.default_rng(4)
    scale = {"equal values": np.repeat([5.0, 1.0], [20, 40]), "pairs": np.repeat(np.exp(-np.arange(40) / 3), 2), "few rows": None, "steep": None}[case]
    if scale is not None:
        x = np.vstack([np.diag(scale), -np.diag(scale)])
    else:
        x = rng.standard_normal((10, 50)) if case == "few rows" else rng.standard_normal((900, 150)) * np.exp(-np.arange(150) / 8)
    x = x - x.mean(axis=0)
    rounds = []
    vectors, values = bidiagonalize(lambda w: rounds.append(1) or (x.T @ (x @ w), float((x @ w) @ (x @ w))), x.shape[1], 16)
    want = np.linalg.svd(x, compute_uv=False)[: len(values)]
    assert len(values) == min(16, 9 if case == "few rows" else 16) and np.allclose(values, want, rtol=1e-9)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-10)
    assert np.allclose(x.T @ (x @ vectors), vectors * values**2, atol=1e-8 * values[0] ** 2)
    assert len(rounds) < x.shape[1] or case != "steep"
