"""Similar-title groups against a sequential model on a small catalog."""

import itertools
import random
import re
from collections import defaultdict
from difflib import SequenceMatcher

import pytest

from shelfwise.operators import groups, title_join
from shelfwise.scale import cut_lineage


def catalog():
    rnd = random.Random(5)
    words = ["steel", "rod", "ring", "large", "small", "blue", "red", "bolt", "été"]
    titles = []
    for i in range(160):
        head = rnd.choice(["steel", "steel", "bolt"])
        titles.append(" ".join([head] + rnd.choices(words, k=rnd.randint(1, 3)) + [str(rnd.randint(1, 3))]))
    titles += ["Pipe 10 mm"] * 6 + ["pipe  10 mm "] * 2 + ["Pipe 12 mm"] * 2 + ["!!", "??", "!!", "é", "", ""] + ["pipe 99 xx"]
    return [(i * 3, f"i{i}", t, "") for i, t in enumerate(titles)]


def norm(t):
    return re.sub(r"\s+", " ", t.lower().strip())


def block(n):
    found = re.findall(r"[a-z0-9]+", n)
    return (found[0] if found else "__empty__", len(n) // 8)


def alike(a, b, t):
    return a == b or SequenceMatcher(None, a, b).ratio() >= t


def blocks_of(rows):
    out = defaultdict(list)
    for pos, _, title, _ in rows:
        out[block(norm(title))].append((pos, norm(title)))
    return out


def model(rows, t, size, limit):
    found = []
    for key, members in sorted(blocks_of(rows).items()):
        if len(members) < size:
            continue
        adj = {p: set() for p, _ in members}
        for (p, a), (q, b) in itertools.combinations(members, 2):
            if alike(a, b, t):
                adj[p].add(q)
                adj[q].add(p)
        if len(members) > limit:
            left = set(adj)
            for p in sorted(adj):
                if p in left:
                    seen, todo = {p}, [p]
                    while todo:
                        for w in adj[todo.pop()] - seen:
                            seen.add(w)
                            todo.append(w)
                    left -= seen
                    if len(seen) >= size:
                        found.append(("component", sorted(seen)))
        else:
            left = set(adj)
            while len(left) >= size:
                best = None
                for k in range(len(left), size - 1, -1):
                    best = next((c for c in itertools.combinations(sorted(left), k) if all(y in adj[x] for x, y in itertools.combinations(c, 2))), None)
                    if best:
                        break
                if not best:
                    break
                found.append(("clique", list(best)))
                left -= set(best)
    return found


@pytest.mark.parametrize("t, chunk, method", [(0.7, 400, "component"), (0.8, 5, "component"), (1.0, 7, "component"), (0.7, 400, "clique"), (0.8, 7, "clique")])
def test_groups_match_the_model(spark, t, chunk, method):
    # the model tries all subsets of a block for a clique, so it gets small blocks
    rows = [r for k, r in enumerate(catalog()) if method == "component" or k % 8 == 0 or k >= 160]
    items = spark.createDataFrame(rows, "pos long, id string, title string, subtitle string").repartition(5)
    got = groups.group_members(items, t, 3, method, chunk_titles=chunk, rows_per_bucket=4).collect()
    by = defaultdict(list)
    for r in got:
        by[r.group_no, r.group_id, r.method].append(r.pos)
    want = model(rows, t, 3, 0 if method == "component" else 1 << 30)
    assert [(m, sorted(p)) for (_, _, m), p in sorted(by.items())] == want
    assert [g for _, g, _ in sorted(by)] == [f"g_{i:06d}" for i in range(len(want))]


@pytest.mark.parametrize("chunk", [400, 4])
def test_similar_pairs_match_the_model(spark, chunk):
    rows = catalog()
    items = spark.createDataFrame(rows, "pos long, id string, title string, subtitle string")
    want = set()
    for members in blocks_of(rows).values():
        first = {}
        for p, n in members:
            first.setdefault(n, p)
        for (p, a), (q, b) in itertools.combinations(members, 2):
            if a != b and alike(a, b, 0.7):
                want.add(tuple(sorted((first[a], first[b]))))
    got = [(r.u, r.v) for r in groups.similar_pairs(items, 0.7, chunk).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_labels(spark):
    rows = [("g", 1, "a", 5, "Steel Rod 1", "steel rod 1"), ("g", 1, "b", 6, "steel rod 2", "steel rod 2"),
            ("h", 2, "c", 7, " xy ", "xy"), ("h", 2, "d", 8, "xyz", "xyz"), ("h", 2, "e", 9, "xa", "xa")]
    members = spark.createDataFrame([(g, n, i, p, t, m, "clique") for g, n, i, p, t, m in rows],
                                    "group_id string, group_no long, id string, pos long, title string, norm string, method string")
    got = {r.group_id: (r.master_title, r.item_count) for r in groups.group_heads(members).collect()}
    assert got == {"g": ("steel rod", 2), "h": ("xa", 3)}


def one_word_titles(n):
    """Titles of one block: templates of a few hundred titles each, no two alike, and some titles of their own."""
    rnd = random.Random(3)
    word = lambda k: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    templates = [" ".join(word(7) for _ in range(3)) for _ in range(max(3, n // 100))]
    own = ["steel " + "".join(rnd.choice("0123456789./-") for _ in range(28)) for _ in range(n // 50)]
    return list(dict.fromkeys([f"steel {rnd.choice(templates)} {rnd.randrange(1000):04d}" for _ in range(n)] + own))


def test_few_tiles_of_a_block_are_built(spark, monkeypatch):
    rows, plain = [], title_join.cross_tiles

    def counted(*args):
        laid = cut_lineage(plain(*args))
        rows.append(laid.count())
        return laid

    monkeypatch.setattr(title_join, "cross_tiles", counted)
    found = [("steel", k * 3, k * 3, t) for k, t in enumerate(one_word_titles(1600))]
    titles = spark.createDataFrame(found, "block string, first_pos long, last_pos long, norm string")
    chunks = title_join.profile_chunks(titles, ["block"], 40)
    assert chunks.count() == len(found) and chunks.groupBy("node").count().agg({"count": "max"}).first()[0] <= 40
    labels = title_join.component_labels(titles, ["block"], 0.7, 40, groups.connected_components)
    assert labels.count() == len(found)
    # against every title laid out to every chunk
    assert rows[0] < 0.05 * chunks.select("node").distinct().count() * len(found)


def test_bounds_hold(spark):
    rnd = random.Random(9)
    chunks = [["".join(rnd.choice("abcdé 1") for _ in range(rnd.randint(1, 12))) for _ in range(rnd.randint(1, 6))] for _ in range(30)]

    for a, b in itertools.combinations(chunks, 2):
        best = max(SequenceMatcher(None, x, y).ratio() for x in a for y in b)
        many = {k: v[None] for k, v in title_join.shape_of(b).items()}
        assert title_join.best_ratio(title_join.shape_of(a), many)[0] >= best - 1e-9


def brute_cover(first, weight, edges, size):
    adj = {i: {j for a, b in edges for i2, j in ((a, b), (b, a)) if i2 == i} for i in range(len(first))}
    left, out = set(adj), []
    while True:
        found = [c for k in range(1, len(left) + 1) for c in itertools.combinations(sorted(left), k) if all(y in adj[x] for x, y in itertools.combinations(c, 2))]
        found = [(-sum(weight[i] for i in c), sorted(first[i] for i in c), list(c)) for c in found]
        best = min(found, default=(0, [], []))
        if -best[0] < size:
            return out
        out.append((-best[0], best[2]))
        left -= set(best[2])


@pytest.mark.parametrize("seed", range(12))
def test_clique_cover(seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 9)
    first = rnd.sample(range(100), n)
    weight = [rnd.choice([1, 1, 1, 2, 4]) for _ in range(n)]
    edges = [(i, j) for i, j in itertools.combinations(range(n), 2) if rnd.random() < rnd.choice([0.3, 0.8])]
    assert groups.clique_cover(first, weight, edges, 2) == brute_cover(first, weight, edges, 2)


def test_large_cliques_end():
    n = 300
    apart = [(i, j) for i, j in itertools.combinations(range(n), 2) if i // 2 != j // 2]  # 2^150 largest cliques
    assert groups.clique_cover(list(range(n)), [1] * n, apart, 5)[0] == (150, list(range(0, n, 2)))


def test_cliques_of_a_block_of_many_small_components(spark):
    rnd = random.Random(1)
    base = [f"steel {rnd.randrange(10**9):09d}{rnd.randrange(10**9):09d}" for _ in range(40)]
    rows = [(k, f"i{k}", f"{t[:-1]}{e}", "") for k, (t, e) in enumerate((t, e) for t in base for e in "abcde")]
    items = spark.createDataFrame(rows, "pos long, id string, title string, subtitle string")
    got = groups.group_members(items, 0.9, 5, "clique", chunk_titles=30).groupBy("group_id").count().collect()
    assert len(got) == 40 and {r["count"] for r in got} == {5}


def test_titles_without_common_order_never_reach_the_matcher(monkeypatch):
    import random

    import numpy as np

    from shelfwise.functions import similarity

    calls = []

    class Counted(similarity.SequenceMatcher):
        def ratio(self):
            calls.append(1)
            return super().ratio()

    monkeypatch.setattr(similarity, "SequenceMatcher", Counted)
    rnd = random.Random(3)
    letters = list("the quick brown fox jumps over a lazy dog again and again")
    texts = []
    for _ in range(60):  # equal character counts, no two in one order
        rnd.shuffle(letters)
        texts.append("".join(letters))
    texts += ["small ring 11/16 brand 7", "small ring 12/16 brand 7"]
    at = np.arange(len(texts))
    assert similarity.tile_edges(texts, at, at, np.zeros(len(texts), int), 0.7, False) == [(60, 61)]
    assert len(calls) == 1


def test_common_order_bounds_the_ratio():
    import random
    from difflib import SequenceMatcher

    from shelfwise.functions.similarity import common_order, letter_places

    rnd = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc dé") for _ in range(rnd.randrange(90))) for _ in range(2))
        table = [0] * (len(b) + 1)
        for x in a:
            above, table = table, [0]
            for k, y in enumerate(b):
                table.append(above[k] + 1 if x == y else max(above[k + 1], table[k]))
        found = common_order(a, letter_places(b), len(b))
        assert found == table[-1]
        assert SequenceMatcher(None, a, b).ratio() * (len(a) + len(b)) / 2 <= found + 1e-9


def test_titles_are_normalized_once(spark, monkeypatch):
    reads = []
    original = groups.cut_lineage
    monkeypatch.setattr(groups, "cut_lineage", lambda df: reads.append("norm" in df.columns and "title" in df.columns) or original(df))
    items = spark.createDataFrame(catalog(), "pos long, id string, title string, subtitle string")
    members = groups.group_members(items, 0.7, 2)
    assert reads[0] and reads.count(True) == 1
    assert members.count() > 0
