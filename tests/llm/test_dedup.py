"""Exact and near deduplication, decontamination, mixing."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfwise.llm.decontaminate import clean, containment, item_sets, sketches
from shelfwise.llm.exact_dedup import digest_table, exact_dedup, merge_tree
from shelfwise.llm.hashing import digest, shingle_set, tokens, word_hashes
from shelfwise.llm.mixing import mix, mix_report, source_targets
from shelfwise.llm.near_dedup import components, deduplicated, near_dedup
from tests.llm.conftest import odd_rows, prose

SPACE = " \t\n\x0b\x0c\r"


def bare(text):
    return "".join(c for c in text or "" if c not in SPACE)


def test_one_row_of_a_group_is_kept(spark):
    docs = spark.createDataFrame([(None, "a  b"), (5, "ab"), (6, "a b"), (7, "q q"), (7, "qq"), (7, "q q"), (None, "z"), (None, "z")], "doc_id long, text string")
    got = exact_dedup(docs.repartition(3)).collect()
    kept = sorted((r["text_sha256"], r["doc_id"], r["keep_id"]) for r in got if r["kept"])
    assert len(got) == 8 and len(kept) == 3
    assert [k[1:] for k in kept if k[1] is None] == [(None, None)] * 2 and (7, 7) in [k[1:] for k in kept]


def test_mix_takes_rows_with_maps(spark):
    docs = spark.sql("SELECT id AS doc_id, repeat('w ', 5) AS text, 'a' AS source, map('k', id) AS m FROM range(6) UNION ALL SELECT 1, repeat('w ', 5), 'a', map('k', 9L)")
    assert mix(docs).columns == docs.columns and 8 <= mix(docs).count() <= 14


def test_exact_dedup_odd_rows(odd_docs):
    got = sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"], r["text_sha256"]) for r in exact_dedup(odd_docs).collect())
    groups = defaultdict(list)
    for d, t, *_ in odd_rows():
        groups[bare(t)].append((-len(t or ""), d if d is not None else 1 << 60, d))
    want = []
    for b, members in groups.items():
        keep = min(members)[2]
        sha = hashlib.sha256(b.encode()).hexdigest()
        want += [(d or -1, keep or -1, len(members), sha) for *_, d in members]
    assert got == sorted(want)


@pytest.mark.parametrize("fan", [2, 3])
def test_merge_tree_rounds(spark, fan):
    rows = [(k, prose(k % 40, 5)) for k in range(200)]
    runs = digest_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(13))
    got = {r["sha"]: (r["keep_id"], r["group_size"]) for r in merge_tree(runs, fan).collect()}
    want = {}
    for k, t in rows:
        sha = hashlib.sha256(bare(t).encode()).hexdigest()
        keep, n = want.get(sha, (k, 0))
        want[sha] = (min(keep, k), n + 1)
    assert got == want


def test_empty_tables(no_docs, spark):
    items = spark.createDataFrame([(0, prose(1, 10))], "item_id long, text string")
    assert exact_dedup(no_docs).count() == 0
    assert near_dedup(no_docs).count() == 0
    assert mix_report(no_docs).count() == 0 and mix(no_docs).count() == 0
    assert containment(no_docs, items).count() == 0
    assert clean(no_docs, items).columns == no_docs.columns


def test_clean_without_items(odd_docs, spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert clean(odd_docs, items).count() == odd_docs.count()


def brute_components(rows, width=4, percent=80):
    sets = [{tuple(w[i : i + min(width, len(w))]) for i in range(max(1, len(w) - width + 1))} if w else set() for _, w in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                label[max(root(a), root(b))] = min(root(a), root(b))
    least = defaultdict(list)
    for k, (d, _) in enumerate(rows):
        least[root(k)].append(d)
    return [(d, len(sets[k]), min(x for x in least[root(k)] if x is not None) if any(x is not None for x in least[root(k)]) else None)
            for k, (d, _) in enumerate(rows)]


def test_near_dedup_odd_rows(odd_docs):
    rows = sorted(((d, tokens(t)) for d, t, *_ in odd_rows()), key=lambda r: (r[0] is None, r[0] or 0))
    want = Counter(brute_components(rows))
    got = near_dedup(odd_docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_copies_against_all_pairs(spark):
    rows = []
    for g in range(25):
        words = prose(100 + g, 90).split()
        for k in range(8):
            changed = list(words)
            for j in range(k % 4):
                changed[(7 * k + 23 * j + g) % 90] = f"edit{g}{k}{j}"
            rows.append((g * 8 + k, " ".join(changed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup(docs).collect())
    assert got == sorted(brute_components([(d, tokens(t)) for d, t in rows]))


def test_deduplicated_keeps_one_row_of_a_group(odd_docs):
    got = deduplicated(odd_docs, shingle=5)
    assert got.columns == odd_docs.columns
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert Counter(ids)[3] == 0 and Counter(ids)[1] == 1 and 10 not in ids and ids.count(None) >= 1


def test_deduplicated_loses_no_text_to_a_shared_identifier(spark):
    texts = [prose(300 + k, 60) for k in range(7)]
    near = texts[0].replace(texts[0].split()[30], "changed", 1)
    rows = [
        (1, texts[0], "a"), (2, near, "b"), (2, texts[1], "c"),  # a near copy and a text of its own under one identifier
        (None, texts[2], "d"), (None, texts[3], "e"), (None, texts[3].upper(), "f"), (None, texts[0], "g"),
        (None, None, "h"), (None, "", "i"), (7, texts[4], "j"), (7, texts[5], "k"), (7, texts[5] + " ", "l"), (8, " ", "m"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string")
    want = sorted([(1, "a"), (2, "c"), (-1, "d"), (-1, "f"), (-1, "h"), (-1, "i"), (7, "j"), (7, "k"), (8, "m")])
    for parts in (1, 5):
        got = deduplicated(docs.repartition(parts)).collect()
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["name"]) for r in got) == want


def test_one_row_of_near_copies_without_identifier(spark):
    base = prose(311, 80)
    rows = [(None, base), (None, base + " end"), (None, base + " tail"), (4, prose(312, 80)), (4, prose(312, 80) + " end")]
    got = deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["4", "None"]


def test_native_class_equals_digest(spark):
    from shelfwise.llm.near_dedup import text_class

    texts = [None, "", " \x0b", "A b\r\nC", "É ß İ\x85x", "\x1cq  Q", prose(1, 500)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = docs.select("text", text_class("text")[0].alias("c"), text_class("text")[1].alias("n")).collect()
    assert all(bytes(r["c"]) == digest(tokens(r["text"])) and r["n"] == len(tokens(r["text"])) for r in got)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"{k:03d}".encode(), f"{k + 1:03d}".encode()) for k in range(60)], "u binary, v binary")
    assert {bytes(r["label"]) for r in components(edges).collect()} == {b"000"}


def test_hashes_tell_words_apart():
    words = [b"a", b"b", b"ab", b"ba", b"aa", b"a" * 300]
    assert len(set(word_hashes(words).tolist())) == len(words)
    assert digest([b"a", b"b"]) != digest([b"ab"])
    assert len(shingle_set([b"x"] * 10, 4)) == 1 and len(shingle_set([b"x"], 4)) == 1 and len(shingle_set([], 4)) == 0


def test_sketch_cannot_miss(spark):
    """Every document that has just enough of an item shares a hash of its sketch."""
    rng = np.random.default_rng(0)
    items = [(k, prose(200 + k, 15 + 3 * k)) for k in range(12)]
    table = spark.createDataFrame(items, "item_id long, text string")
    sets = item_sets(table).cache()
    sketch = {}
    for r in sketches(sets).collect():
        sketch.setdefault(r["item_id"], set()).add(r["hash"])
    whole = {}
    for r in sets.collect():
        whole.setdefault(r["item_id"], []).append(r["hash"])
    for item, hashes in whole.items():
        need = int(np.ceil(0.8 * len(hashes)))
        for _ in range(50):
            assert sketch[item] & set(rng.choice(hashes, need, replace=False).tolist())


def test_containment_against_sets(odd_docs, spark):
    base = odd_rows()[0][1].split()
    long = odd_rows()[9][1].split()
    items = [
        (1, " ".join(base[10:40])),
        (2, " ".join(long[29_000:29_050]).upper()),
        (3, "few words only"),
        (4, None),
        (5, ""),
        (6, prose(999, 40)),
        (7, " ".join(base[10:30] + ["other"] + base[30:60])),
        (None, " ".join(long[5:40])),
        (1, " ".join(base[10:40])),
    ]
    table = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, hash int")

    def grams(t):
        w = (t or "").lower().split()
        return {" ".join(w[k : k + 5]) for k in range(len(w) - 4)}

    want = set()
    docs = defaultdict(set)
    for d, t, *_ in odd_rows():
        docs[d] |= grams(t)
    for i, t in items:
        g = grams(t)
        for d, s in docs.items():
            if g and len(g & s) / len(g) >= 0.8:
                want.add((d, i, len(g), len(g & s)))
    got = {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in containment(odd_docs, table).collect()}
    assert got == want and len(want) >= 6
    left = clean(odd_docs, table)
    assert left.columns == odd_docs.columns
    bad = {d for d, *_ in want}
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(d for d, *_ in odd_rows() if d not in bad)


def test_clean_judges_texts_of_one_identifier_alone(spark):
    item = prose(400, 40)
    half = [" ".join(item.split()[:22]), " ".join(item.split()[18:])]
    rows = [
        (None, prose(401, 60)), (None, prose(402, 30) + " " + item), (None, None),  # one of them holds the item
        (5, prose(403, 30) + " " + half[0]), (5, prose(404, 30) + " " + half[1]),  # half of it each
        (6, prose(405, 30)), (6, item + " more"), (6, item + " more"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert Counter(r["doc_id"] for r in containment(docs, items).collect()) == Counter([None, 6])
    bad = {rows[1], rows[6]}
    assert Counter(tuple(r) for r in clean(docs, items).collect()) == Counter(r for r in rows if r not in bad)


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    target = {s: share * sum(sizes.values()) * weight[s] / sum(weight.values()) for s in names}
    while True:
        over = [s for s in names if target[s] > cap * sizes[s] + 1e-9]
        if not over:
            return target
        excess = sum(target[s] - cap * sizes[s] for s in over)
        for s in over:
            target[s] = cap * sizes[s]
        rest = [s for s in names if target[s] < cap * sizes[s] - 1e-9]
        for s in rest:
            target[s] += excess * weight[s] / sum(weight[x] for x in rest)


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 50, "d": 3, None: 700}, {"a": 5}, {"a": 0, "b": 7}, {"x": 1, "y": 1, "z": 100_000},
])
def test_targets_against_resharing(spark, sizes):
    rows = [("1" if s is None else "0" + s, n) for s, n in sizes.items()]
    got = {r["skey"]: r["target"] for r in source_targets(spark.createDataFrame(rows, "skey string, source_size long")).collect()}
    for s, t in brute_targets(sizes).items():
        assert got["1" if s is None else "0" + s] == pytest.approx(t, rel=1e-9, abs=1e-6)


def test_mixing(spark, odd_docs):
    rows = [(k, prose(k, 5 + k * 7 % 90), f"s{k % 5}" if k % 3 else "s0") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = {r["doc_id"]: r for r in mix_report(docs).collect()}
    again = {r["doc_id"]: r for r in mix_report(docs.repartition(3)).collect()}
    assert got == again
    taken, target = Counter(), {}
    for k, t, s in rows:
        assert got[k]["size"] == len(t.split()) and got[k]["taken"] in (0, got[k]["size"], 2 * got[k]["size"])
        taken[s] += got[k]["taken"]
        target[s] = got[k]["target"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 200
    emitted = Counter(r["doc_id"] for r in mix(docs).collect())
    assert all(emitted[k] * got[k]["size"] == got[k]["taken"] for k in got)
    odd = mix_report(odd_docs).collect()
    assert len(odd) == len(odd_rows()) and all(r["taken"] <= 2 * r["size"] for r in odd)
    assert mix(odd_docs).columns == odd_docs.columns
