"""Rule matching, generation, frequent pairs and claims against sequential models."""

import itertools
import random
import re
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import decisions, keywords, model_tables, rules, taxonomy

WORDS = ["Steel", "rod", "RING", "large", "small", "bolt", "x", "of"]
ITEM = "pos long, id string, title string, subtitle string"
RULE = "depth int, side string, w1 string, w2 string, category_slug string, confidence double, source string, seq long"


def items_and_rules():
    rnd = random.Random(11)
    items = [(i, f"i{i}", " ".join(rnd.choices(WORDS, k=rnd.randint(0, 4))), "-".join(rnd.choices(WORDS, k=3))) for i in range(60)]
    low = [w.lower() for w in WORDS] + ["Rod"]
    made = [
        (rnd.choice([1, 2, None]), rnd.choice(["title", "subtitle"]), rnd.choice(low), rnd.choice(low), rnd.choice(["a", "b", "c", "other"]), rnd.choice([0.7, 0.85, 1.0]), "t", i)
        for i in range(40)
    ]
    return items, made


def model_match(items, made, cross):
    """Lowest phase with a hit; categories with their distinct triggers."""
    index = {}
    for d, side, a, b, cat, conf, _, seq in sorted(made, key=lambda r: r[-1]):
        index[10000 if d is None else d, side, tuple(sorted((a, b)))] = (a, b, cat, conf)
    out = {}
    for pos, _, title, sub in items:
        texts = [("cross", f"{title} {sub}", None)] if cross else [("title", title, "title"), ("subtitle", sub, "subtitle")]
        for phase in sorted({k[0] for k in index}):
            hits = defaultdict(set)
            for source, text, side in texts:
                first = {}
                for w in re.findall("[A-Za-z]+", text):
                    first.setdefault(w.lower(), w)
                for (p, s, _), (a, b, cat, conf) in index.items():
                    if p == phase and (side is None or s == side) and a in first and b in first:
                        hits[cat].add((-conf, first[a], first[b], source))
            if hits:
                out[pos] = {c: sorted(t) for c, t in hits.items()}
                break
    return out


@pytest.mark.parametrize("cross", [True, False])
@pytest.mark.parametrize("limit", [10**8, 0])
def test_match(spark, cross, limit):
    items, made = items_and_rules()
    trig = rules.match_triggers(spark.createDataFrame(items, ITEM), spark.createDataFrame(made, RULE), cross, broadcast_bytes=limit)
    ranked = rules.rank_categories(trig).collect()
    want = model_match(items, made, cross)
    got = defaultdict(dict)
    for r in ranked:
        got[r.pos][r.category_slug] = [tuple(t) for t in r.triggers]
    assert dict(got) == want
    for pos, cats in want.items():
        order = sorted((c for c in cats if c != "other"), key=lambda c: (-len(cats[c]), cats[c][0][0], c))
        assert [r.category_slug for r in sorted((r for r in ranked if r.pos == pos and r["rank"]), key=lambda r: r["rank"])] == order


@pytest.mark.parametrize("cross", [True, False])
def test_match_in_portions_lists_no_trigger_twice(spark, cross):
    items, made = items_and_rules()
    both = made + [(*r[:1], "title" if r[1] == "subtitle" else "subtitle", *r[2:-1], 100 + r[-1]) for r in made]
    items, made = spark.createDataFrame(items, ITEM), spark.createDataFrame(both, RULE)
    whole = rules.match_triggers(items, made, cross)
    rows = sorted(map(str, whole.collect()))
    assert len(rows) == len(set(rows))
    assert sorted(map(str, rules.match_triggers(items, made, cross, broadcast_bytes=2000).collect())) == rows


@pytest.mark.parametrize("limit", [10**8, 0])
def test_ranking_without_triggers_is_the_same(spark, limit):
    items, made = items_and_rules()
    trig = rules.match_triggers(spark.createDataFrame(items, ITEM), spark.createDataFrame(made, RULE), broadcast_bytes=limit)
    want = sorted(map(str, rules.rank_categories(trig).drop("triggers").collect()))
    assert sorted(map(str, rules.rank_categories(trig, with_triggers=False).select(rules.rank_categories(trig).drop("triggers").columns).collect())) == want


def test_ranking_shuffles_items_not_triggers(spark):
    items, made = items_and_rules()
    trig = rules.match_triggers(spark.createDataFrame(items, ITEM), spark.createDataFrame(made, RULE))
    for with_triggers in (True, False):
        plan = rules.rank_categories(trig, with_triggers=with_triggers)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(") == 1 and "REPARTITION_BY_NUM" in plan


def test_most_specific_path_first(spark):
    trig = spark.createDataFrame(
        [(1, "i", 1, c, "p", "q", 1.0, "title") for c in ("a", "b", "c", "ab", "zz")],
        "pos long, id string, phase int, category_slug string, w1 string, w2 string, confidence double, source string",
    )
    paths = spark.createDataFrame([("a", "a"), ("b", "a/b"), ("c", "a/b/c"), ("ab", "ab")], "slug string, path string")
    got = sorted(rules.rank_categories(trig, paths).collect(), key=lambda r: r["rank"])
    assert [r.category_slug for r in got] == ["c", "ab", "zz"]


def test_result_document_has_matched_items_without_categories(spark):
    items = spark.createDataFrame([(1, "i", "old rod", "")], ITEM)
    made = spark.createDataFrame([(1, "title", "old", "rod", "other", 1.0, "t", 0)], RULE)
    ranked = rules.rank_categories(rules.match_triggers(items, made))
    doc = rules.result_document(items, ranked).first()
    assert doc.categories == [] and doc.total_triggered_bigrams == 0 and doc.max_confidence == 0.0


def test_result_document_ranks_once(spark):
    items, made = items_and_rules()
    items = spark.createDataFrame(items, ITEM)
    doc = rules.result_document(items, rules.rank_categories(rules.match_triggers(items, spark.createDataFrame(made, RULE))))
    assert doc._jdf.queryExecution().optimizedPlan().toString().count("collect_set(") == 1


def test_word_parents_and_pair_rules(spark):
    words = [("title", w, n) for w, n in [("bind", 9), ("rods", 8), ("ring", 8), ("rings", 7), ("steel", 6), ("stein", 5), ("inn", 4)]]
    anchors = [(1, "rods_c", "rod"), (1, "rings_c", "ring"), (1, "rings_c", "in"), (1, "steel_c", "steel"), (1, "rods_c", "steel"), (2, "x", "ring")]
    parents = defaultdict(set)
    for _, w, _ in words:
        for d, a, t in anchors:
            if w == t or ((len(t) < 3 or t[:3] == w[:3]) and SequenceMatcher(None, w, t).ratio() >= 0.58):
                parents[d, w].add(a)
    kw = spark.createDataFrame(words, "side string, word string, item_count long")
    got = rules.word_parents(kw, spark.createDataFrame(anchors, "depth int, anchor string, token string"))
    assert {(r.depth, r.word, r.parent) for r in got.collect()} == {(d, w, a) for (d, w), s in parents.items() for a in s}
    for least in (0.7, 0.85, 1.0):
        want = set()
        for d in (1, 2):
            for (_, a, _), (_, b, _) in itertools.combinations(words, 2):
                pa, pb = parents.get((d, a), set()), parents.get((d, b), set())
                if len(pa & pb) == 1:
                    conf = 1.0 if len(pa) == len(pb) == 1 else 0.85 if 1 in (len(pa), len(pb)) else 0.7
                    if conf >= least:
                        want.add((d, a, b, next(iter(pa & pb)), conf))
        made = rules.pair_rules(kw, got, least).collect()
        assert len(made) == len(want)
        assert {(r.depth, r.w1, r.w2, r.category_slug, r.confidence) for r in made} == want


@pytest.mark.parametrize("rows_per_group", [20_000, 10])
def test_frequent_pairs(spark, rows_per_group):
    rnd = random.Random(2)
    vocab = [f"w{c}{d}" for c in "abcd" for d in "efgh"]
    items = [(i, f"i{i}", " ".join(rnd.choices(vocab, k=6)), " ".join(rnd.choices(vocab, k=6))) for i in range(80)]
    count = Counter()
    for _, _, t, s in items:
        found = set()
        for text in (t, s):
            found |= set(itertools.combinations(sorted(set(re.findall("[a-z]+", text))), 2))
        count.update(found)
    df = spark.createDataFrame(items, ITEM)
    words = spark.createDataFrame([(w, w.upper()) for w in vocab], "word_low string, display string")
    again = df.withColumn("pos", F.col("pos") + 1000)  # rows of an identifier count once
    lost = spark.createDataFrame([(5000, None, "w w", ""), (5001, "", "w w", "")], ITEM)
    got = keywords.frequent_pairs(df.union(again).union(lost), words, 10, rows_per_group).collect()
    assert all((r.display1, r.display2) == (r.w1.upper(), r.w2.upper()) for r in got)
    assert {(r.w1, r.w2): r.unmatched_item_count for r in got} == {p: n for p, n in count.items() if n >= 10}


@pytest.mark.parametrize("seed", range(3))
def test_claims_with_minimum(spark, seed):
    rnd = random.Random(seed)
    hits = {(rnd.randint(0, 40), rnd.randint(1, 12)) for _ in range(150)}
    taken, want = set(), {}
    for rank in range(1, 13):
        mine = {p for p, r in hits if r == rank} - taken
        if len(mine) >= 4:
            taken |= mine
            want.update({p: rank for p in mine})
    df = spark.createDataFrame([(p, f"i{p}", r) for p, r in hits], "pos long, id string, rank long")
    assert {r.pos: r["rank"] for r in decisions.claim_with_minimum(df, 4).collect()} == want


@pytest.mark.parametrize("limits", [{}, {"max_bytes": 0}, {"max_bytes": 0, "hot_rows": 5}])
def test_pair_hits(spark, limits):
    items, _ = items_and_rules()
    low = [w.lower() for w in WORDS] + ["nowhere"]
    pairs = [(a, b.upper(), k) for k, (a, b) in enumerate(itertools.combinations(low, 2))]
    want = set()
    for pos, _, title, subtitle in items:
        for a, b, rank in pairs:
            if any({a, b.lower()} <= set(re.findall("[a-z]+", t.lower())) for t in (title, subtitle)):
                want.add((pos, rank))
    got = decisions.pair_hits(spark.createDataFrame(items, ITEM), spark.createDataFrame(pairs, "w1 string, w2 string, rank long"), **limits).collect()
    assert len(got) == len(want) and {(r.pos, r["rank"]) for r in got} == want


def test_claims_of_a_long_chain_take_few_waves(spark, monkeypatch):
    # pair k shares items with pair k + 1 only; all are certain at once
    hits = [(100 * k + j, f"i{100 * k + j}", k) for k in range(40) for j in range(6)] + [(100 * k + 5, f"i{100 * k + 5}", k + 1) for k in range(39)]
    waves = []
    monkeypatch.setattr(decisions, "skew_join", lambda *a, plain=decisions.skew_join, **k: waves.append(1) or plain(*a, **k))
    got = decisions.claim_with_minimum(spark.createDataFrame(hits, "pos long, id string, rank long"), 4).collect()
    assert len(got) == 240 and all(r["rank"] == r.pos // 100 for r in got) and len(waves) <= 2


def test_decision_log(spark):
    log = spark.createDataFrame(
        [("g1", "assign", "a/b", 1, 1), ("g1", "cleared", None, 2, 2), ("g2", "unknown", None, 1, 3), ("g2", "assign", "a/c", 3, 4), ("g3", "unknown", None, 1, 5)],
        "key string, kind string, leaf_path string, decided_at long, seq long",
    )
    got = {r.key: (r.kind, r.leaf_path) for r in decisions.latest_decisions(log).collect()}
    assert got == {"g2": ("assign", "a/c"), "g3": ("unknown", None)}


def test_maximal_paths(spark):
    rows = spark.createDataFrame([("o", p) for p in ("a", "a/b", "a/b/c", "ab")] + [("p", "a")], "k string, path string")
    once = taxonomy.maximal_paths(rows, ["k"])
    assert {(r.k, r.path) for r in once.collect()} == {("o", "a/b/c"), ("o", "ab"), ("p", "a")}
    assert once.count() == taxonomy.maximal_paths(once, ["k"]).count()


def test_tree_leaves_out_nodes_without_slug_and_their_children(spark):
    tree = spark.createDataFrame(
        [("m", None, "m", "M", "0"), ("m/x", "m", "x", "", "1"), ("m/?", "m", None, "lost", "2"), ("m/?/y", "m/?", "y", "Y", "0")],
        "node_key string, parent_key string, slug string, display_name string, sib string",
    )
    got = {r.path: (r.display_name, r.is_leaf) for r in taxonomy.flatten_tree(tree).collect()}
    assert got == {"m": ("M", False), "m/x": ("x", True)}


@pytest.mark.parametrize("cross", [True, False])
@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_counted_triggers_are_the_triggers(spark, cross, limit):
    words = "bolt ring Rod plate red Red blue small zinc".split()
    rnd = random.Random(11)
    pick = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    made = [
        (rnd.choice([1, 2, None]), rnd.choice(["title", "subtitle"]), rnd.choice(words).lower(), rnd.choice(words).lower(), rnd.choice(["a", "b", "other"]), rnd.choice([0.7, 0.9]), "x", k)
        for k in range(60)
    ] + [(1, None, "red", "blue", "a", 0.9, "x", 99), (1, "title", None, "blue", "a", 0.9, "x", 98)]
    items = [(k, f"i{k}", pick(rnd.randrange(6)) if k % 9 else None, pick(rnd.randrange(8)) if k % 7 else None) for k in range(120)]
    items, made = spark.createDataFrame(items, ITEM), spark.createDataFrame(made, RULE)
    found = rules.match_triggers(items, made, cross)
    want = found.groupBy("pos", "id", "phase", "category_slug").agg(
        F.count(F.lit(1)).alias("matched_bigram_count"), F.max("confidence").alias("max_confidence")
    )
    counted = rules.count_triggers(items, made, cross, broadcast_bytes=limit)
    assert want.count() > 100
    assert sorted(map(str, counted.select(want.columns).collect())) == sorted(map(str, want.collect()))
    ranked = rules.rank_counts(counted)
    assert sorted(map(str, ranked.collect())) == sorted(map(str, rules.rank_categories(found).drop("triggers").select(ranked.columns).collect()))


def test_counting_makes_no_row_of_a_trigger(spark):
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)]
    made = spark.createDataFrame([(1, "title", a, b, "c", 0.9, "x", k) for k, (a, b) in enumerate((a, b) for a in words for b in words if a < b)], RULE)
    items = spark.createDataFrame([(k, f"i{k}", " ".join(words), "") for k in range(20)], ITEM)
    counted = rules.count_triggers(items, made)
    assert {(r["matched_bigram_count"], r["category_slug"]) for r in counted.collect()} == {(1770, "c")}
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "Generate" not in plan


def test_no_rules_count_nothing(spark):
    items = spark.createDataFrame([(0, "i", "red bolt", "")], ITEM)
    assert rules.count_triggers(items, spark.createDataFrame([], RULE)).collect() == []


@pytest.mark.parametrize("limits", [{}, {"max_bytes": 0}])
def test_first_claims_and_met_pairs_are_those_of_the_hits(spark, limits):
    rnd = random.Random(7)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(120)]
    pairs = [(rnd.choice(words).upper(), rnd.choice(words), k * 3 + 1) for k in range(900)] + [(None, "waa", 1), ("nowhere", "waa", 2)]
    pick = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    items = [(k, f"i{k}" if k % 11 else None, pick(rnd.randrange(4)) if k % 5 else None, pick(rnd.randrange(7))) for k in range(300)]
    items, pairs = spark.createDataFrame(items, ITEM), spark.createDataFrame(pairs, "w1 string, w2 string, rank long")
    hits = decisions.pair_hits(items, pairs)
    want = decisions.claim_first(hits).collect()
    assert len(want) > 50 and max(r["rank"] for r in want) > 256 * 3
    assert sorted(map(str, decisions.first_claims(items, pairs, **limits).collect())) == sorted(map(str, want))
    met = [r["rank"] for r in decisions.pairs_met(items, pairs, **limits).collect()]
    assert sorted(met) == sorted(r["rank"] for r in hits.select("rank").distinct().collect())


def test_first_claims_join_no_postings(spark):
    items = spark.createDataFrame([(k, f"i{k}", "red bolt", "") for k in range(9)], ITEM)
    pairs = spark.createDataFrame([("red", "bolt", 4), ("bolt", "red", 2)], "w1 string, w2 string, rank long")
    claims = decisions.first_claims(items, pairs)
    assert "Join" not in claims._jdf.queryExecution().executedPlan().toString()
    assert {r["rank"] for r in claims.collect()} == {2}
    assert decisions.first_claims(items, pairs.limit(0)).collect() == []


@pytest.mark.parametrize("per_group", [40, 10**8])
def test_pairs_of_short_and_long_fields(spark, per_group):
    rnd = random.Random(13)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)]
    pick = lambda n: " ".join(rnd.choice(words[: n + 3]) for _ in range(n))
    rows = [(k, f"i{k // 2}", pick(rnd.randrange(6)), pick(rnd.randrange(40))) for k in range(80)]
    held, want = defaultdict(lambda: (set(), set())), Counter()
    for _, id, title, subtitle in rows:
        held[id][0].update(title.split())
        held[id][1].update(subtitle.split())
    for title, subtitle in held.values():
        want.update(set(itertools.combinations(sorted(title), 2)) | set(itertools.combinations(sorted(subtitle), 2)))
    items = spark.createDataFrame(rows, ITEM)
    vocab = spark.createDataFrame([(w, w.upper(), 0) for w in words], "word_low string, display string, seq int")
    got = keywords.frequent_pairs(items, vocab, 3, per_group).collect()
    assert {(r["w1"], r["w2"]): r["unmatched_item_count"] for r in got} == {p: n for p, n in want.items() if n >= 3}
    ranked = keywords.ranked_frequent_pairs(items, vocab, 3, rows_per_bucket=100).collect()
    order = sorted(((-n, *p) for p, n in want.items() if n >= 3))
    assert [(r["w1"], r["w2"]) for r in sorted(ranked, key=lambda r: r["rank"])] == [o[1:] for o in order]


def test_a_field_travels_once_per_group():
    import numpy as np
    import pyarrow as pa

    shared = type("Sent", (), {"value": (np.zeros(0, np.int64), np.zeros(0, np.int64))})
    one = pa.RecordBatch.from_pydict({"h": [5], "title_ids": [[]], "subtitle_ids": [list(range(1, 301))]},
                                     schema=pa.schema([("h", pa.int64()), ("title_ids", pa.list_(pa.int64())), ("subtitle_ids", pa.list_(pa.int64()))]))
    sent = list(keywords._deal_lists(4, shared, pa.int32())([one]))
    assert sum(b.num_rows for b in sent) == 4
    assert sum(len(x) for b in sent for x in b.column("ids").to_pylist()) <= 4 * 300


def test_pair_stats_equal_listed_triggers(spark):
    rng = random.Random(11)
    vocabulary = ["ab", "Ab", "cd", "CD", "ef", "gh", "été", "zz", "Zz", "qq"]
    items = [(k, rng.choice([None, "a", "b", "c", f"i{k}"]), *[" ".join(rng.choices(vocabulary, k=rng.randrange(7))) for _ in range(2)]) for k in range(80)]
    items = spark.createDataFrame(items, "pos long, id string, title string, subtitle string")
    low = [w.lower() for w in vocabulary]
    made = [
        (rng.choice([1, 1, 2, None]), rng.choice(["title", "subtitle"]), rng.choice(low), rng.choice(low), rng.choice(["x", "y", "other", "z"]),
         rng.choice([None, 0.5, 0.9, 1.0]), "s", k)
        for k in range(90)
    ]
    made = spark.createDataFrame(made, "depth int, side string, w1 string, w2 string, category_slug string, confidence double, source string, seq long")
    listed = rules.trigger_stats(rules.rank_categories(rules.match_triggers(items, made)))
    # items of one identifier may tie in all that names the first spelling
    columns = [c for c in listed.columns if c != "display"]
    want = sorted(map(tuple, listed.select(columns).collect()))
    got = rules.pair_stats(items, made, text_per_task=200)
    assert want and sorted(map(tuple, got.select(columns).collect())) == want
    assert sorted(map(tuple, rules.pair_stats(items, made, broadcast_bytes=0).select(columns).collect())) == want
    named = items.filter("id IS NOT NULL").dropDuplicates(["id"])
    want = rules.trigger_stats(rules.rank_categories(rules.match_triggers(named, made))).collect()
    assert rules.pair_stats(named, made, text_per_task=200).collect() == want
    assert rules.pair_stats(items.limit(0), made).count() == 0 and rules.pair_stats(items, made.limit(0)).count() == 0


def test_trigger_stats_makes_no_row_per_trigger(spark, sf):
    from workloads.catalog import QUERIES

    plan = QUERIES["trigger_stats"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate posexplode" not in plan and "MapInArrow" in plan


def test_words_of_a_field_go_to_few_groups():
    import numpy as np
    import pyarrow as pa

    for blocks in (1, 2, 4, 7, 57, 200, 1000):
        cover = keywords._cover(blocks)
        owned = keywords._owned(blocks, cover)
        assert len(owned) == blocks // 2 + 1 and all((cover[q] - cover[p]) % blocks == d for d, (p, q) in enumerate(owned))
    shared = type("Sent", (), {"value": (keywords._cover(57), None)})
    schema = pa.schema([("title_ids", pa.list_(pa.int64())), ("subtitle_ids", pa.list_(pa.int64()))])
    one = pa.RecordBatch.from_pydict({"title_ids": [[]], "subtitle_ids": [list(range(1, 1001))]}, schema=schema)
    assert sum(len(x) for b in keywords._deal_lists(57, shared, pa.int32())([one]) for x in b.column("ids").to_pylist()) == 8 * 1000
    assert np.unique([len(keywords._plane(q)) - q for q in keywords.PLANES]).tolist() == [1]


def test_counted_pairs_are_neither_dealt_nor_sorted_as_rows(spark):
    words = [f"w{chr(97 + k)}" for k in range(20)]
    items = spark.createDataFrame([(k, f"i{k}", " ".join(words[k % 5 :]), "") for k in range(40)], ITEM)
    vocab = spark.createDataFrame([(w, w.upper()) for w in words], "word_low string, display string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(keywords.frequent_pairs(items, vocab, 3)).count("Exchange hashpartitioning") == 1
    ranked = keywords.ranked_frequent_pairs(items, vocab, 3)
    assert "Exchange" not in plan(ranked).replace("BroadcastExchange", "")
    dealt = keywords.ranked_frequent_pairs(items, vocab, 3, batch=7)
    asked = model_tables.pair_requests(dealt.withColumn("pair_no", F.col("rank") - 1), 7)
    assert plan(asked).count("Exchange hashpartitioning") == 1
    want = model_tables.pair_requests(ranked.withColumn("pair_no", F.col("rank") - 1), 7)
    assert sorted(map(tuple, asked.collect())) == sorted(map(tuple, want.collect())) and want.count() > 5


@pytest.mark.parametrize("seed", range(4))
def test_certain_claims_come_first_and_only_the_rest_is_hit(spark, seed):
    rnd = random.Random(seed)
    words = [f"w{chr(97 + k)}" for k in range(9)]
    items = [(k, f"i{k}", " ".join(rnd.choices(words, k=rnd.randrange(2, 6))), rnd.choice(words)) for k in range(60)]
    pairs = [(a, b, k * 2 + 1) for k, (a, b) in enumerate(rnd.sample(list(itertools.combinations(words, 2)), 30))]
    items, pairs = spark.createDataFrame(items, ITEM), spark.createDataFrame(pairs, "w1 string, w2 string, rank long")
    for least in (2, 4, 7):
        certain, rest = decisions.certain_claims(items, pairs, least)
        late = decisions.claim_with_minimum(decisions.pair_hits(rest, pairs), least, certain)
        want = decisions.claim_with_minimum(decisions.pair_hits(items, pairs), least)
        columns = ["pos", "id", "rank"]
        assert sorted(map(tuple, certain.unionByName(late).select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
        assert rest.count() < least * 30 and certain.count() + rest.count() <= 60


def test_pair_stats_list_no_triggers_for_rules_of_some_portions(spark):
    low = [f"w{chr(97 + k)}" for k in range(12)]
    made = [(1, "title", a, b, "x", 0.9, "s", k) for k, (a, b) in enumerate(itertools.combinations(low, 2))]
    items = spark.createDataFrame([(k, f"i{k}", " ".join(low[k % 7 :]), "") for k in range(30)], ITEM)
    made = spark.createDataFrame(made, RULE)
    bound = rules.measured_bytes(rules._probe(made, ["word"])) // 5
    got = rules.pair_stats(items, made, broadcast_bytes=bound)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate posexplode" not in plan
    assert got.collect() == rules.pair_stats(items, made).collect()
    assert got.collect() == rules.trigger_stats(rules.rank_categories(rules.match_triggers(items, made))).collect()


def test_a_group_of_pairs_leaves_in_chunks():
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(5)
    fields = [(sorted(rnd.sample(range(1, 60), rnd.randrange(2, 9))), sorted(rnd.sample(range(1, 60), rnd.randrange(2, 20)))) for _ in range(50)]
    schema = pa.schema([("title_ids", pa.list_(pa.int64())), ("subtitle_ids", pa.list_(pa.int64()))])
    lists = pa.RecordBatch.from_pydict({"title_ids": [t for t, _ in fields], "subtitle_ids": [s for _, s in fields]}, schema=schema)
    want = Counter(p for t, s in fields for p in set(itertools.combinations(t, 2)) | set(itertools.combinations(s, 2)))
    for blocks in (4, 7):
        cover = keywords._cover(blocks)
        shared = type("Sent", (), {"value": (cover, keywords._owned(blocks, cover))})
        (dealt,) = keywords._deal_lists(blocks, shared, pa.int16())([lists])
        got = Counter()
        for g in range(blocks):
            own = dealt.filter(pa.array(np.asarray(dealt.column("block")) == g))
            out = list(keywords._count_pairs(2, blocks, 60 // blocks + 1, shared, 30, 9)(iter([own])))
            assert max(len(b.column("b").flatten()) for b in out) < 300 and len(out) > 1
            for b in out:
                for x, others, counts in zip(*(b.column(c).to_pylist() for c in ("a", "b", "n"))):
                    got.update({(x, y): n for y, n in zip(others, counts)})
        assert got == {p: n for p, n in want.items() if n >= 2}
