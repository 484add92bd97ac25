"""Registered queries: each operator of the package over the catalog views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import text as tx
from shelfwise.operators import decisions, extraction, groups, keywords, merge, model_tables, publish, report, rules, taxonomy, templates
from shelfwise.scale import broadcast_if_small, cut_and_count, cut_lineage, number_rows
from workloads.views import view

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- shared steps
def nodes_of(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.flatten_tree(view(spark, d, "tree"))


def strict_counts(spark: SparkSession, d: str) -> DataFrame:
    return rules.count_triggers(view(spark, d, "items"), view(spark, d, "rules"), cross=False)


def cross_counts(spark: SparkSession, d: str) -> DataFrame:
    return rules.count_triggers(view(spark, d, "items"), view(spark, d, "rules"), cross=True)


def cross_triggers(spark: SparkSession, d: str) -> DataFrame:
    return rules.match_triggers(view(spark, d, "items"), view(spark, d, "rules"), cross=True)


def one_set(spark: SparkSession, d: str) -> DataFrame:
    """All rules as a single rule set."""
    return view(spark, d, "rules").withColumn("depth", F.lit(1))


def trigger_text(ranked: DataFrame) -> DataFrame:
    """Triggers as one string, for engines that hash nested values differently."""
    one = lambda t: F.concat_ws(":", t["w1"], t["w2"], F.format_number(-t["neg"], 2), t["source"])
    return ranked.withColumn("triggers", F.array_join(F.transform("triggers", one), "|"))


# ---------------------------------------------------------------- items and text
@query
def valid_items(spark, d):
    from shelfwise.sources.documents import valid_items as valid

    return valid(view(spark, d, "raw_items"))


@query
def normalized_titles(spark, d):
    b = groups.block_items(view(spark, d, "items"))
    return b.select("id", "norm", "token", "band")


@query
def item_tokens(spark, d):
    return view(spark, d, "items").select(
        "id",
        F.array_join(tx.letter_tokens(F.col("title")), " ").alias("tokens"),
        F.array_join(F.array_sort(tx.token_set(F.col("subtitle"))), " ").alias("subtitle_set"),
        F.array_join(F.array_sort(tx.keyword_set(F.col("title"))), " ").alias("keywords"),
        F.length(tx.combined_text(F.col("title"), F.col("subtitle"))).cast("long").alias("text_length"),
    )


@query
def keyword_df(spark, d):
    return keywords.ranked_keywords(keywords.keyword_counts(view(spark, d, "items")))


# ---------------------------------------------------------------- rules
@query
def rule_last_wins(spark, d):
    return rules.last_rule_per_pair(view(spark, d, "rules"))


@query
def match_strict(spark, d):
    ranked = rules.rank_categories(rules.match_triggers(view(spark, d, "items"), one_set(spark, d), cross=False))
    return trigger_text(ranked).drop("pos", "phase")


@query
def match_cross(spark, d):
    ranked = rules.rank_categories(rules.match_triggers(view(spark, d, "items"), one_set(spark, d), cross=True))
    return trigger_text(ranked).drop("pos", "phase")


@query
def top_category(spark, d):
    return rules.top_categories(rules.rank_counts(strict_counts(spark, d))).select(
        "id", "category_slug", "matched_bigram_count", "max_confidence"
    )


@query
def match_totals(spark, d):
    return rules.item_totals(rules.rank_counts(cross_counts(spark, d))).drop("pos").orderBy(
        F.desc("total_triggered_bigrams"), F.desc("max_confidence"), "id"
    )


@query
def cascade_match(spark, d):
    paths = taxonomy.slug_paths(nodes_of(spark, d))
    ranked = rules.rank_counts(cross_counts(spark, d), paths)
    return ranked.drop("pos")


@query
def cascade_files(spark, d):
    """Subtitle rules in a file of their own, behind the title rules of the same depth."""
    files = view(spark, d, "rules").withColumn("file_no", F.when(F.col("side") == "title", 0).otherwise(1))
    found = rules.count_triggers(view(spark, d, "items"), files, cross=True)
    return rules.top_categories(rules.rank_counts(found)).select("id", "phase", "category_slug", "matched_bigram_count")


@query
def trigger_stats(spark, d):
    return rules.pair_stats(view(spark, d, "items"), view(spark, d, "rules"))


@query
def unmatched_words(spark, d):
    return keywords.unmatched_words(rules.unmatched_items(view(spark, d, "items"), strict_counts(spark, d)))


# ---------------------------------------------------------------- taxonomy
@query
def taxonomy_nodes(spark, d):
    return nodes_of(spark, d).drop("ord")


@query
def taxonomy_leaves(spark, d):
    n = nodes_of(spark, d)
    open_leaves = taxonomy.leaves(n, with_catch_all=False).select("leaf_path", F.lit(True).alias("for_model"))
    return taxonomy.leaves(n, with_bare_roots=True).drop("ord").join(open_leaves, "leaf_path", "left").fillna(False, ["for_model"])


@query
def taxonomy_depths(spark, d):
    n = cut_lineage(nodes_of(spark, d))
    return taxonomy.depth_counts(n).join(broadcast_if_small(taxonomy.max_depth(n).withColumnRenamed("max_depth", "depth").withColumn("deepest", F.lit(True))), "depth", "left").fillna(False, ["deepest"])


@query
def top_level_categories(spark, d):
    return taxonomy.top_level_list(nodes_of(spark, d)).drop("ord")


@query
def slug_paths(spark, d):
    return taxonomy.slug_paths(nodes_of(spark, d))


@query
def slug_duplicates(spark, d):
    return taxonomy.slug_duplicates(nodes_of(spark, d))


@query
def anchor_tokens(spark, d):
    return taxonomy.anchor_tokens(nodes_of(spark, d))


@query
def catch_all_leaves(spark, d):
    return taxonomy.catch_all_leaves(nodes_of(spark, d))


@query
def leaf_search(spark, d):
    terms = spark.createDataFrame(
        [(" RING ", "small"), ("nation_1", ""), ("", "bolt"), ("façon", " "), ("supplier", "europe")], "query string, narrow string"
    )
    return taxonomy.search_leaves(taxonomy.leaves(nodes_of(spark, d)), terms)


@query
def maximal_paths(spark, d):
    p = view(spark, d, "part_words")
    leaf = F.concat_ws("/", "root", "noun", F.concat_ws("_", "adj", "noun"))
    deep = p.filter("p_size > 40").select(F.col("p_brand").alias("owner"), leaf.alias("path"))
    wide = p.select(F.col("p_brand").alias("owner"), F.concat_ws("/", "root", "noun").alias("path"))
    return taxonomy.maximal_paths(deep.unionByName(wide).distinct(), ["owner"])


@query
def taxonomy_insert(spark, d):
    proposals = view(spark, d, "supplier").join(view(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(
        view(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.concat_ws("/", F.lit("services"), F.replace(F.lower("r_name"), F.lit(" "), F.lit("_")), F.when(F.col("s_acctbal") > 0, F.lower("n_name"))).alias("parent_path"),
        F.when(F.col("s_acctbal") > 5000, F.col("s_name")).when(F.col("s_acctbal") > 2000, F.concat(F.lit(" New shop! "), F.col("n_name"))).otherwise("--").alias("display_name"),
        F.col("s_suppkey").alias("seq"),
    )
    return taxonomy.insert_leaves(nodes_of(spark, d), proposals)


# ---------------------------------------------------------------- rule generation
def parents_of(spark, d):
    n = nodes_of(spark, d)
    anchors = cut_lineage(taxonomy.anchor_tokens(n, [1, 2]))
    kw = cut_lineage(keywords.keyword_counts(view(spark, d, "items")))
    return kw, rules.word_parents(kw, anchors)


@query
def word_parents(spark, d):
    return parents_of(spark, d)[1]


@query
def pair_rules(spark, d):
    kw, parents = parents_of(spark, d)
    return rules.sort_rules(rules.pair_rules(kw, cut_lineage(parents)))


@query
def pair_rules_all_tiers(spark, d):
    kw, parents = parents_of(spark, d)
    return rules.pair_rules(kw, cut_lineage(parents), min_confidence=0.7)


# ---------------------------------------------------------------- frequent pairs and pair decisions
def vocabulary_of(items):
    words = keywords.unmatched_words(items).withColumn("seq", F.struct(-F.col("unmatched_item_count"), -F.col("token_count"), "word"))
    return keywords.vocabulary(words, "seq")


@query
def vocabulary(spark, d):
    """Words of the raw part and type lists, first spelling kept."""
    spellings = F.posexplode(F.array("p_type", F.initcap("p_type"), "p_brand", "p_name")).alias("at", "word")
    raw = view(spark, d, "part").select("p_partkey", spellings).select("word", (F.col("p_partkey") * 4 + F.col("at")).alias("seq"))
    return keywords.vocabulary(raw, "seq")


@query
def frequent_pairs(spark, d):
    """Over a list in which every item stands twice, as in lists that several runs wrote."""
    items = view(spark, d, "items")
    again = items.withColumn("subtitle", F.lit("")).withColumn("pos", F.col("pos") + 10**12)
    return keywords.frequent_pairs(items.unionByName(again), vocabulary_of(items))


def pair_state(spark, d):
    items = view(spark, d, "items")
    ranked = keywords.ranked_frequent_pairs(items, vocabulary_of(items))
    latest = cut_lineage(decisions.latest_decisions(view(spark, d, "pair_log"), ["rank"]))
    # pairs behind the last decided one meet no decision; they need not be dealt for the join
    last = latest.agg(F.coalesce(F.max("rank"), F.lit(0))).first()[0]
    decided = cut_lineage(ranked.filter(F.col("rank") <= last).join(broadcast_if_small(latest), "rank"))
    return items, ranked, decided


@query
def pair_claims(spark, d):
    items, _, decided = pair_state(spark, d)
    claims = decisions.first_claims(items, decided.filter("kind = 'assign'"))
    return decisions.assign_pairs(claims, decided).select("id", "leaf_path", "leaf_slug", "source")


@query
def pair_claims_min(spark, d):
    items, _, decided = pair_state(spark, d)
    pairs = decided.filter("kind = 'assign'")
    certain, rest = decisions.certain_claims(items, pairs, 10)
    late = decisions.claim_with_minimum(decisions.pair_hits(rest, pairs), 10, certain)
    return certain.unionByName(late).select("id", "rank")


@query
def pair_work_remaining(spark, d):
    items, ranked, decided = pair_state(spark, d)
    claims = decisions.first_claims(items, decided.filter("kind = 'assign'"))
    return decisions.work_remaining(items, claims, ranked, decided.select("rank"))


# ---------------------------------------------------------------- similar titles
@query
def block_sizes(spark, d):
    return groups.block_sizes(groups.block_items(view(spark, d, "items")))


@query
def similar_groups(spark, d):
    return title_groups(spark, d).select("group_id", "method", "id")


@query
def clique_groups(spark, d):
    return groups.group_members(view(spark, d, "items"), method="clique").select("group_id", "method", "id")


@query
def equal_groups(spark, d):
    """Groups of equal titles, as a caller gets them at threshold 1."""
    return groups.group_members(view(spark, d, "items"), min_sim=1.0).select("group_id", "method", "id")


def title_groups(spark, d):
    return groups.group_members(view(spark, d, "items"))


@query
def group_labels(spark, d):
    return groups.group_heads(title_groups(spark, d))


@query
def group_stats(spark, d):
    items = view(spark, d, "items")
    return groups.group_stats(items, cut_lineage(title_groups(spark, d)))


@query
def ungrouped_items(spark, d):
    return groups.ungrouped(view(spark, d, "items"), title_groups(spark, d)).select("id", "title")


def group_state(spark, d):
    members = cut_lineage(title_groups(spark, d))
    latest = cut_lineage(decisions.latest_decisions(view(spark, d, "decision_log")))
    leaf_rows = cut_lineage(taxonomy.leaves(nodes_of(spark, d)))
    return members, latest, decisions.assign_groups(members, latest, leaf_rows)


@query
def latest_decisions(spark, d):
    return decisions.latest_decisions(view(spark, d, "decision_log"))


@query
def group_decisions(spark, d):
    return group_state(spark, d)[2].select("id", "leaf_path", "leaf_slug", "leaf_display_name", "method", "source")


@query
def decision_counts(spark, d):
    members, latest, _ = group_state(spark, d)
    return decisions.decision_counts(members.select("group_id").distinct(), latest)


@query
def remaining_status(spark, d):
    members, latest, matched = group_state(spark, d)
    return decisions.remaining_items(view(spark, d, "items"), members, latest, matched).select("id", "group_id", "status")


@query
def merge_newest(spark, d):
    matched = group_state(spark, d)[2].select("pos", "id", "leaf_path", "method")
    prior = view(spark, d, "matched").select("pos", "id", "leaf_path", F.lit("prior").alias("method"))
    return decisions.merge_newest(prior, matched)


# ---------------------------------------------------------------- merging
def counted_lists(spark, d):
    """The four match sources with their rows: groups, rules, pairs, model."""
    items = view(spark, d, "items")
    n = nodes_of(spark, d)
    by_group = group_state(spark, d)[2]
    totals = rules.item_totals(rules.rank_counts(strict_counts(spark, d)))
    by_rule = merge.rule_rows(totals, taxonomy.slug_paths(n))
    log = decisions.latest_decisions(view(spark, d, "pair_log"), ["rank"])
    words = rules.last_rule_per_pair(view(spark, d, "rules")).select(F.least("w1", "w2").alias("w1"), F.greatest("w1", "w2").alias("w2")).distinct()
    decided = cut_lineage(number_rows(words, ["w1", "w2"], "rank").join(log, "rank").filter("kind = 'assign'"))
    by_pair = decisions.assign_pairs(decisions.first_claims(items, decided), decided)
    kept = view(spark, d, "predictions").filter("confidence >= 0.9 AND confidence <= 1.0").select("id", "leaf_path", "confidence")
    by_model = model_tables.merge_model_matches(items, kept, spark.createDataFrame([], "id string"))
    return items, [cut_and_count(m) for m in (by_group, by_rule, by_pair, by_model)]


def match_lists(spark, d):
    items, lists = counted_lists(spark, d)
    return items, [m for m, _ in lists]


@query
def merge_sources(spark, d):
    items, lists = match_lists(spark, d)
    return merge.with_texts(merge.dedupe_matched(merge.union_sources(*lists)), items)


@query
def unmatched_final(spark, d):
    items, (g, _, p, m) = match_lists(spark, d)
    doubled = items.unionByName(items.withColumn("title", F.lit("copy")).withColumn("pos", F.col("pos") + 10**12))
    return merge.final_unmatched(doubled, merge.dedupe_matched(merge.union_sources(g, p, m))).select("id", "title")


@query
def dedupe_accounting(spark, d):
    items, (g, _, p, m) = match_lists(spark, d)
    return merge.dedupe_accounting(merge.union_sources(g, p, m), items)


@query
def unmatched_report(spark, d):
    items, (g, _, _, m) = match_lists(spark, d)
    rows = cut_lineage(merge.union_sources(g, m))
    return merge.unmatched_report(merge.final_unmatched(items, merge.dedupe_matched(rows)), merge.dedupe_accounting(rows, items))


@query
def summary_levels(spark, d):
    n = cut_lineage(nodes_of(spark, d))
    rows = view(spark, d, "matched").select("leaf_path").unionByName(
        view(spark, d, "customer").select(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise(" ").alias("leaf_path"))
    ).unionByName(view(spark, d, "part_words").select(F.col("root").alias("leaf_path")))
    return merge.summary_levels(rows, n)


@query
def validate_rows(spark, d):
    n = cut_lineage(nodes_of(spark, d))
    rows = view(spark, d, "matched").select("pos", "id", "leaf_path").unionByName(
        view(spark, d, "part_words").select(
            (F.col("p_partkey") + 10**12).alias("pos"),
            F.when(F.col("p_size") < 5, "").otherwise(F.concat(F.lit("itm_"), F.lpad(F.col("p_partkey").cast("string"), 12, "0"))).alias("id"),
            F.when(F.col("p_size") > 45, " ").when(F.col("p_size") > 40, "nowhere").otherwise(F.concat_ws("/", "root", "noun")).alias("leaf_path"),
        )
    )
    return publish.validate(rows, n).select("pos", "id", "issue")


@query
def run_funnel(spark, d):
    items, lists = counted_lists(spark, d)
    _, merged = cut_and_count(merge.dedupe_matched(merge.union_sources(*[m for m, _ in lists])))
    counts = dict(zip(("groups", "rules", "pairs", "model"), (n for _, n in lists)))
    return report.funnel(spark, items.count(), **counts, merged=merged)


# ---------------------------------------------------------------- templates
def template_rows(spark, d):
    return templates.templated(view(spark, d, "matched"), cut_lineage(taxonomy.leaves(nodes_of(spark, d))))


@query
def title_templates(spark, d):
    return template_rows(spark, d).select("id", "leaf_path", "template")


@query
def template_reps(spark, d):
    return templates.template_clusters(template_rows(spark, d)).drop("first_pos")


@query
def template_members(spark, d):
    rows = template_rows(spark, d)
    return templates.template_members(rows, templates.template_clusters(rows)).drop("pos")


@query
def top_templates(spark, d):
    """Clusters by type of part, where many templates compete."""
    rows = view(spark, d, "matched").join(view(spark, d, "part_leaf").select("leaf_path").distinct(), "leaf_path", "left_semi")
    by_root = rows.withColumn("leaf_path", tx.master_slug(F.col("leaf_path"))).withColumn("template", tx.title_template(F.col("title")))
    return templates.top_clusters(templates.template_clusters(by_root), 5).select("leaf_path", "template", "item_count", "rank")


@query
def template_manifest(spark, d):
    return templates.manifest(template_rows(spark, d))


@query
def template_totals(spark, d):
    return templates.manifest_totals(templates.manifest(template_rows(spark, d)))


# ---------------------------------------------------------------- attribute schema and extraction
def schema_responses(spark, d):
    """Model answers that define attributes, as JSON text; leaves of a batch in path order."""
    rows = view(spark, d, "attr_rows")
    unit = F.when(F.col("symbol").isNotNull(), F.struct(F.col("symbol"), F.concat(F.lit("unit of "), "leaf_path").alias("name")))
    pattern = F.array(F.struct("template", "regex", F.col("hint").alias("value_normalize")))
    attr = F.struct("key", "label", F.col("vtype").alias("value_type"), F.col("symbol").isNotNull().alias("unit_required"), unit.alias("unit"), pattern.alias("patterns"))
    leaf = rows.groupBy("round", "leaf_path").agg(F.array_sort(F.collect_list(F.struct("attr_seq", attr.alias("a")))).alias("x"))
    cats = leaf.select("round", F.struct(F.col("leaf_path").alias("path"), F.col("x.a").alias("attributes")).alias("c"), "leaf_path")
    numbered = number_rows(cats, ["round", "leaf_path"], "n", start=0)
    return numbered.groupBy(F.expr("n div 3").alias("batch_no")).agg(F.array_sort(F.collect_list(F.struct("n", "c"))).alias("x")).select(
        "batch_no", F.to_json(F.struct(F.col("x.c").alias("categories"))).alias("response")
    )


def schema_of(spark, d):
    return [cut_lineage(t) for t in model_tables.attribute_schema(cut_lineage(schema_responses(spark, d)))]


@query
def attribute_schema(spark, d):
    return model_tables.attribute_schema(schema_responses(spark, d))[1]


@query
def attribute_units(spark, d):
    return model_tables.attribute_schema(schema_responses(spark, d))[0]


@query
def attribute_patterns(spark, d):
    return model_tables.attribute_schema(schema_responses(spark, d))[2]


@query
def schema_coverage(spark, d):
    units, attributes, patterns = schema_of(spark, d)
    return model_tables.schema_coverage(attributes, patterns, units, templates.manifest(template_rows(spark, d)))


def extraction_state(spark, d):
    rows = cut_lineage(template_rows(spark, d))
    clusters = cut_lineage(templates.template_clusters(rows))
    units, attributes, patterns = schema_of(spark, d)
    good = cut_lineage(extraction.smoke_test(patterns, clusters))
    return rows, clusters, attributes, good, extraction.extract_values(rows, attributes, good, clusters)


@query
def pattern_smoke(spark, d):
    return extraction_state(spark, d)[3]


@query
def regex_values(spark, d):
    return extraction.regex_values(extraction_state(spark, d)[4])


@query
def extraction_routing(spark, d):
    return extraction.fallback_items(extraction_state(spark, d)[4]).drop("pos", "title")


def value_responses(spark, d):
    """Fallback answers as JSON text, one per order and leaf; booleans and nulls included."""
    rows = view(spark, d, "value_answers")
    conf = F.when(F.col("conf") == "true", "true").otherwise(F.concat(F.lit('"'), "conf", F.lit('"')))
    value = F.when(F.col("value") == "", "null").otherwise(F.col("value"))
    one = F.format_string('{"item_id": "%s", "attributes": [{"attribute_key": "%s", "value": %s, "unit": null, "confidence": %s}]}', "item_id", "attribute_key", value, conf)
    return rows.groupBy(F.col("l_orderkey").alias("batch_no"), "leaf_path").agg(
        F.concat(F.lit('{"results": ['), F.array_join(F.array_sort(F.collect_list(one)), ", "), F.lit("]}")).alias("response")
    )


@query
def model_values(spark, d):
    v = model_tables.value_answers(value_responses(spark, d)).withColumn("accepted", extraction.is_accepted(F.col("extraction_confidence")))
    return v.groupBy("item_id", "leaf_path", "attribute_key", "value", "extraction_confidence", "accepted").agg(F.count(F.lit(1)).alias("n"))


@query
def extraction_stats(spark, d):
    rows, _, _, _, extracted = extraction_state(spark, d)
    total = view(spark, d, "matched").agg(F.count(F.lit(1)).alias("total_items"))
    return extraction.extraction_stats(total, extracted, model_tables.value_answers(value_responses(spark, d)))


@query
def all_values(spark, d):
    """Accepted regex and model values together, counted per label."""
    mine = extraction.regex_values(extraction_state(spark, d)[4])
    theirs = model_tables.value_answers(value_responses(spark, d))
    both = mine.unionByName(theirs.filter(extraction.is_accepted(F.col("extraction_confidence"))))
    return both.groupBy("extraction_confidence").agg(F.count(F.lit(1)).alias("n_values"))


# ---------------------------------------------------------------- model requests and answers
def leaf_choices(spark, d):
    leaf_rows = taxonomy.leaves(nodes_of(spark, d), with_catch_all=False)
    return model_tables.choice_table(leaf_rows, ["leaf_path", "display_name"], "ord")


@query
def model_requests_leaf(spark, d):
    """Item requests and the leaves an answer may name; the leaves are one list for all requests, which carry its identifier."""
    choices, name = leaf_choices(spark, d)
    requests = model_tables.leaf_requests(view(spark, d, "items")).withColumn("choices_id", F.lit(name))
    return requests.withColumn("part", F.lit("items")).unionByName(model_tables.choice_rows(choices).withColumn("part", F.lit("choices")))


@query
def model_choices_leaf(spark, d):
    return leaf_choices(spark, d)[0]


@query
def model_offers(spark, d):
    """Branches offered for every item."""
    leaf_rows = taxonomy.leaves(nodes_of(spark, d), with_catch_all=False)
    return model_tables.offered_branches(view(spark, d, "items"), leaf_rows).drop("pos")


@query
def model_requests_pairs(spark, d):
    """Pairs that occur together in items, in list order, with the categories an answer may name."""
    items = view(spark, d, "items")
    ranked = keywords.ranked_frequent_pairs(items, vocabulary_of(items), batch=model_tables.PAIRS_PER_BATCH)
    allowed = taxonomy.top_level_list(nodes_of(spark, d))
    _, choices_id = model_tables.choice_table(allowed, ["slug", "display_name", "root"], "ord")
    return model_tables.pair_requests(ranked.withColumn("pair_no", F.col("rank") - 1)).withColumn("choices_id", F.lit(choices_id))


@query
def model_requests_attrs(spark, d):
    rows = cut_lineage(template_rows(spark, d))
    top = templates.top_clusters(templates.template_clusters(rows))
    return model_tables.attribute_requests(templates.manifest(rows), top, taxonomy.leaves(nodes_of(spark, d)))


@query
def model_requests_values(spark, d):
    _, _, attributes, _, extracted = extraction_state(spark, d)
    return model_tables.value_requests(extraction.fallback_items(extracted), attributes)


def leaf_responses(spark, d):
    """Leaf answers as JSON text: numeric ids, text confidences and fences as models give them."""
    p = view(spark, d, "predictions")
    key = F.when(F.col("lang") == "es", F.col("doc_id").cast("string")).otherwise(F.concat(F.lit('"'), "id", F.lit('"')))
    conf = F.when(F.col("lang") == "de", F.concat(F.lit('"'), F.col("confidence").cast("string"), F.lit('"'))).otherwise(F.col("confidence").cast("string"))
    one = F.concat(F.lit('{"id": '), key, F.lit(', "leaf_path": "'), "leaf_path", F.lit('", "confidence": '), conf, F.lit("}"))
    arr = F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", one.alias("o")))), lambda x: x["o"]), ", "), F.lit("]"))
    text = F.when(F.col("batch_no") % 2 == 1, F.concat(F.lit("Sure:\n```json\n"), "a", F.lit("\n```"))).otherwise(F.col("a"))
    return p.groupBy("batch_no").agg(arr.alias("a")).select("batch_no", text.alias("response"))


def leaf_answers(spark, d):
    leaf_rows = cut_lineage(taxonomy.leaves(nodes_of(spark, d), with_catch_all=False))
    return model_tables.valid_leaf_answers(leaf_responses(spark, d), leaf_rows)


@query
def model_responses_leaf(spark, d):
    return leaf_answers(spark, d).drop("at")


@query
def model_batches(spark, d):
    return model_tables.batch_report(view(spark, d, "predictions").select("batch_no", "id"), leaf_answers(spark, d))


@query
def model_responses_pairs(spark, d):
    """Pair answers over all pair rules of the parts and documents, as JSON text."""
    r = view(spark, d, "rules").withColumn("batch_no", F.expr("seq div 100"))
    one = F.to_json(F.struct(F.array("w1", "w2").alias("bigram"), F.col("category_slug").alias("suggested_parent_category_slug"), F.col("confidence").cast("string").alias("confidence")))
    text = r.groupBy("batch_no").agg(F.concat(F.lit("```\n["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", one.alias("o")))), lambda x: x["o"]), ", "), F.lit("]\n```")).alias("response"))
    allowed = taxonomy.top_level_list(nodes_of(spark, d))
    return model_tables.valid_pair_rules(text, allowed).drop("at")


@query
def model_merge(spark, d):
    items = view(spark, d, "items")
    kept = cut_lineage(model_tables.kept_leaves(leaf_answers(spark, d)))
    by_rule = strict_counts(spark, d).filter("phase = 2").select("id")
    return model_tables.merge_model_matches(items, kept, by_rule).select("id", "leaf_path", "leaf_slug", "confidence", "source")


@query
def model_unmatched(spark, d):
    items = view(spark, d, "items")
    kept = cut_lineage(model_tables.kept_leaves(leaf_answers(spark, d)))
    return model_tables.still_unmatched(items, strict_counts(spark, d).filter("phase = 2").select("id"), kept).select("id")


# ---------------------------------------------------------------- publishing
@query
def first_store(spark, d):
    return publish.items_with_store(view(spark, d, "shop_items"), view(spark, d, "store_items"), view(spark, d, "stores")).select("id", "title", "store_name")


@query
def live_categories(spark, d):
    return publish.live(view(spark, d, "shop_categories"), ["id", "parent_id", "name", "slug"], ["id"])


@query
def publish_categories(spark, d):
    return publish.publish_categories(cut_lineage(nodes_of(spark, d)), view(spark, d, "shop_categories"))[1]


def link_state(spark, d):
    ids, _ = publish.publish_categories(cut_lineage(nodes_of(spark, d)), view(spark, d, "shop_categories"))
    return publish.publish_links(view(spark, d, "matched"), cut_lineage(ids), view(spark, d, "shop_items"), view(spark, d, "shop_links"))


@query
def publish_links(spark, d):
    return link_state(spark, d)[0]


@query
def rejected_links(spark, d):
    return link_state(spark, d)[1]


def no_units(spark):
    return spark.createDataFrame([("ft", "u1")], "symbol string, id string")


def no_attributes(spark):
    return spark.createDataFrame([], "category_id string, key string, id string")


def attribute_state(spark, d):
    units, attributes, _ = schema_of(spark, d)
    unit_ids, unit_rows = publish.publish_units(units, no_units(spark))
    unit_ids = cut_lineage(unit_ids)
    cats = view(spark, d, "shop_categories")
    wide = attributes.withColumn("leaf_path", F.concat_ws("/", F.slice(F.split("leaf_path", "/"), 1, 2)))
    return wide, unit_ids, unit_rows, publish.publish_attributes(wide, unit_ids, cats, no_attributes(spark))


@query
def publish_units(spark, d):
    return attribute_state(spark, d)[2].select("id", "symbol", "value_type")


@query
def publish_attributes(spark, d):
    return attribute_state(spark, d)[3][1]


@query
def attributes_without_category(spark, d):
    _, attributes, _ = schema_of(spark, d)
    return publish.publish_attributes(attributes, no_units(spark), view(spark, d, "shop_categories"), no_attributes(spark))[2]


def value_state(spark, d):
    _, unit_ids, _, (ids, _, _) = attribute_state(spark, d)
    values = extraction.regex_values(extraction_state(spark, d)[4]).withColumn(
        "leaf_path", F.concat_ws("/", F.slice(F.split("leaf_path", "/"), 1, 2))
    )
    return publish.resolve_values(values, cut_lineage(ids), unit_ids)


@query
def publish_values(spark, d):
    return publish.publish_values(value_state(spark, d), view(spark, d, "shop_values").select("item_id", "attribute_id", "value"))


@query
def skipped_values(spark, d):
    return publish.skipped_values(value_state(spark, d))


@query
def publish_dry_run(spark, d):
    nodes = cut_lineage(nodes_of(spark, d))
    links, rejects = link_state(spark, d)
    return publish.dry_run(categories=publish.publish_categories(nodes, view(spark, d, "shop_categories"))[1], links=links, rejected=rejects)


@query
def gap_report(spark, d):
    return publish.gap_counts(view(spark, d, "shop_items"), view(spark, d, "shop_links"), view(spark, d, "shop_values"))


@query
def taxonomy_gaps(spark, d):
    return publish.taxonomy_gaps(nodes_of(spark, d), view(spark, d, "shop_categories"))


# ---------------------------------------------------------------- runs
@query
def latest_run(spark, d):
    from shelfwise.sources import runs

    r = view(spark, d, "runs")
    return runs.latest_run(r, "prod").unionByName(runs.latest_run(r, "dev")).unionByName(runs.latest_run(r, "")).unionByName(
        runs.latest_run(r, "staging", ["step"])
    )


@query
def latest_run_of_source(spark, d):
    from shelfwise.sources import runs

    return runs.latest_for_source(view(spark, d, "runs"))


@query
def latest_run_pair(spark, d):
    from shelfwise.sources import runs

    return runs.latest_pair(view(spark, d, "runs"), "URGENT", "HIGH")


@query
def run_list(spark, d):
    from shelfwise.sources import runs

    rows = view(spark, d, "lineitem").select(F.concat(F.lit("run_"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0")).alias("run_id"))
    return runs.run_list(view(spark, d, "runs"), rows)


@query
def run_labels(spark, d):
    return view(spark, d, "runs").select("run_id", tx.run_label(F.col("run_ts"), F.col("env")).alias("label"))


@query
def run_taxonomy(spark, d):
    from shelfwise.sources import runs

    return runs.taxonomy_of_run(view(spark, d, "runs"), "categories_default")


# ---------------------------------------------------------------- documents and previews
@query
def match_document(spark, d):
    """The nested result document, summarized per item."""
    items = view(spark, d, "items")
    doc = rules.result_document(items, rules.rank_categories(cross_triggers(spark, d)))
    best = F.get("categories", F.lit(0))
    return doc.select(
        "id", "total_triggered_bigrams", "max_confidence", F.size("categories").cast("long").alias("n_categories"),
        best["category_slug"].alias("first_category"),
        F.array_join(F.get(best["triggering_bigrams"], F.lit(0))["bigram"], " ").alias("first_bigram"),
    )


@query
def group_preview(spark, d):
    return groups.preview(title_groups(spark, d)).select("group_id", "rank", "id")


@query
def handover_items(spark, d):
    members, latest, matched = group_state(spark, d)
    return decisions.handover(decisions.remaining_items(view(spark, d, "items"), members, latest, matched))


@query
def row_paths(spark, d):
    """Path used in summaries: the predicted leaf where it is not blank, else the top rule category."""
    totals = rules.item_totals(rules.rank_counts(strict_counts(spark, d)))
    p = view(spark, d, "predictions").select("id", F.when(F.col("confidence") < 0.3, " ").when(F.col("confidence") > 0.5, F.col("leaf_path")).alias("leaf_path"))
    return totals.join(p, "id", "left").select("id", merge.row_path(F.col("leaf_path"), F.col("top_category")).alias("path"))
