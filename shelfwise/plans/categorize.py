"""Whole runs composed from the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import decisions, extraction, groups, keywords, merge, model_tables, rules, taxonomy, templates
from shelfwise.scale import cut_lineage


def rules_from_tree(items: DataFrame, nodes: DataFrame, depths: list[int], min_confidence: float = rules.MIN_RULE_CONFIDENCE) -> DataFrame:
    """Keywords of the items and tree words to pair rules, one rule set per depth."""
    words = cut_lineage(keywords.keyword_counts(items))
    parents = cut_lineage(rules.word_parents(words, cut_lineage(taxonomy.anchor_tokens(nodes, depths))))
    # pairs of one (depth, side) are distinct, so the order among them does not matter
    return rules.pair_rules(words, parents, min_confidence).withColumn("seq", F.lit(0).cast("long"))


def match_by_rules(items: DataFrame, rule_table: DataFrame, nodes: DataFrame, cross: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(match rows, unmatched items)`` of the depth cascade."""
    paths = cut_lineage(taxonomy.slug_paths(nodes))
    counts = cut_lineage(rules.count_triggers(items, rule_table, cross))
    totals = rules.item_totals(rules.rank_counts(counts, paths))
    return merge.rule_rows(totals, paths), rules.unmatched_items(items, counts)


def match_by_groups(items: DataFrame, log: DataFrame, nodes: DataFrame, min_sim: float = groups.MIN_SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """``(match rows, remaining items with status)`` of the similar-title decisions."""
    members = cut_lineage(groups.group_members(items, min_sim))
    latest = cut_lineage(decisions.latest_decisions(log))
    matched = cut_lineage(decisions.assign_groups(members, latest, taxonomy.leaves(nodes)))
    return matched, decisions.remaining_items(items, members, latest, matched)


def match_by_model(items: DataFrame, nodes: DataFrame, matched_ids: DataFrame, fn: Callable[[str], str], parallelism: int = 10) -> DataFrame:
    """Match rows from a leaf model; answers are checkpointed so a retry does not ask again."""
    leaf_rows = cut_lineage(taxonomy.leaves(nodes, with_catch_all=False))
    pool = items.join(matched_ids.select("id").distinct(), "id", "left_anti")
    choices, _ = model_tables.choice_table(leaf_rows, ["leaf_path", "display_name"], "ord")
    prompt = F.concat_ws("\n", F.lit("Leaves:"), F.lit(model_tables.choice_text(choices)), F.lit("Items:"), "lines")
    asked = model_tables.call_model(model_tables.leaf_requests(pool), prompt, ["batch_no"], fn, parallelism)
    answers = model_tables.valid_leaf_answers(cut_lineage(asked), leaf_rows)
    return model_tables.merge_model_matches(pool, model_tables.kept_leaves(answers), matched_ids)


def merge_all(items: DataFrame, *sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(matched, unmatched)`` with one row per id."""
    matched = cut_lineage(merge.dedupe_matched(merge.union_sources(*sources)))
    return merge.with_texts(matched, items), merge.final_unmatched(items, matched)


def extract_attributes(matched: DataFrame, nodes: DataFrame, attributes: DataFrame, patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(regex values, items for the fallback)``; ``matched`` needs ``pos``."""
    rows = templates.templated(matched, cut_lineage(taxonomy.leaves(nodes)))
    clusters = cut_lineage(templates.template_clusters(rows))
    good = cut_lineage(extraction.smoke_test(patterns, clusters))
    found = cut_lineage(extraction.extract_values(rows, attributes, good, clusters))
    return extraction.regex_values(found), extraction.fallback_items(found)
