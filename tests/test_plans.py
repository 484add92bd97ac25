import json

from pyspark.sql import functions as F

from shelfwise.operators import publish, taxonomy
from shelfwise.plans import categorize
from workloads.views import view


def test_whole_run(spark, sf):
    """Counts add up from the catalog to the merged result, which passes validation."""
    items = view(spark, sf, "items")
    nodes = taxonomy.flatten_tree(view(spark, sf, "tree"))
    by_group, remaining = categorize.match_by_groups(items, view(spark, sf, "decision_log"), nodes, 1.0)
    assert by_group.count() + remaining.count() == items.count()
    by_rule, unmatched = categorize.match_by_rules(items, view(spark, sf, "rules"), nodes)
    assert by_rule.count() + unmatched.count() == items.count()
    leaf = taxonomy.leaves(nodes, with_catch_all=False).first()["leaf_path"]

    def answer(prompt):
        given, _, asked = prompt.partition("\nItems:\n")
        leaves = [json.loads(x)["leaf_path"] for x in given.split("\n")[1:]]
        assert leaf in leaves
        ids = [json.loads(x)["id"] for x in asked.split("\n")]
        return "[" + ", ".join(f'{{"id": "{i}", "leaf_path": "{leaf}", "confidence": 0.95}}' for i in ids) + "]"

    taken = by_group.select("id").unionByName(by_rule.select("id"))
    by_model = categorize.match_by_model(items, nodes, taken, answer, 2)
    matched, left = categorize.merge_all(items, by_group, by_rule, by_model)
    assert matched.count() + left.count() == items.count()
    assert matched.select("id").distinct().count() == matched.count()
    only_model = matched.filter("method = 'llm_match'")
    assert publish.validate(only_model.withColumn("pos", F.lit(0).cast("long")), nodes).isEmpty()


def test_rules_from_tree_match_back(spark, sf):
    items = view(spark, sf, "items")
    nodes = taxonomy.flatten_tree(view(spark, sf, "tree"))
    made = categorize.rules_from_tree(items, nodes, [1, 2])
    assert made.count() == made.dropDuplicates(["depth", "side", "w1", "w2"]).count() > 0
    assert categorize.match_by_rules(items, made, nodes)[0].count() > 0


def test_leaf_requests_bring_the_leaves_they_name(spark, sf):
    from workloads.catalog import QUERIES

    rows = QUERIES["model_requests_leaf"](spark, sf).collect()
    leaves = "\n".join(r["lines"] for r in sorted((r for r in rows if r["part"] == "choices"), key=lambda r: r["batch_no"])).split("\n")
    assert leaves == [r["line"] for r in QUERIES["model_choices_leaf"](spark, sf).orderBy("slot").collect()]
    assert len({r["choices_id"] for r in rows}) == 1


def test_ranges_of_leaf_requests_are_cut_by_bytes(spark, monkeypatch):
    from shelfwise.operators import model_tables

    seen, plain = [], model_tables.number_rows
    monkeypatch.setattr(model_tables, "number_rows", lambda *a, **k: seen.append(k.get("rows_per_bucket")) or plain(*a, **k))
    items = spark.range(300).selectExpr("id AS pos", "concat('i', id) AS id", "repeat('x', 1000) AS title", "CAST(NULL AS STRING) AS subtitle")
    whole = model_tables.leaf_requests(items)
    cut = model_tables.leaf_requests(items, bytes_per_task=50_000)
    assert seen[0] == 300 and seen[1] == 42
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_regex_pass_deals_items_of_one_partition_out(spark):
    from shelfwise.operators import extraction

    rows = spark.range(400).coalesce(1).selectExpr("id AS pos", "concat('i', id) AS id", "'a/b' AS leaf_path", "concat('bolt ', id, '/16') AS title", "'bolt' AS template")
    attributes = spark.createDataFrame([("a/b", 0, "size", "Size", "in", "number")], "leaf_path string, attr_seq int, key string, label string, unit string, value_type string")
    patterns = spark.createDataFrame([("a/b", "size", "bolt", "(?P<val>[0-9]+/16)", "text_raw", 0)], "leaf_path string, key string, template string, regex string, value_normalize string, seq int")
    clusters = spark.createDataFrame([("a/b", "bolt", 400, "bolt 1/16")], "leaf_path string, template string, item_count long, representative string")
    got = extraction.extract_values(rows, attributes, patterns, clusters)
    held = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(held) == 400 and max(held) < 200
    assert got.filter(F.size("values") == 1).count() == 400
