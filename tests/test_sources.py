import json

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import model_tables, publish, taxonomy, templates
from shelfwise.sources import documents, runs


def dump(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return str(path)


ROWS = [{"id": "a", "title": "T1"}, {"item_id": "b", "subtitle": "s"}, {"title": "no id"}, {"id": "", "item_id": "c", "title": "T3", "extra": 1}]


@pytest.mark.parametrize("wrap", [lambda r: r, lambda r: {"items": r}, lambda r: {"unmatched_items": r}])
def test_items(spark, tmp_path, wrap):
    got = documents.read_items(spark, dump(tmp_path / "i.json", wrap(ROWS))).orderBy("pos").collect()
    assert [(r.id, r.title, r.subtitle) for r in got] == [("a", "T1", ""), ("b", "", "s"), ("c", "T3", "")]
    assert [r.pos for r in got] == sorted({r.pos for r in got})


@pytest.mark.parametrize("wrap", [lambda r: r, lambda r: {"items": r}])
def test_one_bad_element_drops_alone(spark, tmp_path, wrap):
    rows = [{"id": "a"}, "str", 5, None, [1], {"id": 7}, {"id": True, "item_id": "b"}, {"id": "c", "title": 3}]
    got = documents.read_items(spark, dump(tmp_path / "i.json", wrap(rows))).orderBy("pos").collect()
    assert [(r.id, r.title) for r in got] == [("a", ""), ("b", ""), ("c", "3")]


def test_a_cut_file_raises(spark, tmp_path):
    (tmp_path / "i.json").write_text('[{"id": "a"}, {"id": "b"')
    with pytest.raises(Exception, match="MALFORMED|parse"):
        documents.read_items(spark, str(tmp_path / "i.json")).count()


def test_item_lines_and_tables(spark, tmp_path):
    (tmp_path / "i.jsonl").write_text("\n".join(json.dumps(r) for r in [*ROWS, 5, "x"]))
    got = documents.read_item_lines(spark, str(tmp_path / "i.jsonl")).orderBy("pos").collect()
    assert [(r.id, r.title, r.subtitle) for r in got] == [("a", "T1", ""), ("b", "", "s"), ("c", "T3", "")]
    spark.createDataFrame([("a", "T1", 1), (None, "T2", 2)], "id string, title string, extra int").coalesce(1).write.parquet(str(tmp_path / "t"))
    assert [(r.id, r.title) for r in documents.read_item_table(spark, str(tmp_path / "t")).collect()] == [("a", "T1")]


def test_rule_files_are_numbered(spark, tmp_path):
    rule = {"bigram": ["a", "b"], "suggested_parent_category_slug": "s", "confidence": 1.0, "source": "t"}
    for name in ("r1.json", "r2.json"):
        dump(tmp_path / name, {"taxonomy_depth": 2, "title_bigrams": [rule], "subtitle_bigrams": []})
    got = sorted((r.file_no, r.seq) for r in documents.read_rules(spark, str(tmp_path / "r*.json")).collect())
    assert got == [(0, 0), (1, 1 << 32)]


def test_deep_trees_are_read_whole(spark, tmp_path):
    tree = {"slug": "n0"}
    for k in range(1, 12):
        tree = {"slug": f"n{k}", "subcategories": [tree]}
    nodes = documents.read_tree(spark, dump(tmp_path / "t.json", {"services": {"subcategories": [tree]}}))
    assert nodes.count() == 13 and nodes.agg(F.max("depth")).first()[0] == 12
    rows = [("r", None, "r", "R", "0"), ("a", "r", "a", "A", "0"), ("a", "b", "a", "A", "0"), ("b", "a", "b", "B", "0")]
    with pytest.raises(ValueError, match="cyclic"):
        taxonomy.flatten_tree(spark.createDataFrame(rows, "node_key string, parent_key string, slug string, display_name string, sib string"))


def test_a_run_written_again_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "v long")
    for run in ("r1", "r2", "r1"):
        runs.write_run(df, str(tmp_path), "t", "dev", run)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_rules_keywords_and_schema(spark, tmp_path):
    rule = {"bigram": ["a", "b"], "suggested_parent_category_slug": "s", "confidence": 1.0, "source": "t"}
    got = documents.read_rules(spark, dump(tmp_path / "r.json", {"taxonomy_depth": 2, "title_bigrams": [rule], "subtitle_bigrams": [rule, rule]}))
    assert sorted((r.depth, r.side, r.w1, r.w2, r.seq) for r in got.collect()) == [(2, "subtitle", "a", "b", 0), (2, "subtitle", "a", "b", 1), (2, "title", "a", "b", 0)]
    kw = documents.read_keywords(spark, dump(tmp_path / "k.json", {"title": [{"word": "x", "item_count": 4}], "subtitle": []}))
    assert [tuple(r) for r in kw.select("side", "word", "item_count", "rank").collect()] == [("title", "x", 4, 1)]
    schema = {"units": {"in": {"symbol": "in", "name": "inch"}}, "_category_attributes": {"a/b": [{"key": "k", "unit": "in", "patterns": [{"template": "t", "regex": "r"}, {"template": "u", "regex": "q"}]}]}}
    units, attributes, patterns = documents.read_attribute_schema(spark, dump(tmp_path / "s.json", schema))
    assert units.first()["name"] == "inch" and attributes.first()["key"] == "k"
    assert sorted((r.seq, r.regex) for r in patterns.collect()) == [(0, "r"), (1, "q")]


def test_tree_document(spark, tmp_path):
    tree = {
        "services": {"display_name": "Services", "subcategories": [{"slug": "pièces", "display_name": "Pièces"}]},
        "materials": {"subcategories": [{"slug": "b", "subcategories": [{"slug": "z"}, {"slug": "a"}, {"display_name": "no slug", "subcategories": [{"slug": "lost"}]}]}, {"slug": "other"}]},
        "unknown_root": {"subcategories": [{"slug": "q"}]},
    }
    nodes = documents.read_tree(spark, dump(tmp_path / "t.json", tree)).orderBy("ord").collect()
    assert [n.path for n in nodes] == ["materials", "materials/b", "materials/b/z", "materials/b/a", "materials/other", "services", "services/pièces"]
    assert {n.path for n in nodes if n.is_leaf} == {"materials/b/z", "materials/b/a", "materials/other", "services/pièces"}
    assert [n.path for n in nodes if n.is_catch_all] == ["materials/other"]


def test_runs_round_trip(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, "a/b"), (2, "a/c")], "v long, leaf_path string")
    runs.publish_bundle(base, "prod", "20260101_000000", matched=df, nodes=df)
    runs.write_run(df.limit(1), base, "matched", "", "20260102_000000")
    runs.write_run(df, base, "by_leaf", "dev", "r1", by=("leaf_path",))
    runs.write_summary(spark, base, "prod", "20260101_000000", "merge", df.agg(F.count("*").alias("rows")), taxonomy_version="v1")
    back = runs.read_run(spark, base, "matched", "prod", "20260101_000000")
    assert back.count() == 2 and "PartitionFilters: [isnotnull(env" in back._jdf.queryExecution().toString()
    summary = {r["name"]: r["value"] for r in spark.read.parquet(base + "/run_summary").collect()}
    assert summary == {"rows": "2", "taxonomy_version": "v1"}
    runs.write_csv(df, base + "/csv")
    assert spark.read.option("header", True).csv(base + "/csv").count() == 2
    runs.write_json(df, base + "/json")
    registry = spark.createDataFrame([("r1", "s1")], "run_id string, source_run_id string")
    runs.require_source(registry, "r1", "s1")
    with pytest.raises(ValueError):
        runs.require_source(registry, "r1", "s2")
    assert len(runs.input_fingerprint(spark, base + "/matched").first()["fingerprint"]) == 16


def test_model_call_retries(spark):
    requests = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "batch_no long, lines string")
    state = {}

    def flaky(text):
        state[text] = state.get(text, 0) + 1
        if text == "p5" or state[text] < 2:
            raise RuntimeError("busy")
        return text.upper()

    got = {r.batch_no: r for r in model_tables.call_model(requests, F.col("lines"), ["batch_no"], flaky, 2, backoff=0.01).collect()}
    assert got[0].response == "P0" and got[0].error is None
    assert got[5].response is None and "busy" in got[5].error


def test_leaf_answers(spark):
    text = '[{"id": "a", "leaf_path": "m/x", "confidence": "0.9"}, {"id": 7, "leaf_path": "m/x", "confidence": 1}, {"id": "b", "leaf_path": "m/q", "confidence": 1}, {"id": "c", "leaf_path": "m/x", "confidence": 1.2}, {"id": "d", "leaf_path": "m/x", "confidence": null}, 5, {"id": "a", "leaf_path": "m/y", "confidence": 0.95}, {"id": "a", "leaf_path": "m/x", "confidence": 0.3}, {"id": "e", "leaf_path": "m/x", "confidence": true}]'
    leaf = spark.createDataFrame([("m/x",), ("m/y",)], "leaf_path string")
    ok = model_tables.valid_leaf_answers(spark.createDataFrame([(0, text)], "batch_no long, response string"), leaf)
    assert ok.count() == 4
    kept = {r.id: (r.leaf_path, r.confidence) for r in model_tables.kept_leaves(ok).collect()}
    assert kept == {"a": ("m/y", 0.95), "e": ("m/x", 1.0)}


def test_choices_are_stored_once(spark):
    rows = [(f"m/{k}", f"M {k}", f"{k:02d}") for k in range(12)]
    leaves = spark.createDataFrame(rows, "leaf_path string, display_name string, ord string")
    table, name = model_tables.choice_table(leaves, ["leaf_path"], "ord")
    assert [(r.slot, r.line) for r in table.orderBy("slot").collect()] == [(k, f'{{"leaf_path":"m/{k}"}}') for k in range(12)]
    assert {r.choices_id for r in table.collect()} == {name} == {model_tables.choice_table(leaves.repartition(4), ["leaf_path"], "ord")[1]}
    turned = spark.createDataFrame([(p, d, f"{99 - int(o):02d}") for p, d, o in rows], leaves.schema)
    assert model_tables.choice_table(turned, ["leaf_path"], "ord")[1] != name
    assert model_tables.choice_text(table).count("\n") == 11
    with pytest.raises(ValueError):
        model_tables.choice_text(table, 100)


def test_value_answers(spark):
    text = '{"results": [{"item_id": "i", "attributes": [{"attribute_key": "k", "value": " 1 3/4 ", "unit": "in", "confidence": " High "}, {"attribute_key": "k", "value": true, "confidence": "high"}, {"attribute_key": "k", "value": 7, "confidence": true}, {"attribute_key": "k", "value": "x", "confidence": "llm_low"}, {"attribute_key": "k", "value": "x"}]}]}'
    got = model_tables.value_answers(spark.createDataFrame([("m/x", 0, text)], "leaf_path string, batch_no long, response string")).collect()
    assert [(r.value, r.unit, r.extraction_confidence) for r in got] == [
        ("1 3/4", "in", "llm_high"), ("", None, "llm_none"), ("7", None, "llm_none"), ("x", None, "llm_low"), ("x", None, "llm_none")]


def test_validation_gate(spark):
    nodes = taxonomy.flatten_tree(spark.createDataFrame(
        [("m", None, "m", "M", "0"), ("m/x", "m", "x", "X", "1")], "node_key string, parent_key string, slug string, display_name string, sib string"))
    rows = spark.createDataFrame(
        [(0, "", "m/x"), (1, "a", " "), (2, "b", "m/x"), (3, "b", "m/x"), (4, "c", "m/q"), (5, "d", "m"), (6, "b", "m")], "pos long, id string, leaf_path string")
    got = sorted((r.pos, r.issue) for r in publish.validate(rows, nodes).collect())
    assert got == [(0, "missing id"), (1, "missing leaf_path"), (3, "duplicate id"), (4, "leaf_path not in taxonomy"),
                   (5, "leaf_path is not a leaf"), (6, "duplicate id"), (6, "leaf_path is not a leaf")]
    with pytest.raises(ValueError):
        publish.require_valid(rows, nodes)
    assert publish.require_valid(rows, nodes, allow_issues=True).count() == 7


def test_template_clusters(spark):
    rows = spark.createDataFrame([(i, f"i{i}", t, "m/x", "T") for i, t in enumerate(["aaaa", "a", "aaa", "bbb", "aa"])], "pos long, id string, title string, leaf_path string, template string")
    r = templates.template_clusters(rows).first()
    assert (r.item_count, r.median_len, r.representative, r.representative_id) == (5, 3, "aaa", "i2")
