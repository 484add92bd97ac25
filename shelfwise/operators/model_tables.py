"""Tables around a user-supplied model function: requests, calls, validated responses.

The model is any ``fn(prompt: str) -> str``; no vendor client is part of this package. Every
request group (pairs, items, leaves of a batch) is bounded by its batch size.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import text as tx
from shelfwise.operators.extraction import VALUE_COLUMNS
from shelfwise.scale import ROWS_PER_BUCKET, broadcast_if_small, cut_lineage, number_rows, side_by_side

PAIRS_PER_BATCH = 100
CHOICES_PER_ROW = 100
PROMPT_BYTES = 4 << 20
LINES_PER_TASK = 32 << 20
ITEMS_PER_BATCH = 25
LEAVES_PER_BATCH = 3
VALUES_PER_BATCH = 20
MIN_LEAF_CONFIDENCE = 0.9
MIN_PAIR_CONFIDENCE = 0.85


# ---------------------------------------------------------------- requests
def batch_rows(df: DataFrame, order: list[str], size: int, within: list[str] = [], **kw) -> DataFrame:
    """Add ``batch_no`` (from 0) and ``slot`` by list order, per ``within`` group."""
    numbered = number_rows(df, order, "slot", within=within, start=0, **kw)
    return numbered.withColumn("batch_no", F.expr(f"slot div {int(size)}")).withColumn(
        "slot", F.expr(f"slot % {int(size)}").cast("int")
    )


def joined_lines(df: DataFrame, keys: list[str], slot: str, line: str, out: str = "lines") -> DataFrame:
    """Lines of a bounded batch in slot order."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(slot).alias("s"), F.col(line).alias("l"))))
    return df.groupBy(*keys).agg(packed.alias("__p")).select(
        *keys, F.size("__p").alias("n_rows"), F.array_join(F.col("__p.l"), "\n").alias(out)
    )


def choice_table(choices: DataFrame, fields: list[str], order: str) -> tuple[DataFrame, str]:
    """``(choices_id, slot, line)``: what an answer may name, one JSON object per line, and its identifier.

    The identifier is a digest of the lines and their order, summed row by row, so the list is never put together.
    Requests carry the identifier; the list is stored once.
    """
    lines = choices.select(order, F.to_json(F.struct(*fields)).alias("line"))
    rows = cut_lineage(number_rows(lines, [order], "slot", start=0).select("slot", "line"))
    digest = F.md5(F.concat_ws(":", F.col("slot").cast("string"), "line").cast("binary"))
    part = lambda at: F.coalesce(F.sum(F.conv(F.substring(digest, at, 8), 16, 10).cast("long")), F.lit(0))
    n, first, second = rows.agg(F.count(F.lit(1)), part(1), part(9)).first()
    name = f"choices_{n}_{first}_{second}"
    return rows.select(F.lit(name).alias("choices_id"), "slot", "line"), name


def choice_text(choices: DataFrame, max_bytes: int = PROMPT_BYTES) -> str:
    """The lines of a choice table as one text, for a prompt; a list that no prompt can hold is an error."""
    size = choices.agg(F.coalesce(F.sum(F.octet_length("line")), F.lit(0))).first()[0]
    if size > max_bytes:
        raise ValueError(f"{size} bytes of choices do not fit a prompt; use offered_branches")
    return "\n".join(r["line"] for r in choices.orderBy("slot").collect())


def offered_branches(items: DataFrame, leaf_rows: DataFrame, levels: int = 2) -> DataFrame:
    """``(pos, id, branch, n_words)``: branches of the tree whose words an item holds, with how many of them."""
    branch = F.array_join(F.slice(F.split("leaf_path", "/"), 1, levels), "/")
    known = cut_lineage(
        leaf_rows.select(branch.alias("branch"), F.explode(tx.keyword_set(F.concat_ws(" ", "leaf_path", "display_name"))).alias("word")).distinct()
    )
    words = items.select(
        "pos", "id", F.explode(F.array_union(tx.token_set(F.col("title")), tx.token_set(F.col("subtitle")))).alias("word")
    )
    return words.join(broadcast_if_small(known), "word").groupBy("pos", "id", "branch").agg(F.count(F.lit(1)).alias("n_words"))


def pair_requests(pairs: DataFrame, size: int = PAIRS_PER_BATCH) -> DataFrame:
    """``(batch_no, n_rows, lines)``: one line per word pair. Pairs may come with the ``batch_no`` they are dealt by."""
    if "batch_no" not in pairs.columns:
        pairs = pairs.withColumn("batch_no", F.expr(f"pair_no div {int(size)}"))
    rows = pairs.withColumn("line", F.to_json(F.array("w1", "w2")))
    return joined_lines(rows, ["batch_no"], "pair_no", "line")


def leaf_requests(items: DataFrame, size: int = ITEMS_PER_BATCH, bytes_per_task: int = LINES_PER_TASK) -> DataFrame:
    """``(batch_no, n_rows, lines)``: one JSON object per item to place on a leaf; ranges and tasks are cut by their bytes."""
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    line = F.to_json(F.struct("id", text("title"), text("subtitle")))
    held = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in ("id", "title", "subtitle"))
    n, total = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(held.cast("long")), F.lit(0))).first()
    tasks = max(1, -(-total // bytes_per_task))
    rows = batch_rows(items.select("pos", "id", line.alias("line")), ["pos"], size, rows_per_bucket=min(ROWS_PER_BUCKET, max(size, n // tasks)))
    return joined_lines(rows.repartition(tasks, "batch_no") if tasks > 1 else rows, ["batch_no"], "slot", "line")


def choice_rows(choices: DataFrame, size: int = CHOICES_PER_ROW) -> DataFrame:
    """A choice table in rows like those of requests: ``(batch_no, n_rows, lines, choices_id)``."""
    return joined_lines(choices.withColumn("batch_no", F.expr(f"slot div {int(size)}")), ["batch_no", "choices_id"], "slot", "line")


def attribute_requests(
    manifest: DataFrame, top: DataFrame, leaf_rows: DataFrame, size: int = LEAVES_PER_BATCH, **kw
) -> DataFrame:
    """``(batch_no, n_rows, lines)``: leaves with their largest templates, in path order.

    A leaf without templates counts as low-structure, like one flagged so.
    """
    shapes = top.groupBy("leaf_path").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "rank",
                    F.format_string("template x%d: %s\nexample: %s", "item_count", "template", "representative").alias("l"),
                )
            )
        ).alias("t")
    )
    rows = (
        leaf_rows.select("leaf_path", "display_name")
        .join(manifest.select("leaf_path", "is_low_structure", "misc_item_count"), "leaf_path", "left")
        .join(shapes, "leaf_path", "left")
    )
    low = F.coalesce("is_low_structure", F.lit(True))
    line = F.concat_ws(
        "\n",
        F.concat(F.lit("category "), "leaf_path", F.lit(" ("), "display_name", F.lit(")"), F.when(low, " [low-structure]").otherwise("")),
        F.array_join(F.col("t.l"), "\n"),
        F.when(F.col("misc_item_count") > 0, F.format_string("other titles: %d", "misc_item_count")),
    )
    batched = batch_rows(rows.select("leaf_path", line.alias("line")), ["leaf_path"], size, **kw)
    return joined_lines(batched, ["batch_no"], "slot", "line")


def value_requests(items: DataFrame, attributes: DataFrame, size: int = VALUES_PER_BATCH, **kw) -> DataFrame:
    """``(leaf_path, batch_no, n_rows, schema_lines, lines)``: one leaf per batch."""
    schema_line = F.to_json(F.struct("key", "label", F.coalesce("unit", F.lit("")).alias("unit"), "value_type"))
    schema = attributes.groupBy("leaf_path").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("attr_seq", schema_line.alias("l"))))["l"], "\n").alias("schema_lines")
    )
    line = F.to_json(F.struct("item_id", "title"))
    rows = batch_rows(
        items.select("pos", "item_id", "leaf_path", line.alias("line")), ["pos"], size, within=["leaf_path"], **kw
    )
    return joined_lines(rows, ["leaf_path", "batch_no"], "slot", "line").join(
        broadcast_if_small(schema), "leaf_path"
    )


# ---------------------------------------------------------------- calling
def call_model(
    requests: DataFrame,
    prompt: Column,
    keys: list[str],
    fn: Callable[[str], str],
    parallelism: int = 10,
    tries: int = 3,
    backoff: float = 1.0,
) -> DataFrame:
    """``keys + (response, error)``; ``parallelism`` partitions bound concurrent calls.

    A request is retried with doubled waits; one that keeps failing becomes a row with ``error``.
    """
    rows = requests.select(*keys, prompt.alias("__prompt")).repartition(parallelism)
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys) + ", response string, error string"

    def ask(text: str) -> tuple[str | None, str | None]:
        for attempt in range(tries):
            try:
                return fn(text), None
            except Exception as exc:  # noqa: BLE001 - any model failure is recorded
                problem = f"{type(exc).__name__}: {exc}"
                if attempt + 1 < tries:
                    time.sleep(backoff * 2**attempt)
        return None, problem

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            answers = [ask(t) for t in pdf["__prompt"]]
            out = pdf[keys].copy()
            out["response"] = [a for a, _ in answers]
            out["error"] = [e for _, e in answers]
            yield out

    return rows.mapInPandas(run, schema)


# ---------------------------------------------------------------- responses
def _kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _text(v: Column, path: str) -> Column:
    """A field only when it is a JSON string."""
    return F.when(_kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def _number(v: Column, path: str) -> Column:
    """Numbers, numeric strings and booleans as double; else null."""
    return F.when(_kind(v, path) == "BOOLEAN", F.try_variant_get(v, path, "boolean").cast("double")).otherwise(
        tx.strip(F.try_variant_get(v, path, "string")).try_cast("double")
    )


def response_rows(responses: DataFrame, keys: list[str]) -> DataFrame:
    """One row per object of a JSON array answer, with ``at`` as its place; fences are tolerated."""
    parsed = responses.select(*keys, tx.json_or_fenced(F.col("response")).alias("doc"))
    return parsed.select(
        *keys, F.posexplode(F.try_variant_get("doc", "$", "array<variant>")).alias("at", "obj")
    ).filter(F.startswith(F.schema_of_variant("obj"), F.lit("OBJECT")))


def valid_pair_rules(
    responses: DataFrame, allowed: DataFrame, min_confidence: float = MIN_PAIR_CONFIDENCE, keys: list[str] = ["batch_no"]
) -> DataFrame:
    """Pair rules of well-formed answers: two strings, allowed category, confidence in range."""
    o = F.col("obj")
    words = F.try_variant_get(o, "$.bigram", "array<variant>")
    rows = response_rows(responses, keys).select(
        *keys, "at", F.size(words).alias("n_words"),
        _text(o, "$.bigram[0]").alias("w1"), _text(o, "$.bigram[1]").alias("w2"),
        _text(o, "$.suggested_parent_category_slug").alias("category_slug"), _number(o, "$.confidence").alias("c"),
    )
    return (
        rows.filter((F.col("n_words") == 2) & F.col("w1").isNotNull() & F.col("w2").isNotNull())
        .filter((F.col("c") >= min_confidence) & (F.col("c") <= 1.0))
        .join(broadcast_if_small(allowed.select(F.col("slug").alias("category_slug")).distinct()), "category_slug", "left_semi")
        .select(*keys, "at", "w1", "w2", "category_slug", F.round("c", 4).alias("confidence"), F.lit("openai_llm").alias("source"))
    )


def valid_leaf_answers(responses: DataFrame, leaf_rows: DataFrame, keys: list[str] = ["batch_no"]) -> DataFrame:
    """Leaf answers with a string id, a known leaf and a confidence between 0 and 1."""
    o = F.col("obj")
    rows = response_rows(responses, keys).select(
        *keys, "at", _text(o, "$.id").alias("id"), _text(o, "$.leaf_path").alias("leaf_path"),
        _number(o, "$.confidence").alias("confidence"),
    )
    return rows.filter(F.col("id").isNotNull() & F.col("confidence").between(0.0, 1.0)).join(
        broadcast_if_small(leaf_rows.select("leaf_path").distinct()), "leaf_path", "left_semi"
    )


def kept_leaves(answers: DataFrame, min_confidence: float = MIN_LEAF_CONFIDENCE) -> DataFrame:
    """Confident answers, the last one per id."""
    return (
        answers.filter(F.col("confidence") >= min_confidence)
        .groupBy("id")
        .agg(F.max_by(F.struct("leaf_path", "confidence"), F.struct("batch_no", "at")).alias("r"))
        .select("id", "r.*")
    )


def batch_report(sent: DataFrame, answers: DataFrame, min_confidence: float = MIN_LEAF_CONFIDENCE) -> DataFrame:
    """Per batch: sent, kept, low-confidence and missing ids. ``sent(batch_no, id)``."""
    got = answers.groupBy("batch_no").agg(
        F.count_if(F.col("confidence") >= min_confidence).alias("kept"),
        F.count_if(F.col("confidence") < min_confidence).alias("low_confidence"),
    )
    missing = sent.join(answers.select("batch_no", "id").distinct(), ["batch_no", "id"], "left_anti")
    absent = missing.groupBy("batch_no").agg(F.count_distinct("id").alias("missing"))
    return (
        sent.groupBy("batch_no").agg(F.count(F.lit(1)).alias("sent"))
        .join(got, "batch_no", "left").join(absent, "batch_no", "left").fillna(0)
    )


def merge_model_matches(pool: DataFrame, kept: DataFrame, matched_ids: DataFrame) -> DataFrame:
    """Match rows for kept answers of pool items that no other source matched."""
    return (
        pool.join(matched_ids.select("id").distinct(), "id", "left_anti")
        .join(kept, "id")
        .select(
            "pos", "id", "leaf_path", tx.leaf_slug(F.col("leaf_path")).alias("leaf_slug"),
            F.lit("").alias("leaf_display_name"), "confidence", F.lit(tx.SOURCE_MODEL).alias("source"),
        )
    )


def still_unmatched(pool: DataFrame, decided_ids: DataFrame, kept: DataFrame) -> DataFrame:
    gone = decided_ids.select("id").unionByName(kept.select("id")).distinct()
    return pool.filter("id IS NOT NULL AND id <> ''").join(gone, "id", "left_anti")


PATTERN_TYPE = "template: string, regex: string, value_normalize: string"
UNIT_TYPE = "symbol: string, name: string, description: string, value_type: string"
ATTRIBUTE_TYPE = (
    "struct<key: string, label: string, description: string, value_type: string, unit_required: string, "
    f"unit: struct<{UNIT_TYPE}>, patterns: array<struct<{PATTERN_TYPE}>>>"
)
SCHEMA_ANSWER = f"categories array<struct<path: string, attributes: array<{ATTRIBUTE_TYPE}>>>"


def attribute_schema(responses: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(units, attributes, patterns)`` of attribute answers ``(batch_no, response)``.

    The first definition of a unit counts and the last non-empty definition of a leaf.
    """
    cats = (
        responses.select("batch_no", F.from_json("response", SCHEMA_ANSWER).alias("d"))
        .select("batch_no", F.posexplode("d.categories").alias("cat_at", "c"))
        .filter((F.coalesce("c.path", F.lit("")) != "") & (F.size("c.attributes") > 0))
    )
    order = F.struct("batch_no", "cat_at")
    flat = cats.select(
        "batch_no", "cat_at", F.col("c.path").alias("leaf_path"), F.posexplode("c.attributes").alias("attr_seq", "a")
    ).withColumn("symbol", F.nullif(tx.strip(F.col("a.unit.symbol")), F.lit("")))
    units = (
        flat.filter("symbol IS NOT NULL")
        .groupBy("symbol")
        .agg(F.min_by("a.unit", F.struct("batch_no", "cat_at", "attr_seq")).alias("u"))
        .select(
            "symbol", F.coalesce("u.name", "symbol").alias("name"), F.coalesce("u.description", F.lit("")).alias("description"),
            F.coalesce("u.value_type", F.lit("number")).alias("value_type"),
        )
    )
    last = cats.groupBy(F.col("c.path").alias("leaf_path")).agg(F.max(order).alias("o")).select("leaf_path", "o.*")
    current = flat.join(last, ["leaf_path", "batch_no", "cat_at"], "left_semi")
    blank = lambda c: F.coalesce(c, F.lit(""))
    attributes = current.select(
        "leaf_path", "attr_seq", blank("a.key").alias("key"), blank("a.label").alias("label"),
        blank("a.description").alias("description"), F.coalesce("a.value_type", F.lit("text")).alias("value_type"),
        # any answer but an empty, false or zero one counts as true
        (~F.lower(F.trim(F.coalesce("a.unit_required", F.lit("")))).isin("", "false", "0", "null", "[]", "{}")).alias("unit_required"),
        F.col("symbol").alias("unit"),
    )
    patterns = current.select("leaf_path", blank("a.key").alias("key"), F.posexplode("a.patterns").alias("seq", "p")).select(
        "leaf_path", "key", "seq", blank("p.template").alias("template"), blank("p.regex").alias("regex"),
        F.coalesce("p.value_normalize", F.lit("text_raw")).alias("value_normalize"),
    )
    return units, attributes, patterns


def schema_coverage(attributes: DataFrame, patterns: DataFrame, units: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row: leaves with attributes, leaves with a pattern, low-structure leaves, units."""
    return side_by_side(
        attributes.agg(F.count_distinct("leaf_path").alias("leaves_with_attributes")),
        patterns.agg(F.count_distinct("leaf_path").alias("leaves_with_patterns")),
        manifest.agg(F.count_if("is_low_structure").alias("low_structure_leaves")),
        units.agg(F.count(F.lit(1)).alias("units")),
    )


def value_answers(responses: DataFrame) -> DataFrame:
    """Attribute values of fallback answers ``(leaf_path, batch_no, response)`` with their label.

    Booleans and nulls are no values; an empty value or the confidence ``none`` gives ``llm_none``.
    """
    o = F.col("obj")
    results = responses.select(
        "leaf_path", F.explode(F.try_variant_get(F.try_parse_json("response"), "$.results", "array<variant>")).alias("r")
    )
    flat = results.select(
        "leaf_path", F.try_variant_get("r", "$.item_id", "string").alias("item_id"),
        F.explode(F.try_variant_get("r", "$.attributes", "array<variant>")).alias("obj"),
    )
    is_bool = lambda p: _kind(o, p) == "BOOLEAN"
    conf = F.when(is_bool("$.confidence"), "none").otherwise(F.coalesce(F.try_variant_get(o, "$.confidence", "string"), F.lit("none")))
    value = F.when(is_bool("$.value"), "").otherwise(F.coalesce(F.try_variant_get(o, "$.value", "string"), F.lit("")))
    return (
        flat.withColumn("conf", F.lower(tx.strip(conf)))
        .withColumn("value", tx.strip(value))
        .withColumn("attribute_key", F.coalesce(F.try_variant_get(o, "$.attribute_key", "string"), F.lit("")))
        .withColumn("unit", F.try_variant_get(o, "$.unit", "string"))
        .withColumn(
            "extraction_confidence",
            F.when((F.col("value") == "") | (F.col("conf") == "none"), "llm_none")
            .when(F.startswith("conf", F.lit("llm_")), F.col("conf"))
            .otherwise(F.concat(F.lit("llm_"), "conf")),
        )
        .withColumn("item_id", F.coalesce("item_id", F.lit("")))
        .select(*VALUE_COLUMNS)
    )
