"""Attribute values from titles by the patterns of a title's template."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import text as tx
from shelfwise.scale import broadcast_if_small, cut_lineage, is_small, side_by_side, skew_join, spread

# Labels whose rows are published; every other label is rejected.
ACCEPTED = ("regex", "llm_high", "llm_medium")
VALUE_COLUMNS = ["item_id", "leaf_path", "attribute_key", "value", "unit", "extraction_confidence"]


def _compiled(regex: str | None) -> re.Pattern | None:
    """The standard library keeps compiled patterns; a broken one gives None."""
    try:
        return re.compile(regex or "")
    except re.error:
        return None


def _capture(regex: str | None, title: str | None) -> str | None:
    pattern = _compiled(regex)
    if pattern is None or "val" not in pattern.groupindex or title is None:
        return None
    found = pattern.search(title)
    return found.group("val") if found else None


def capture_all(title: Column, regexes: Column) -> Column:
    """The named capture of each pattern in a title, null where it does not match."""
    return F.pandas_udf(_capture_all, T.ArrayType(T.StringType()))(title, regexes)


def _capture_all(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for titles, regexes in batches:
        yield pd.Series([[_capture(r, t) for r in rs] for t, rs in zip(titles, regexes)])


def pattern_passes(regex: Column, representative: Column) -> Column:
    """Compiles, has the named group, and finds a non-blank value in the representative, if any."""
    return F.pandas_udf(_passes, T.BooleanType())(regex, representative)


def _passes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for regexes, titles in batches:
        out = []
        for regex, title in zip(regexes, titles):
            pattern = _compiled(regex)
            ok = pattern is not None and "val" in pattern.groupindex
            if ok and title:
                value = _capture(regex, title)
                ok = value is not None and value.strip() != ""
            out.append(ok)
        yield pd.Series(out)


def smoke_test(patterns: DataFrame, clusters: DataFrame) -> DataFrame:
    """Keep patterns that work on the representative title of their template."""
    reps = clusters.select("leaf_path", "template", "representative")
    return (
        patterns.join(reps, ["leaf_path", "template"], "left")
        .filter(pattern_passes(F.coalesce("regex", F.lit("")), F.coalesce("representative", F.lit(""))))
        .select(*patterns.columns)
    )


def extract_values(rows: DataFrame, attributes: DataFrame, patterns: DataFrame, clusters: DataFrame) -> DataFrame:
    """Every item of a leaf with attributes, with ``values``: first plausible value per attribute.

    ``rows`` carries ``template``. Patterns are packed per (leaf, template), so an item stays one
    row through the join and the regex pass, and no regrouping is needed. Items without a
    value have an empty array and go to the fallback.
    """
    with_attr = attributes.select("leaf_path").distinct()
    unit = attributes.select("leaf_path", "key", F.col("unit").alias("a_unit"), F.col("attr_seq").alias("a_seq"))
    packed = (
        patterns.join(clusters.select("leaf_path", "template"), ["leaf_path", "template"], "left_semi")
        .join(unit, ["leaf_path", "key"])
        .groupBy("leaf_path", "template")
        .agg(F.array_sort(F.collect_list(F.struct("a_seq", "seq", "key", "regex", "value_normalize", "a_unit"))).alias("pats"))
    )
    open_rows = rows.join(broadcast_if_small(with_attr), "leaf_path", "left_semi").select("pos", "id", "leaf_path", "title", "template")
    # items of the leaves with attributes may all lie in one file; their titles are dealt out for the regex pass
    open_rows = spread(open_rows, "pos")
    packed = cut_lineage(packed)
    key = ["leaf_path", "template"]
    if is_small(packed):
        routed = open_rows.join(F.broadcast(packed), key, "left")
    else:
        routed = skew_join(open_rows, packed, key, clusters, "item_count", "left")
    none = F.array().cast("array<string>")
    got = routed.withColumn("raw", F.when(F.col("pats").isNotNull(), capture_all("title", F.coalesce(F.col("pats.regex"), none))))
    cleaned = F.filter(
        F.transform(
            F.arrays_zip("pats", "raw"),
            lambda z: F.struct(
                z["pats"]["key"].alias("attribute_key"),
                tx.normalize_value(z["raw"], F.coalesce(z["pats"]["value_normalize"], F.lit("text_raw"))).alias("value"),
                z["pats"]["a_unit"].alias("unit"),
            ),
        ),
        lambda v: v["value"].isNotNull(),
    )
    keys = F.col("found.attribute_key")
    first = F.filter("found", lambda v, i: F.array_position(keys, v["attribute_key"]) == i + 1)
    return (
        got.withColumn("found", F.coalesce(cleaned, F.array()))
        .withColumn("values", first)
        .select("pos", F.col("id").alias("item_id"), "leaf_path", "title", "values")
    )


def regex_values(extracted: DataFrame) -> DataFrame:
    return extracted.select("item_id", "leaf_path", F.inline("values")).withColumn(
        "extraction_confidence", F.lit("regex")
    ).select(*VALUE_COLUMNS)


def fallback_items(extracted: DataFrame) -> DataFrame:
    """Items without any regex value."""
    return extracted.filter(F.size("values") == 0).select("pos", "item_id", "leaf_path", "title")


def is_accepted(label):
    return F.coalesce(label.isin(*ACCEPTED), F.lit(False))


def extraction_stats(matched_total: DataFrame, extracted: DataFrame, model_values: DataFrame) -> DataFrame:
    """One row of item and value counts per route and label. ``matched_total`` has ``total_items``."""
    routed = extracted.agg(
        F.count_if(F.size("values") > 0).alias("regex_matched_items"),
        F.count_if(F.size("values") == 0).alias("llm_fallback_items"),
        F.coalesce(F.sum(F.size("values")), F.lit(0)).cast("long").alias("regex_value_rows"),
    )
    label = F.col("extraction_confidence")
    model = model_values.agg(
        F.count_if(is_accepted(label)).alias("llm_accepted_rows"),
        F.count_if(~is_accepted(label)).alias("llm_rejected_rows"),
        *[F.count_if(label == l).alias(l) for l in ("llm_high", "llm_medium", "llm_low", "llm_none")],
    )
    return (
        side_by_side(matched_total, routed, model)
        .withColumn("total_value_rows", F.col("regex_value_rows") + F.col("llm_accepted_rows"))
    )
