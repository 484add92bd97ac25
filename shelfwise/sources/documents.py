"""Readers for catalog, result, rule, keyword, schema and tree documents.

A document may be a bare JSON array or an object that wraps the array; it is one file and one task. Catalogs that
are too large for that are read from JSON lines or parquet. Broken files raise, elements that are no objects are
dropped one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.operators import taxonomy
from shelfwise.scale import cut_lineage, number_rows

ITEM = "id string, item_id string, title string, subtitle string"
MATCH = ITEM + ", leaf_path string, leaf_slug string, leaf_display_name string, method string, source string"
PAIR = "bigram array<string>, suggested_parent_category_slug string, confidence double, source string"


def valid_items(raw: DataFrame) -> DataFrame:
    """Rows with a non-empty ``id`` (else ``item_id``); missing texts become empty."""
    key = F.coalesce(F.nullif("id", F.lit("")), F.nullif("item_id", F.lit("")))
    return raw.select(
        key.alias("id"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("subtitle", F.lit("")).alias("subtitle"), "pos"
    ).filter(F.col("id").isNotNull())


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _fields(elements: DataFrame, keep: Sequence[str], row: str) -> DataFrame:
    """Fields of the objects in the VARIANT column ``v``; other elements are dropped one by one.

    An identifier counts only if it is a JSON string; other fields are read as text.
    """
    names = [f.strip().split(" ")[0] for f in row.split(", ")]
    objects = elements.filter(F.startswith(_kind(F.col("v")), F.lit("OBJECT")))
    out = []
    for name in names:
        text = F.try_variant_get("v", f"$.{name}", "string")
        if name in ("id", "item_id"):
            text = F.when(_kind(F.try_variant_get("v", f"$.{name}", "variant")) == "STRING", text)
        out.append(text.alias(name))
    return objects.select(*keep, *out)


def _elements(spark: SparkSession, path: str | Sequence[str], wrappers: Sequence[str]) -> DataFrame:
    """(file, at, v): array elements in file order; the first wrapper field that is an array wins, a bare object is
    one element. A file that is not whole JSON raises."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("__f"), F.parse_json("value").alias("doc"))
    array = lambda p: F.try_variant_get("doc", p, "array<variant>")
    single = F.when(F.startswith(_kind(F.col("doc")), F.lit("OBJECT")), F.array("doc"))
    found = F.coalesce(array("$"), *[array(f"$.{w}") for w in wrappers], single)
    return text.select("__f", F.posexplode(found).alias("__i", "v"))


def read_rows(spark: SparkSession, path, row: str, wrappers: Sequence[str] = ("matched_items", "items")) -> DataFrame:
    """Rows of a result document with ``pos`` fixed once, by file and place in the file."""
    rows = cut_lineage(_fields(_elements(spark, path, wrappers), ["__f", "__i"], row))
    return number_rows(rows, ["__f", "__i"], "pos", start=0).drop("__f", "__i")


def read_item_lines(spark: SparkSession, path) -> DataFrame:
    """Item catalog with one JSON object per line: files are split, so a catalog of any size is read in parallel.

    Lines that are no JSON raise, lines that are no object are dropped.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    placed = lines.select(F.col("_metadata.file_path").alias("__f"), F.monotonically_increasing_id().alias("__i"), F.parse_json("value").alias("v"))
    rows = cut_lineage(_fields(placed, ["__f", "__i"], ITEM))
    return valid_items(number_rows(rows, ["__f", "__i"], "pos", start=0).drop("__f", "__i"))


def read_item_table(spark: SparkSession, path) -> DataFrame:
    """Item catalog from parquet; absent columns are null, only the item's columns are read."""
    table = spark.read.parquet(path)
    names = [f.split(" ")[0] for f in ITEM.split(", ")]
    columns = [F.col(n).cast("string").alias(n) if n in table.columns else F.lit(None).cast("string").alias(n) for n in names]
    rows = cut_lineage(table.select(F.col("_metadata.file_path").alias("__f"), F.monotonically_increasing_id().alias("__i"), *columns))
    return valid_items(number_rows(rows, ["__f", "__i"], "pos", start=0).drop("__f", "__i"))


def read_items(spark: SparkSession, path, wrappers: Sequence[str] = ("items", "unmatched_items")) -> DataFrame:
    """Item catalog: ``id, title, subtitle, pos``."""
    return valid_items(read_rows(spark, path, ITEM, wrappers))


def read_matches(spark: SparkSession, path) -> DataFrame:
    return read_rows(spark, path, MATCH)


def two_sides(docs: DataFrame, title: str, subtitle: str, keep: Sequence[str] = ()) -> DataFrame:
    """Two arrays of a document as one table with ``side`` and ``seq``."""
    sides = [
        docs.select(*keep, F.lit(side).alias("side"), F.posexplode(c).alias("seq", "r")).select(*keep, "side", F.col("seq").cast("long"), "r.*")
        for side, c in (("title", title), ("subtitle", subtitle))
    ]
    return sides[0].unionByName(sides[1])


def read_keywords(spark: SparkSession, path) -> DataFrame:
    word = "array<struct<word: string, item_count: bigint>>"
    docs = spark.read.schema(f"title {word}, subtitle {word}").option("multiLine", True).option("mode", "FAILFAST").json(path)
    return two_sides(docs, "title", "subtitle").select("side", "word", "item_count", (F.col("seq") + 1).alias("rank"))


def read_rules(spark: SparkSession, path) -> DataFrame:
    rule = "array<struct<" + ", ".join(p.replace(" ", ": ", 1) for p in PAIR.split(", ")) + ">>"
    schema = f"taxonomy_depth int, title_bigrams {rule}, subtitle_bigrams {rule}"
    docs = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    docs = docs.withColumn("__f", F.col("_metadata.file_path"))
    # files by name; a file's number goes before the place in it, so "last wins" is the same in every run
    names = docs.select("__f").distinct()
    numbers = names.withColumn("file_no", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("__f")) - 1)
    flat = two_sides(docs, "title_bigrams", "subtitle_bigrams", ["taxonomy_depth", "__f"])
    flat = flat.join(F.broadcast(numbers), "__f").withColumn("seq", F.col("seq") + F.col("file_no") * (1 << 32))
    return flat.select(
        F.col("taxonomy_depth").alias("depth"), "file_no", "side", F.get("bigram", F.lit(0)).alias("w1"), F.get("bigram", F.lit(1)).alias("w2"),
        F.col("suggested_parent_category_slug").alias("category_slug"), "confidence", "source", "seq",
    )


def schema_tables(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(units, attributes, patterns)`` of attribute documents with ``units`` and ``_category_attributes``."""
    units = docs.select(F.explode("units").alias("symbol", "u")).select("symbol", "u.name", "u.description", "u.value_type")
    flat = docs.select(F.explode("_category_attributes").alias("leaf_path", "attrs")).select(
        "leaf_path", F.posexplode("attrs").alias("attr_seq", "a")
    )
    attributes = flat.select(
        "leaf_path", "attr_seq", "a.key", "a.label", "a.description", "a.value_type", "a.unit_required", "a.unit"
    )
    patterns = flat.select("leaf_path", F.col("a.key").alias("key"), F.posexplode("a.patterns").alias("seq", "p")).select(
        "leaf_path", "key", "seq", "p.*"
    )
    return units, attributes, patterns


SCHEMA_DOC = (
    "units map<string, struct<symbol: string, name: string, description: string, value_type: string>>, "
    "_category_attributes map<string, array<struct<key: string, label: string, description: string, value_type: string, "
    "unit_required: boolean, unit: string, patterns: array<struct<template: string, regex: string, value_normalize: string>>>>>"
)


def read_attribute_schema(spark: SparkSession, path) -> tuple[DataFrame, DataFrame, DataFrame]:
    return schema_tables(spark.read.schema(SCHEMA_DOC).option("multiLine", True).option("mode", "FAILFAST").json(path))


# Keys of the three root categories, in their order.
ROOT_KEYS = ("materials", "tools_and_gear", "services")


def tree_rows(docs: DataFrame, roots: Sequence[str] = ROOT_KEYS) -> DataFrame:
    """Adjacency rows of a nested category document in the column ``value``.

    The nesting has no fixed depth, so it is unfolded level by level as VARIANT.
    """
    doc = docs.select(F.parse_json("value").alias("doc"))
    level = doc.select(F.posexplode(F.array(*[F.struct(F.lit(r).alias("slug"), F.try_variant_get("doc", f"$.{r}", "variant").alias("v")) for r in roots])).alias("i", "n")).select(
        F.col("n.slug").alias("node_key"), F.lit(None).cast("string").alias("parent_key"), F.col("n.slug").alias("slug"), "i", F.col("n.v").alias("v")
    ).filter(F.col("v").isNotNull() & F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    out = None
    while True:
        level = cut_lineage(
            level.withColumn("display_name", F.try_variant_get("v", "$.display_name", "string"))
            .withColumn("kids", F.try_variant_get("v", "$.subcategories", "array<variant>"))
            .withColumn("kids", F.transform("kids", lambda k: F.to_json(k)))
            .drop("v")
        )
        if level.isEmpty():
            break
        rows = level.select("node_key", "parent_key", "slug", "display_name", F.lpad(F.col("i").cast("string"), 9, "0").alias("sib"))
        out = rows if out is None else out.unionByName(rows)
        level = level.select(F.col("node_key").alias("parent_key"), F.posexplode("kids").alias("i", "k")).select(
            "parent_key", "i", F.parse_json("k").alias("v")
        ).withColumn("slug", F.try_variant_get("v", "$.slug", "string")).withColumn(
            "node_key", F.concat_ws("/", "parent_key", F.col("i").cast("string"))
        )
    return out


def read_tree(spark: SparkSession, path) -> DataFrame:
    """Flat node table of a category document."""
    return taxonomy.flatten_tree(tree_rows(spark.read.text(path, wholetext=True)))
