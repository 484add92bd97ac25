"""Validation of the result and publishing against marketplace tables.

Targets are DataFrames (JDBC or parquet); each function returns the rows to append. Inserts skip
existing keys, rows that cannot be resolved are returned as rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import text as tx
from shelfwise.operators import taxonomy
from shelfwise.scale import broadcast_if_small, cut_lineage, is_small, side_by_side, skew_join

LIVE = "deleted_at IS NULL"


# ---------------------------------------------------------------- validation
def validate(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(pos, id, issue)``: missing id or path, repeated id, unknown path, path with children.

    A repeated id is found from the first position per id (an aggregate, so a hot id is safe);
    only ids that repeat are joined back.
    """
    clean = rows.select(
        "pos", F.coalesce("id", F.lit("")).alias("id"), tx.strip(F.coalesce("leaf_path", F.lit(""))).alias("leaf_path")
    )
    filled = clean.filter("id <> '' AND leaf_path <> ''")
    repeats = cut_lineage(
        filled.groupBy("id").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    known = nodes.groupBy(F.col("path").alias("leaf_path")).agg(F.max("is_leaf").alias("is_leaf"))
    placed = clean.join(broadcast_if_small(known), "leaf_path", "left")
    first = repeats.select("id", "first_pos")
    if is_small(first):
        checked = placed.join(F.broadcast(first), "id", "left")
    else:
        checked = skew_join(placed, first, ["id"], repeats, "n", "left")
    full = (F.col("id") != "") & (F.col("leaf_path") != "")
    issues = F.array(
        F.when(F.col("id") == "", "missing id"),
        F.when((F.col("id") != "") & (F.col("leaf_path") == ""), "missing leaf_path"),
        F.when(full & (F.col("pos") > F.col("first_pos")), "duplicate id"),
        F.when(full & F.col("is_leaf").isNull(), "leaf_path not in taxonomy"),
        F.when(full & ~F.col("is_leaf"), "leaf_path is not a leaf"),
    )
    return checked.select("pos", "id", F.explode(F.array_compact(issues)).alias("issue"))


def require_valid(rows: DataFrame, nodes: DataFrame, allow_issues: bool = False) -> DataFrame:
    """Gate before publishing: raise on any issue unless overridden."""
    issues = validate(rows, nodes)
    if not allow_issues and not issues.isEmpty():
        raise ValueError("result has validation issues: " + "; ".join(f"{r['id']}: {r['issue']}" for r in issues.take(20)))
    return rows


# ---------------------------------------------------------------- helpers
def new_id(kind: str, *parts: Column) -> Column:
    """Surrogate key from content, the same on every retry."""
    return F.concat(F.lit(kind + "_"), F.left(F.sha2(F.concat_ws("\u0001", *parts), 256), F.lit(16)))


def insert_absent(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the target, one per key."""
    return rows.join(target.select(*keys), keys, "left_anti").dropDuplicates(keys)


def append_jdbc(rows: DataFrame, url: str, table: str, properties: dict | None = None, batch: int = 1000) -> None:
    rows.write.mode("append").option("batchsize", batch).jdbc(url, table, properties=properties or {})


# ---------------------------------------------------------------- categories
def existing_paths(categories: DataFrame) -> DataFrame:
    """``(path, id)`` of stored categories, from their parent links."""
    tree = categories.filter(LIVE).select(
        F.col("id").alias("node_key"), F.col("parent_id").alias("parent_key"), "slug", F.col("name").alias("display_name"),
        F.col("slug").alias("sib"),
    )
    return taxonomy.flatten_tree(tree, keep_key=True).groupBy("path").agg(F.min("node_key").alias("id"))


def publish_categories(nodes: DataFrame, categories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(path -> id map of all nodes, rows to insert)``; a node exists when its slug exists below
    its existing parent, null-safe for roots."""
    stored = existing_paths(categories)
    mapped = nodes.select("path", "slug", "display_name", "parent_path", "depth").join(stored, "path", "left")
    ids = mapped.select("path", F.coalesce("id", new_id("cat", F.col("path"))).alias("id"))
    fresh = mapped.filter("id IS NULL").drop("id").join(ids, "path")
    parent = ids.select(F.col("path").alias("parent_path"), F.col("id").alias("parent_id"))
    rows = fresh.join(parent, "parent_path", "left").select("id", F.col("display_name").alias("name"), "slug", "parent_id", "depth")
    return ids, rows


def publish_links(
    matched: DataFrame, path_ids: DataFrame, items: DataFrame, links: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``(links to insert, rows with an unknown path)``; items must exist and be live."""
    alive = matched.join(items.filter(LIVE).select("id"), "id", "left_semi")
    placed = alive.select(F.col("id").alias("item_id"), F.col("leaf_path").alias("path")).join(
        broadcast_if_small(path_ids.withColumnRenamed("id", "category_id")), "path", "left"
    )
    rejects = placed.filter("category_id IS NULL").select("item_id", F.col("path").alias("leaf_path"))
    rows = placed.filter("category_id IS NOT NULL").select("item_id", "category_id")
    return insert_absent(rows, links, ["item_id", "category_id"]), rejects


# ---------------------------------------------------------------- attributes
def publish_units(units: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(symbol -> id map, units to insert)``."""
    fresh = insert_absent(units, target, ["symbol"]).withColumn("id", new_id("unit", F.col("symbol")))
    ids = target.select("symbol", "id").unionByName(fresh.select("symbol", "id"))
    return ids, fresh.select("id", "symbol", "name", "description", "value_type")


def category_of_leaf(leaf_paths: DataFrame, categories: DataFrame) -> DataFrame:
    """Category id by leaf slug; where a slug is stored twice the last row wins. Null = not found."""
    by_slug = categories.filter(LIVE).groupBy(F.col("slug").alias("leaf_slug")).agg(F.max("id").alias("category_id"))
    return leaf_paths.select("leaf_path").distinct().withColumn("leaf_slug", tx.leaf_slug(F.col("leaf_path"))).join(
        broadcast_if_small(by_slug), "leaf_slug", "left"
    )


def publish_attributes(
    attributes: DataFrame, unit_ids: DataFrame, categories: DataFrame, target: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``((leaf, key) -> attribute id, attributes to insert, leaves without category)``."""
    cats = category_of_leaf(attributes, categories)
    placed = attributes.join(cats.filter("category_id IS NOT NULL").select("leaf_path", "category_id"), "leaf_path").join(
        broadcast_if_small(unit_ids.select(F.col("symbol").alias("unit"), F.col("id").alias("unit_id"))), "unit", "left"
    )
    first = placed.groupBy("category_id", "key").agg(
        F.min_by(F.struct("label", "description", "value_type", "unit_id"), F.struct("leaf_path", "attr_seq")).alias("r")
    ).select("category_id", "key", "r.*")
    fresh = insert_absent(first, target, ["category_id", "key"]).withColumn(
        "id", new_id("attr", F.col("category_id"), F.col("key"))
    )
    all_ids = target.select("category_id", "key", F.col("id").alias("attribute_id")).unionByName(
        fresh.select("category_id", "key", F.col("id").alias("attribute_id"))
    )
    ids = placed.select("leaf_path", "category_id", "key").distinct().join(all_ids, ["category_id", "key"]).select(
        "leaf_path", "key", "attribute_id"
    )
    rows = fresh.select("id", "category_id", "key", "label", "description", "value_type", "unit_id")
    return ids, rows, cats.filter("category_id IS NULL").select("leaf_path")


def resolve_values(values: DataFrame, attribute_ids: DataFrame, unit_ids: DataFrame) -> DataFrame:
    """Values with attribute and unit ids; ``ok`` is false where item, attribute or value is missing."""
    return (
        values.withColumnRenamed("attribute_key", "key")
        .join(broadcast_if_small(attribute_ids), ["leaf_path", "key"], "left")
        .join(
            broadcast_if_small(unit_ids.select(F.col("symbol").alias("unit"), F.col("id").alias("attribute_unit_id"))),
            "unit",
            "left",
        )
        .withColumn(
            "ok",
            F.col("attribute_id").isNotNull()
            & (F.coalesce("item_id", F.lit("")) != "")
            & (F.coalesce("value", F.lit("")) != ""),
        )
        .select("item_id", "attribute_id", "attribute_unit_id", "value", "ok")
    )


def skipped_values(resolved: DataFrame) -> DataFrame:
    """Rows that cannot be published, with the first reason."""
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    why = F.when(F.col("attribute_id").isNull(), "attribute").when(empty("item_id"), "item").when(empty("value"), "value")
    return resolved.filter(~F.col("ok")).select("item_id", "attribute_id", "value", why.alias("missing"))


def publish_values(resolved: DataFrame, target: DataFrame) -> DataFrame:
    return insert_absent(resolved.filter("ok").drop("ok"), target, ["item_id", "attribute_id", "value"])


def dry_run(**plans: DataFrame) -> DataFrame:
    """Rows each sink would receive."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("sink"), "n_rows") for k, df in plans.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


# ---------------------------------------------------------------- pull and gaps
def live(table: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Snapshot of a table without soft-deleted rows, in key order."""
    return table.filter(LIVE).select(*columns).orderBy(*order)


def items_with_store(items: DataFrame, store_items: DataFrame, stores: DataFrame) -> DataFrame:
    """Live items that some store carries, with the first store name (nulls last).

    The name is reduced per item before the item join, so only one row per item moves on.
    """
    named = store_items.join(broadcast_if_small(stores.select(F.col("id").alias("store_id"), "name")), "store_id")
    first = named.groupBy("items_id").agg(F.min("name").alias("store_name"))
    return items.filter(LIVE).join(first, items["id"] == first["items_id"]).select(
        "id", "title", "subtitle", "store_name"
    )


def gap_counts(items: DataFrame, links: DataFrame, values: DataFrame) -> DataFrame:
    """One row: live items, items without category, categorized items without values."""
    alive, linked = items.filter(LIVE), links.filter(LIVE)
    uncategorized = alive.join(linked.select(F.col("item_id").alias("id")), "id", "left_anti")
    bare = linked.join(values.filter(LIVE).select("item_id"), "item_id", "left_anti")
    return side_by_side(
        alive.agg(F.count(F.lit(1)).alias("total")),
        uncategorized.agg(F.count(F.lit(1)).alias("uncategorized")),
        bare.agg(F.count_distinct("item_id").alias("missing_attrs")),
    )


def taxonomy_gaps(nodes: DataFrame, categories: DataFrame) -> DataFrame:
    """Local slugs that the target does not have."""
    return nodes.select("slug").subtract(categories.filter(LIVE).select("slug"))
