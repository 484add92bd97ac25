"""Category tree as a flat node table.

``path, slug, display_name, parent_path, depth, ord, is_leaf, is_catch_all``; ``ord`` sorts nodes
depth-first, parents before children.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import text as tx
from shelfwise.scale import cut_lineage

SEP = "\u0001"


def flatten_tree(tree: DataFrame, keep_key: bool = False) -> DataFrame:
    """Flatten ``tree(node_key, parent_key, slug, display_name, sib)`` level by level.

    Nodes without a slug are left out together with everything below them.
    """
    tree = cut_lineage(tree.filter(F.col("slug").isNotNull() & (F.col("slug") != "")))
    shown = F.coalesce(F.nullif("display_name", F.lit("")), F.col("slug"))
    level = tree.filter(F.col("parent_key").isNull()).select(
        "node_key",
        F.col("slug").alias("path"),
        "slug",
        shown.alias("display_name"),
        F.lit(None).cast("string").alias("parent_path"),
        F.lit(0).alias("depth"),
        F.col("sib").alias("ord"),
    )
    children = tree.filter(F.col("parent_key").isNotNull()).select(
        F.col("node_key").alias("child_key"), F.col("parent_key").alias("node_key"),
        F.col("slug").alias("child_slug"), shown.alias("child_name"), "sib",
    )
    level = cut_lineage(level)
    levels = [level]
    n_nodes = tree.count()
    depth = 0
    while True:
        depth += 1
        if depth > n_nodes:  # a path longer than the number of nodes repeats a node
            raise ValueError("the tree is cyclic")
        level = cut_lineage(
            children.join(level.select("node_key", "path", "ord"), "node_key").select(
                F.col("child_key").alias("node_key"),
                F.concat_ws("/", "path", "child_slug").alias("path"),
                F.col("child_slug").alias("slug"),
                F.col("child_name").alias("display_name"),
                F.col("path").alias("parent_path"),
                F.lit(depth).alias("depth"),
                F.concat_ws(SEP, "ord", "sib").alias("ord"),
            )
        )
        if level.isEmpty():
            break
        levels.append(level)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out if keep_key else with_flags(out.drop("node_key"))


def with_flags(nodes: DataFrame) -> DataFrame:
    """Add ``is_leaf`` and ``is_catch_all``."""
    parents = nodes.select(F.col("parent_path").alias("path")).filter(F.col("path").isNotNull()).distinct()
    return (
        nodes.join(parents.withColumn("has_child", F.lit(True)), "path", "left")
        .withColumn("is_leaf", F.col("has_child").isNull())
        .withColumn("is_catch_all", tx.is_catch_all(F.col("slug")))
        .select("path", "slug", "display_name", "parent_path", "depth", "ord", "is_leaf", "is_catch_all")
    )


def leaves(nodes: DataFrame, with_catch_all: bool = True, with_bare_roots: bool = False) -> DataFrame:
    """Leaf rows; roots without children count only on request (validation does)."""
    out = nodes.filter("is_leaf")
    if not with_bare_roots:
        out = out.filter("depth > 0")
    if not with_catch_all:
        out = out.filter("NOT is_catch_all")
    return out.select(F.col("path").alias("leaf_path"), F.col("slug").alias("leaf_slug"), "display_name", "ord")


def catch_all_leaves(nodes: DataFrame) -> DataFrame:
    return leaves(nodes.filter("is_catch_all")).drop("ord")


def nodes_at_depth(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.filter(F.col("depth") == depth)


def top_level_list(nodes: DataFrame) -> DataFrame:
    """First-level categories offered for pair rules, with their root."""
    return nodes_at_depth(nodes, 1).filter("NOT is_catch_all").select(
        "slug", "display_name", tx.master_slug(F.col("path")).alias("root"), "ord"
    )


def depth_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("depth").agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.count_if("is_leaf").alias("n_leaves"),
        F.count_if("is_catch_all").alias("n_catch_all"),
    )


def max_depth(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.max("depth").alias("max_depth"))


def slug_paths(nodes: DataFrame) -> DataFrame:
    """First path (depth-first) of every slug that takes part in automatic matching."""
    return nodes.filter("NOT is_catch_all").groupBy("slug").agg(F.min_by("path", "ord").alias("path"))


def slug_duplicates(nodes: DataFrame) -> DataFrame:
    return (
        nodes.filter("NOT is_catch_all")
        .groupBy("slug")
        .agg(F.min_by("path", "ord").alias("kept_path"), F.count_distinct("path").alias("n_paths"))
        .filter("n_paths > 1")
    )


def anchor_tokens(nodes: DataFrame, depths: list[int] | None = None) -> DataFrame:
    """Distinct ``(depth, anchor, token)``: words of an anchor node and of everything below it.

    A root's own slug is a document key and gives no words. When a slug occurs twice at a depth
    the later node is used.
    """
    words = F.when(F.col("depth") == 0, tx.taxonomy_tokens(F.col("display_name"))).otherwise(
        F.concat(tx.taxonomy_tokens(F.col("slug")), tx.taxonomy_tokens(F.col("display_name")))
    )
    up = F.concat(tx.ancestors(F.col("path")), F.array("path"))
    spread = nodes.select(words.alias("words"), F.posexplode(up).alias("a_depth", "a_path"))
    anchors = nodes.filter("NOT is_catch_all")
    if depths is not None:
        anchors = anchors.filter(F.col("depth").isin(depths))
        spread = spread.filter(F.col("a_depth").isin(depths))
    chosen = anchors.groupBy("depth", F.col("slug").alias("anchor")).agg(F.max_by("path", "ord").alias("a_path"))
    return (
        spread.select("a_path", F.explode("words").alias("token"))
        .distinct()
        .join(chosen, "a_path")
        .select("depth", "anchor", "token")
    )


def maximal_paths(rows: DataFrame, keys: list[str], path: str = "path") -> DataFrame:
    """Drop a row whose path is an ancestor of another path with the same keys."""
    above = rows.select(*keys, F.explode(tx.ancestors(F.col(path))).alias(path)).distinct()
    return rows.join(above, [*keys, path], "left_anti")


def search_leaves(leaf_rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Leaves whose ``path slug name`` contains the query; ``narrow`` filters hits further.

    ``terms(query, narrow)`` may be of any length; an empty query finds nothing, an empty narrowing keeps all hits.
    A leaf text is cut to its distinct pieces of one to three letters; a query meets the leaves that hold its first
    three letters (all of a shorter one), and ``contains`` decides.
    """
    clean = lambda c: F.lower(tx.strip(F.coalesce(c, F.lit(""))))
    hay = F.lower(F.concat_ws(" ", "leaf_path", "leaf_slug", "display_name"))
    cuts = F.transform(F.sequence(F.lit(1), F.length("hay")), lambda i: F.array(*[F.substring(F.col("hay"), i, F.lit(k)) for k in (1, 2, 3)]))
    leaf_pieces = leaf_rows.withColumn("hay", hay).filter(F.col("hay") != "").withColumn("piece", F.explode(F.array_distinct(F.flatten(cuts))))
    asked = terms.withColumn("q", clean("query")).withColumn("more", clean("narrow")).filter("q <> ''").withColumn("piece", F.left("q", F.lit(3)))
    return (
        leaf_pieces.join(asked, "piece")
        .filter(F.contains("hay", F.col("q")) & F.contains("hay", F.col("more")))
        .select("query", "narrow", "leaf_path", "leaf_slug", "display_name")
    )


def insert_leaves(nodes: DataFrame, proposals: DataFrame) -> DataFrame:
    """New nodes from ``proposals(parent_path, display_name, seq)``.

    The slug comes from the name, must be non-empty and new among its siblings; the parent must
    exist at path length two or more; the first proposal wins inside a batch.
    """
    name = tx.strip(F.col("display_name"))
    ready = (
        proposals.withColumn("display_name", name)
        .withColumn("slug", tx.slugify(F.col("display_name")))
        .filter("slug <> ''")
        .groupBy("parent_path", "slug")
        .agg(F.min_by("display_name", "seq").alias("display_name"))
    )
    parents = nodes.filter("depth >= 1").select(F.col("path").alias("parent_path"), (F.col("depth") + 1).alias("depth"))
    taken = nodes.select("parent_path", "slug")
    return (
        ready.join(parents, "parent_path")
        .join(taken, ["parent_path", "slug"], "left_anti")
        .select(F.concat_ws("/", "parent_path", "slug").alias("path"), "slug", "display_name", "parent_path", "depth")
    )
