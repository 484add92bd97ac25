"""Structural title templates per leaf category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import text as tx
from shelfwise.scale import broadcast_if_small

MIN_CLUSTER = 3
LOW_STRUCTURE = 0.60
TOP_CLUSTERS = 5


def templated(matched: DataFrame, leaf_rows: DataFrame) -> DataFrame:
    """Matched rows of known leaves with their title template."""
    leaf = F.coalesce(F.nullif("leaf_path", F.lit("")), F.nullif("leaf_slug", F.lit("")))
    rows = matched.withColumn("leaf_path", leaf).withColumn("title", F.coalesce("title", F.lit("")))
    known = leaf_rows.select("leaf_path").distinct()
    return rows.join(broadcast_if_small(known), "leaf_path", "left_semi").withColumn(
        "template", tx.title_template(F.col("title"))
    )


def template_lengths(rows: DataFrame) -> DataFrame:
    """Items per (leaf, template, title length) with the first title of that length."""
    return rows.groupBy("leaf_path", "template", F.length("title").alias("len")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("pos").alias("first_pos"),
        F.min_by(F.struct("title", "id"), "pos").alias("rep"),
    )


def template_clusters(rows: DataFrame, min_cluster: int = MIN_CLUSTER) -> DataFrame:
    """Clusters with count and representative: the title nearest the upper median length.

    Lengths are counted first, so the median needs one row per length instead of all titles.
    """
    cluster = Window.partitionBy("leaf_path", "template")
    run = cluster.orderBy("len").rowsBetween(Window.unboundedPreceding, 0)
    sized = (
        template_lengths(rows)
        .withColumn("item_count", F.sum("n").over(cluster))
        .filter(F.col("item_count") >= min_cluster)
        .withColumn("upto", F.sum("n").over(run))
        .withColumn("median_len", F.min(F.when(F.col("upto") > F.floor(F.col("item_count") / 2), F.col("len"))).over(cluster))
    )
    return sized.groupBy("leaf_path", "template").agg(
        F.first("item_count").alias("item_count"),
        F.first("median_len").alias("median_len"),
        F.min("first_pos").alias("first_pos"),
        F.min_by("rep", F.struct(F.abs(F.col("len") - F.col("median_len")), "first_pos")).alias("rep"),
    ).select(
        "leaf_path", "template", "item_count", "median_len", "first_pos",
        F.col("rep.title").alias("representative"), F.col("rep.id").alias("representative_id"),
    )


def template_members(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """Flat ``(leaf_path, template or null for the rest, id)``; no per-cluster list is built."""
    kept = clusters.select("leaf_path", "template", F.lit(True).alias("kept"))
    return rows.join(broadcast_if_small(kept), ["leaf_path", "template"], "left").select(
        "leaf_path", F.when(F.col("kept"), F.col("template")).alias("template"), "id", "pos"
    )


def top_clusters(clusters: DataFrame, k: int = TOP_CLUSTERS) -> DataFrame:
    """Largest clusters per leaf; ties keep first-seen order (partial top-k before the shuffle)."""
    w = Window.partitionBy("leaf_path").orderBy(F.desc("item_count"), F.asc("first_pos"))
    return clusters.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def manifest(rows: DataFrame, min_cluster: int = MIN_CLUSTER, low_ratio: float = LOW_STRUCTURE) -> DataFrame:
    """Per leaf: items, clusters, misc items, low-structure flag and file name."""
    sizes = rows.groupBy("leaf_path", "template").agg(F.count(F.lit(1)).alias("n"))
    big = F.col("n") >= min_cluster
    return (
        sizes.groupBy("leaf_path")
        .agg(
            F.sum("n").alias("total_items"),
            F.count_if(big).alias("cluster_count"),
            F.coalesce(F.sum(F.when(~big, F.col("n"))), F.lit(0)).alias("misc_item_count"),
        )
        .withColumn("is_low_structure", F.col("misc_item_count") / F.col("total_items") >= low_ratio)
        .withColumn("file", F.concat(F.replace("leaf_path", F.lit("/"), F.lit("__")), F.lit(".json")))
    )


def manifest_totals(manifest_rows: DataFrame) -> DataFrame:
    return manifest_rows.agg(
        F.count(F.lit(1)).alias("total_categories"),
        F.coalesce(F.sum("total_items"), F.lit(0)).alias("total_items"),
        F.count_if("is_low_structure").alias("low_structure_count"),
    )
