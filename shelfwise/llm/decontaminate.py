"""Benchmark decontamination: size-partitioned MinHash containment search. DataFrame operations only.

An item (a short test text) is contained in a document if at least ``threshold`` of its distinct word shingles
occur in it. Items are partitioned by size. Every partition has its own sketch length: the k smallest hashes of an
item's shingle set with k = floor((1 - threshold) * largest size of the partition) + 1. A document that contains
enough of the item can miss fewer than k of its shingles, so at least one hash of the sketch occurs in the document:
the search has no false negatives, however long the document is. (Sketches of the documents, as in a banded index,
would need thousands of hashes to see 40 shingles inside 20,000.)

1. Search: the hashed shingles of all documents, made on the fly, meet the sketches; only (document, item) pairs
   come out.
2. Verification: the shingles of all documents meet the full shingle sets by hash and by text; distinct hits of the
   candidate pairs are counted and compared with the item's size.

Sketches and item sets are broadcast only if their measured bytes are small; otherwise they meet in a shuffle join
that adaptive execution can split. No text is ever shuffled: a pass emits hits only, and those are combined before
they move, so a passage in a third of all documents is no hot key.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing. Items with fewer words than a shingle have no shingle and
match nothing, likewise documents, null and empty texts included. A document is known by doc_id and a digest of its
text: different texts under one doc_id or under null are judged one by one, and each that contains an item gives a row.
Rows with one item_id count as one item, null as an item of its own. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import text_or_empty, words
from shelfwise.scale import broadcast_if_small, cut_lineage

WIDTH = 5
THRESHOLD = 0.8


def _shingle(width: int) -> Column:
    return F.concat_ws(" ", *[F.element_at("w", F.col("i") + j) for j in range(width)])


def _digest(text_col: str) -> Column:
    return F.unhex(F.substring(F.sha2(text_or_empty(text_col), 256), 1, 32))


def _shingles(table: DataFrame, keys: list[Column], text_col: str, width: int) -> DataFrame:
    """(keys, hash, w, i): one row per shingle with its words' array and place, joined to text only where needed."""
    w = table.select(*keys, words(F.lower(text_or_empty(text_col))).alias("w"))
    keep = w.columns[:-1]
    w = w.filter(F.size("w") >= width)
    at = w.select(*keep, "w", F.explode(F.sequence(F.lit(1), F.size("w") - (width - 1))).alias("i"))
    parts = [F.element_at("w", F.col("i") + j) for j in range(width)]
    return at.select(*keep, F.xxhash64(*parts).alias("hash"), "w", "i")


def item_sets(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(item_id, hash, shingle, n_item): the distinct shingles of every item and their number."""
    rows = _shingles(items, [F.col(id_col).alias("item_id")], text_col, width)
    rows = rows.select("item_id", "hash", _shingle(width).alias("shingle")).distinct()
    n = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    return rows.join(n, rows["item_id"].eqNullSafe(n["item_id"])).drop(n["item_id"])


def sketches(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item_id, hash): k smallest hashes of every item, k by its size partition (powers of two)."""
    part = F.ceil(F.log2("n_item")).cast("int")
    sized = sets.withColumn("size_part", part)
    largest = sized.groupBy("size_part").agg(F.max("n_item").alias("largest"))
    k = largest.select("size_part", (F.floor((1 - threshold) * F.col("largest") + 1e-9) + 1).cast("int").alias("k"))
    lists = sized.groupBy("item_id", "size_part").agg(F.sort_array(F.collect_set("hash")).alias("all"))
    return (
        lists.join(F.broadcast(k), "size_part")
        .select("item_id", F.explode(F.slice("all", F.lit(1), F.col("k"))).alias("hash"))
        .distinct()
    )


def contained(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, width: int, threshold: float) -> DataFrame:
    """(doc_id, digest, item_id, n_item, n_shared, containment) of all pairs at or above the threshold."""
    sets = cut_lineage(item_sets(items, width=width))
    probe = _shingles(docs, [F.col(id_col).alias("doc_id"), _digest(text_col).alias("digest")], text_col, width)
    found = cut_lineage(
        probe.select("doc_id", "digest", "hash")
        .join(broadcast_if_small(cut_lineage(sketches(sets, threshold))), "hash")
        .select("doc_id", "digest", "item_id")
        .distinct()
    )
    full = broadcast_if_small(sets.select("item_id", "hash", F.col("shingle").alias("item_shingle"), "n_item"))
    hits = (
        probe.join(full, "hash")
        .filter(_shingle(width) == F.col("item_shingle"))
        .select("doc_id", "digest", "item_id", "n_item", "item_shingle")
        .distinct()
        .groupBy("doc_id", "digest", "item_id", "n_item")
        .agg(F.count(F.lit(1)).alias("n_shared"))
    )
    same = (
        (hits["digest"] == found["digest"])
        & hits["doc_id"].eqNullSafe(found["doc_id"])
        & hits["item_id"].eqNullSafe(found["item_id"])
    )
    share = F.col("n_shared") / F.col("n_item")
    return (
        hits.join(found, same, "left_semi")
        .select("doc_id", "digest", "item_id", "n_item", "n_shared", share.alias("containment"))
        .filter(F.col("containment") >= threshold)
    )


def containment(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of all pairs at or above the threshold."""
    return contained(docs, items, id_col, text_col, width, threshold).drop("digest")


def clean(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Documents that contain no item, with all their columns."""
    pairs = contained(docs, items, id_col, text_col, width, threshold)
    bad = broadcast_if_small(cut_lineage(pairs.select(F.col("doc_id").alias("__bad"), F.col("digest").alias("__digest")).distinct()))
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__bad"]) & (_digest(text_col) == bad["__digest"]), "left_anti")
