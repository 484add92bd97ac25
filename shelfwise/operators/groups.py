"""Similar-title groups: blocking, components, cliques, numbering, labels.

Titles are compared only inside a block (first token, length band). Copies collapse first, distinct titles meet in the
similarity join of ``title_join``. Groups are components, or cliques of at least ``min_group`` items: the heaviest clique of
a block is taken out again and again. A clique lies inside a component, so cliques are searched per component of the edge
table, by branch and bound over bit sets with a colouring bound; no block is gathered.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import text as tx
from shelfwise.operators.title_join import CHUNK_TITLES, component_labels, similar_edges
from shelfwise.scale import cut_lineage, number_rows, side_by_side, skew_join, spread

MIN_SIMILARITY = 0.7
MIN_GROUP = 5
BLOCK = ["token", "band"]


def block_items(items: DataFrame) -> DataFrame:
    """Items with their normalized title and blocking key."""
    return (
        items.withColumn("norm", tx.normalize_title(F.col("title")))
        .withColumn("token", tx.first_token(F.col("norm")))
        .withColumn("band", tx.length_band(F.col("norm")))
    )


def distinct_titles(blocked: DataFrame) -> DataFrame:
    """One row per distinct title; copies collapse map-side before the shuffle."""
    return blocked.groupBy(*BLOCK, "norm").agg(
        F.count(F.lit(1)).alias("n_items"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")
    )


def block_sizes(blocked: DataFrame) -> DataFrame:
    """Items, distinct titles and candidate item pairs per block."""
    return (
        distinct_titles(blocked)
        .groupBy(*BLOCK)
        .agg(F.sum("n_items").alias("n_items"), F.count(F.lit(1)).alias("n_titles"))
        .withColumn("n_pairs", (F.col("n_items") * (F.col("n_items") - 1) / 2).cast("long"))
    )


def similar_pairs(items: DataFrame, min_sim: float = MIN_SIMILARITY, chunk_titles: int = CHUNK_TITLES) -> DataFrame:
    """Every pair ``(u, v)`` of distinct titles of a block at the threshold, named by first position."""
    return similar_edges(cut_lineage(distinct_titles(block_items(items))), BLOCK, min_sim, chunk_titles)


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node of each component: neighbour minimum plus pointer jumping per round.

    ``nodes`` has ``node``; ``edges`` has ``u, v``. Minimum is combined map-side, labels are
    checkpointed each round, and the loop ends when no label moves.
    """
    back = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    both = cut_lineage(edges.select(F.inline(F.array(F.struct("u", "v"), back))))
    degree = cut_lineage(both.groupBy("u").agg(F.count(F.lit(1)).alias("degree")))
    labels = nodes.select("node", F.col("node").alias("label"))
    while True:
        near = (
            skew_join(both, labels.withColumnRenamed("node", "u"), ["u"], degree, "degree")
            .groupBy(F.col("v").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        pulled = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label")
        )
        pulled = cut_lineage(pulled)
        if pulled.filter(F.col("old") != F.col("label")).isEmpty():
            return labels
        sizes = pulled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        roots = pulled.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = skew_join(pulled, roots, ["label"], sizes, "n", "left").select(
            "node", F.coalesce("root", "label").alias("label")
        )


def _degeneracy(adj: list[int]) -> list[int]:
    """Vertices, always one of least degree among those left."""
    left, degree, order = set(range(len(adj))), [a.bit_count() for a in adj], []
    buckets: dict[int, set[int]] = {}
    for v, d in enumerate(degree):
        buckets.setdefault(d, set()).add(v)
    low = 0
    while left:
        while not buckets.get(low):
            low += 1
        v = buckets[low].pop()
        order.append(v)
        left.discard(v)
        near = adj[v]
        while near:
            w = (near & -near).bit_length() - 1
            near &= near - 1
            if w in left:
                buckets[degree[w]].discard(w)
                degree[w] -= 1
                buckets.setdefault(degree[w], set()).add(w)
        low = max(0, low - 1)
    return order


def _heaviest(adj: list[int], weight: list[int], pool: int, floor: int, enough: int | None = None) -> tuple[int, int]:
    """Weight and vertices (bits) of a clique of ``pool`` heavier than ``floor``, the heaviest or the first of ``enough``; else (floor, 0)."""
    best, found = floor, 0

    def grow(chosen: int, total: int, pool: int) -> None:
        nonlocal best, found
        if enough is not None and best >= enough:
            return
        # vertices that all others of the pool know belong to every largest clique
        rest = pool
        while rest:
            v = (rest & -rest).bit_length() - 1
            rest &= rest - 1
            if pool & ~adj[v] == 1 << v:
                chosen, total, pool = chosen | 1 << v, total + weight[v], pool & ~(1 << v)
        if not pool:
            if total > best:
                best, found = total, chosen
            return
        # colour classes hold no edge, so a clique takes at most the heaviest vertex of each
        order, bound, left = [], 0, pool
        while left:
            free, top, members = left, 0, 0
            while free:
                v = (free & -free).bit_length() - 1
                free &= ~(adj[v] | 1 << v)
                members |= 1 << v
                top = max(top, weight[v])
                order.append((v, len(order)))
            bound += top
            left &= ~members
            order[-members.bit_count() :] = [(v, bound) for v, _ in order[-members.bit_count() :]]
        for v, limit in reversed(order):
            if total + limit <= best:
                return
            grow(chosen | 1 << v, total + weight[v], pool & adj[v])
            pool &= ~(1 << v)

    grow(0, 0, pool)
    return best, found


def clique_cover(first: list[int], weight: list[int], edges: list[tuple[int, int]], min_group: int) -> list[tuple[int, list[int]]]:
    """Cliques of a graph as (weight, indices), the heaviest first; among equals the smallest sorted list of ``first``."""
    plain: list[int] = [0] * len(first)
    for i, j in edges:
        plain[i] |= 1 << j
        plain[j] |= 1 << i
    # bits in degeneracy order, dense vertices first: colouring starts there
    order = _degeneracy(plain)[::-1]
    bit = {v: k for k, v in enumerate(order)}
    adj = [0] * len(order)
    for i, j in edges:
        adj[bit[i]] |= 1 << bit[j]
        adj[bit[j]] |= 1 << bit[i]
    heavy = [weight[v] for v in order]
    by_place = sorted(range(len(order)), key=lambda k: first[order[k]])
    left, out = (1 << len(order)) - 1, []
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(max(limit, 4 * len(order) + 1000))
    while left:
        total, known = _heaviest(adj, heavy, left, min_group - 1)
        if not known:
            break
        chosen, held, pool = 0, 0, left
        for v in by_place:
            if held == total:
                break
            if not pool >> v & 1:
                continue
            if not known >> v & 1:
                need = total - held - heavy[v]
                more = _heaviest(adj, heavy, pool & adj[v], need - 1, need) if need > 0 else (need, 0)
                if more[0] < need:
                    continue
                known = chosen | 1 << v | more[1]
            chosen, held, pool = chosen | 1 << v, held + heavy[v], pool & adj[v]
        out.append((total, sorted(order[k] for k in range(len(order)) if chosen >> k & 1)))
        left &= ~chosen
    sys.setrecursionlimit(limit)
    return out


def clique_titles(titles: DataFrame, min_sim: float, min_group: int, chunk_titles: int = CHUNK_TITLES) -> DataFrame:
    """``titles`` that are in a clique, with ``weight``, its items, and ``emission``, its first position.

    One task searches one component of similar titles; the time is exponential in the worst case, as for any clique search.
    """
    edges = cut_lineage(similar_edges(titles, BLOCK, min_sim, chunk_titles))
    labels = cut_lineage(connected_components(titles.select(F.col("first_pos").alias("node")), edges))
    named = titles.join(labels, titles["first_pos"] == labels["node"]).drop("node")
    heavy = named.groupBy("label").agg(F.sum("n_items").alias("total")).filter(F.col("total") >= min_group).select("label")
    nodes = named.select("label", "first_pos", "n_items").join(heavy, "label", "left_semi")
    inside = edges.join(labels.join(heavy, "label", "left_semi"), edges["u"] == labels["node"]).select(F.col("label").alias("component"), "u", "v")

    def cover(nodes: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        first = nodes["first_pos"].tolist()
        place = {p: i for i, p in enumerate(first)}
        pairs = [(place[u], place[v]) for u, v in zip(edges["u"].tolist(), edges["v"].tolist())]
        found = clique_cover(first, nodes["n_items"].tolist(), pairs, min_group)
        rows = [(first[i], total, min(first[k] for k in members)) for total, members in found for i in members]
        return pd.DataFrame(rows, columns=["first_pos", "weight", "emission"])

    cliques = (
        spread(nodes, "label").groupBy("label").cogroup(spread(inside, "component").groupBy("component"))
        .applyInPandas(cover, "first_pos long, weight long, emission long")
    )
    return titles.join(cliques, "first_pos")


def group_members(
    items: DataFrame,
    min_sim: float = MIN_SIMILARITY,
    min_group: int = MIN_GROUP,
    method: str = "component",
    chunk_titles: int = CHUNK_TITLES,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Members of every group: ``group_no, group_id, method, pos, id, title, norm``.

    ``method`` is ``component`` (linked titles) or ``clique`` (all titles alike), for blocks of any size.
    Groups are numbered by block, then by emission order.
    """
    min_group = max(2, min_group)
    # titles are cut out of the items and normalized once
    blocked = cut_lineage(block_items(items.select("pos", "id", "title")))
    sizes = cut_lineage(block_sizes(blocked).filter(F.col("n_items") >= min_group))
    sized = cut_lineage(
        skew_join(blocked.select("pos", "norm", *BLOCK), sizes.select(*BLOCK, "n_items"), BLOCK, sizes, "n_items")
    )

    titles = cut_lineage(distinct_titles(sized))
    if method == "clique":
        grouped = clique_titles(titles, min_sim, min_group, chunk_titles)
    elif method == "component":
        labelled = component_labels(titles, BLOCK, min_sim, chunk_titles, connected_components)
        wide = labelled.groupBy("label").agg(F.sum("n_items").alias("total")).filter(F.col("total") >= min_group)
        grouped = labelled.join(wide.select("label"), "label").select(
            *BLOCK, "norm", F.lit(0).cast("long").alias("weight"), F.col("label").alias("emission")
        )
    else:
        raise ValueError(f"unknown method {method}")
    members = skew_join(
        sized.select(*BLOCK, "norm", "pos"), grouped.select(*BLOCK, "norm", "weight", "emission"), [*BLOCK, "norm"], titles, "n_items"
    ).select(*BLOCK, (-F.col("weight")).alias("rank"), "emission", "pos", F.lit(method).alias("method"))
    members = cut_lineage(members)
    heads = members.groupBy(*BLOCK, "rank", "emission").agg(F.count(F.lit(1)).alias("item_count"))
    args = {} if rows_per_bucket is None else {"rows_per_bucket": rows_per_bucket}
    numbered = cut_lineage(number_rows(heads, [*BLOCK, "rank", "emission"], "group_no", start=0, **args))
    named = skew_join(members, numbered.drop("rank"), [*BLOCK, "emission"], numbered, "item_count")
    return (
        named.join(blocked.select("pos", "id", "title", "norm"), "pos")
        .withColumn("group_id", tx.group_label(F.col("group_no")))
        .select("group_no", "group_id", "method", "pos", "id", "title", "norm")
    )


def group_heads(members: DataFrame) -> DataFrame:
    """Group size and label: common prefix of normalized titles if 4+ characters, else the
    shortest original title (first on ties)."""
    agg = members.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.first("method").alias("method"),
        F.min("norm").alias("lo"),
        F.max("norm").alias("hi"),
        F.min_by("title", F.struct(F.length("title"), F.col("pos"))).alias("shortest"),
    )
    prefix = tx.strip(tx.common_prefix(F.col("lo"), F.col("hi")))
    label = F.when(F.length(prefix) >= 4, prefix).otherwise(
        F.coalesce(F.nullif(tx.strip(F.col("shortest")), F.lit("")), prefix)
    )
    return agg.select("group_id", "method", "item_count", label.alias("master_title"))


def preview(members: DataFrame, k: int = 12) -> DataFrame:
    """First ``k`` members of each group, for display (partial top-k before the shuffle)."""
    w = Window.partitionBy("group_id").orderBy("pos")
    return members.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def ungrouped(items: DataFrame, members: DataFrame) -> DataFrame:
    return items.join(members.select("pos"), "pos", "left_anti")


def group_stats(items: DataFrame, members: DataFrame, min_group: int = MIN_GROUP, method: str = "component") -> DataFrame:
    """One row: items in, groups, grouped, ungrouped, and blocks per method."""
    sizes = block_sizes(block_items(items)).agg(
        F.coalesce(F.sum("n_items"), F.lit(0)).alias("items_in"),
        *[F.count_if((F.col("n_items") >= min_group) & F.lit(method == m)).alias(f"{m}_blocks") for m in ("clique", "component")],
    )
    grouped = members.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("groups_emitted"), F.coalesce(F.sum("n"), F.lit(0)).alias("items_in_groups")
    )
    return side_by_side(sizes, grouped).withColumn(
        "items_ungrouped", F.col("items_in") - F.col("items_in_groups")
    )
