"""Mixing sources to target weights by systematic sampling. DataFrame operations only.

The size of a document is its number of words. Sources, by code point with null last, get the weights in turn;
together they are to make ``share`` of all sizes, none more than ``cap`` times its own. What a capped source
cannot take goes to the others by weight until none is above; that is one level L with target
min(cap * size, L * weight), found in one pass over the sources ordered by cap * size / weight.

Inside a source every document expects target / source_size copies. Expected copies are prefix-summed along an
order by size, one offset in [0, 1) drawn from the source's name is added, and a document is emitted once per
integer boundary crossed. The order by size spreads copies evenly over short and long texts, so the words taken
come near the target.

The prefix sum has two levels. A block is (source, leading two digits of the size, a hash of the id in
SUB parts); counts per block are summed along the few blocks of a source, and rows are numbered inside their
block. A source with most rows is thus dealt out in thousands of blocks, and the text moves at most once.

Nulls: a null text has size 0, a null source is a source of its own. A source without words has target 0 and is
not emitted. Rows that are equal in every respect may swap places, with equal results. The columns to keep travel
in one struct, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import text_or_empty, word_count
from shelfwise.scale import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SUB = 8


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Targets of (skey, source_size). Sources are a configuration-sized table; they are ordered in one window."""
    by_name = Window.partitionBy(F.lit(1)).orderBy("skey")
    everything = Window.partitionBy(F.lit(1))
    by_level = Window.partitionBy(F.lit(1)).orderBy("full", "skey")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight.cast("long"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.col("source_size") * float(cap) / F.col("weight"))
        .withColumn("size_before", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # level if this source and all after it are not capped
        .withColumn("level", (F.col("total") * float(share) - F.col("size_before") * float(cap)) / F.col("weight_left"))
        .withColumn("open", F.col("full") > F.col("level"))
        .withColumn("first_open", F.min(F.when(F.col("open"), F.struct("full", "skey", "level"))).over(everything))
    )
    level = F.col("first_open.level")
    target = F.when(level.isNull() | (F.col("full") <= level), F.col("source_size") * float(cap)).otherwise(
        level * F.col("weight")
    )
    return rows.select("skey", "source_size", target.alias("target"))


def copies(
    docs: DataFrame,
    keep: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
) -> DataFrame:
    """One row per document: row (struct of ``keep``), size, source_size, target, copies."""
    digits = F.col("size").cast("string")
    name = F.col(id_col).cast("string")
    others = [F.col(f"`{c}`") for c in keep if c != text_col]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        # orders rows of one identifier and size; JSON also holds maps, which no hash takes
        F.xxhash64(text_or_empty(text_col), F.to_json(F.struct(*others)) if others else F.lit("")).alias("tie"),
        word_count(text_or_empty(text_col)).alias("size"),
        # 0 before 1 puts null last; the rest keeps the order by code point
        F.coalesce(F.concat(F.lit("0"), F.col(source_col).cast("string")), F.lit("1")).alias("skey"),
        F.md5(F.coalesce(name, F.lit("")).cast("binary")).alias("order_key"),
    ).select(
        "*",
        (F.length(digits) * 100 + F.rpad(digits, 2, "0").substr(1, 2).cast("int")).alias("magnitude"),
        (F.conv(F.substring("order_key", 1, 4), 16, 10).cast("int") % SUB).alias("sub"),
    )
    block = ["skey", "magnitude", "sub"]
    blocks = cut_lineage(rows.groupBy(*block).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")))
    targets = source_targets(
        blocks.groupBy("skey").agg(F.sum("size").alias("source_size")), weights, share, cap
    )
    before = Window.partitionBy("skey").orderBy("magnitude", "sub").rowsBetween(Window.unboundedPreceding, -1)
    # 20 bits of the source's digest: sums of multiples of 2^-20 stay exact
    offset = (F.conv(F.substring(F.md5(F.col("skey").cast("binary")), 1, 5), 16, 10).cast("long") + 0.5) / 1048576.0
    starts = blocks.select(*block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).join(targets, "skey")
    starts = starts.select(
        *block,
        "start",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
        offset.alias("offset"),
    )
    inside = Window.partitionBy(*block).orderBy("order_key", "size", "tie")
    numbered = rows.withColumn("place", F.row_number().over(inside)).join(starts, block)
    upto = F.floor((F.col("start") + F.col("place")) * F.col("rate") + F.col("offset"))
    upto_before = F.floor((F.col("start") + F.col("place") - 1) * F.col("rate") + F.col("offset"))
    return numbered.select(
        "row", "size", "source_size", "target", F.least(upto - upto_before, F.ceil("rate")).cast("int").alias("copies")
    )


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    out = copies(docs, [options.get("id_col", "doc_id")], **options)
    return out.select(
        F.col(f"row.`{options.get('id_col', 'doc_id')}`").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every document once per copy, with all its columns."""
    names = docs.columns
    out = copies(docs, names, **options).filter(F.col("copies") > 0)
    out = out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in names])
