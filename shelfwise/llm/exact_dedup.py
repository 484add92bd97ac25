"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition makes a run of (digest, best row, rows). Runs are exchanged in rounds: run r goes to
run r // FAN, so after k rounds FAN^k runs are one and log_FAN(partitions) rounds leave a single run. A run is
cut by digest prefix into SHARDS pieces that merge on their own, so the last round is as wide as the first and
no task ever holds a whole run. Inside a task the pieces arrive sorted by digest and equal neighbours merge in
one pass (a sort aggregate; it spills). A level keeps, for each digest, the longest original text, then the
smallest identifier; digests count as equal only if length and a second hash agree too.

Copies collapse in their own partition before the first exchange, so a text that makes a third of all rows
costs one row a partition.

Nulls: a null text counts as empty; all texts without visible characters are one group. A null identifier
loses every tie and stays null. Repeated rows (same identifier, same text) are members like others; of rows that
tie in all, the first read is kept, so one row of every group is. Very long texts are digested whole. An empty
table gives an empty result. Only the identifier and the text column are read, other names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import SPACES, attach, text_or_empty
from shelfwise.scale import cut_lineage

FAN = 8
KEY = ["shard", "sha", "second", "n_bytes"]


def digest_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document, with the number of the partition that read it."""
    text = text_or_empty(text_col)
    bare = F.translate(text, SPACES, "")
    return (
        docs.select(F.col(id_col).alias("doc_id"), text.alias("t"), bare.alias("b"))
        .select(
            "doc_id",
            F.length("t").cast("long").alias("n_points"),
            F.sha2(F.col("b").cast("binary"), 256).alias("sha"),
            F.xxhash64("b").alias("second"),
            F.octet_length("b").cast("long").alias("n_bytes"),
        )
        .withColumn("shard", F.substring("sha", 1, 3))
        .withColumn("run", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id())
    )


def merge_round(runs: DataFrame, fan: int = FAN) -> DataFrame:
    """Merge ``fan`` neighbouring runs of every shard into one, by sorted digest."""
    return (
        runs.withColumn("run", F.floor(F.col("run") / fan).cast("int"))
        .repartition("shard", "run")
        .groupBy("shard", "run", "sha", "second", "n_bytes")
        .agg(F.max("best").alias("best"), F.sum("n_rows").alias("n_rows"))
    )


def merge_tree(digests: DataFrame, fan: int = FAN) -> DataFrame:
    """All rounds; one row per digest with the row that stays and the number of rows."""
    last = digests.agg(F.max("run")).first()[0] or 0
    runs = digests.groupBy("shard", "run", "sha", "second", "n_bytes").agg(
        # ~id falls as id grows and cannot overflow
        F.max(F.struct("n_points", F.expr("~doc_id").alias("inverse"), F.expr("~row").alias("row"))).alias("best"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    while True:
        runs = merge_round(runs, fan)
        last //= fan
        if last == 0:
            break
    return runs.select(
        *KEY, F.expr("~best.inverse").alias("keep_id"), F.expr("~best.row").alias("keep_row"), F.col("n_rows").alias("group_size")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = FAN) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = cut_lineage(digest_table(docs, id_col, text_col))
    groups = cut_lineage(merge_tree(digests, fan))
    rows = attach(digests.select("doc_id", "row", *KEY), groups, KEY, "group_size")
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
