"""URL filter by a sort-merge range join. DataFrame operations only.

A rule is (host, path, verdict). It fits its host and all subdomains if the path of the url starts with the rule's;
of the rules that fit, the one with the longest host + path wins, then the one with the longer host.

The host is turned round (``blog.example.org`` is ``org.example.blog``) and followed by a slash and the path, so a rule
is a prefix and its keys are one interval. Intervals of prefixes are nested or apart. A url is looked up under every
suffix of its host that has as many labels as some rule, thus under rules of the host itself and of its parents.

Urls, interval starts and interval ends are sorted together into ranges of ``rows_per_range`` rows. A running sum of
starts and ends is the height of the stack of active rules; the top of the stack is the latest start of that height.
A rule that spans several ranges is laid on the stack of each of them anew; nested intervals make that at most (ranges x
height of the stack) rows.

Only distinct (host, path) pairs are swept, with their counts, so copies of a url cost nothing there. Verdicts return to
the rows by ``attach``: pairs that hold many rows are a bounded broadcast, the others meet in a shuffle join.

Nulls: a null url, or one without ``://``, has an empty host and path, and gets ``default``. Rules with a null host or
verdict are left out, a null path is empty; of rules with the same host and path, block wins. Very long urls are keys
like others. Rows that are equal, or share an identifier, are judged each. Empty tables give no rows, or ``default``
everywhere. Columns of ``pages`` beside the identifier and the url are not read, so no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import attach
from shelfwise.scale import cut_lineage

ROWS_PER_RANGE = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Order of events with one key: an end lies behind all keys of its prefix, a start before them.
_START, _URL, _END = 0, 1, 2


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1, F.length(rest) + 1), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def labels_turned(host: Column) -> Column:
    return F.reverse(F.split(host, "\\.", -1))


def canonical(labels: Column, path: Column) -> Column:
    """Sort key; bytes, since their order does not depend on a collation. A host holds no slash."""
    return F.concat(F.array_join(labels, "."), F.lit("/"), path).cast("binary")


def rule_table(rules: DataFrame) -> DataFrame:
    """host, path, verdict, n_labels, key of the distinct rules."""
    path = F.coalesce(F.col("path"), F.lit(""))
    named = rules.filter("host IS NOT NULL AND verdict IS NOT NULL").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), path.alias("path"), "verdict"
    )
    single = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    return single.select(
        "*", F.size(labels_turned(F.col("host"))).alias("n_labels"), canonical(labels_turned(F.col("host")), F.col("path")).alias("key")
    )


def sweep(points: DataFrame, prefixes: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``(key, point, top)`` of the points that lie below a prefix: the payload of the longest prefix of ``key``.

    ``points`` has key (binary) and point; ``prefixes`` has key, distinct, and prefix. Both payloads are of any type.
    """
    spark = points.sparkSession
    no_point, no_prefix = F.lit(None).cast(points.schema["point"].dataType), F.lit(None).cast(prefixes.schema["prefix"].dataType)
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-points.count() // rows_per_range))
    events = (
        points.select("key", F.lit(_URL).alias("kind"), "point", no_prefix.alias("prefix"))
        .unionByName(prefixes.select("key", F.lit(_START).alias("kind"), no_point.alias("point"), "prefix"))
        # FF is no byte of UTF-8, so this key is behind every key of the prefix and before all others
        .unionByName(prefixes.select(F.concat("key", F.lit(b"\xff")).alias("key"), F.lit(_END).alias("kind"), no_point.alias("point"), "prefix"))
        # the hash splits a key that many points share
        .withColumn("tie", F.xxhash64("point"))
    )
    events = cut_lineage(events.repartitionByRange(width, "key", "kind", "tie").withColumn("at", F.spark_partition_id()))
    bounds = events.filter(F.col("kind") != _URL)
    starts = bounds.filter(F.col("kind") == _START).select("key", "prefix", F.col("at").alias("first"))
    ends = bounds.filter(F.col("kind") == _END).select(
        F.expr("substring(key, 1, octet_length(key) - 1)").alias("key"), F.col("at").alias("last")
    )
    again = starts.join(ends, "key").filter("last > first").select(
        "key", F.lit(_START).alias("kind"), no_point.alias("point"), "prefix", F.lit(0).cast("long").alias("tie"),
        F.explode(F.sequence(F.col("first") + 1, F.col("last"))).alias("at"),
    )
    # prefixes carried over from an earlier range have smaller keys than all of its own
    in_order = Window.partitionBy("at").orderBy("key", "kind", "tie")
    step = F.when(F.col("kind") == _START, 1).when(F.col("kind") == _END, -1).otherwise(0)
    by_height = Window.partitionBy("at", "height").orderBy("key", "kind", "tie")
    return (
        events.unionByName(again)
        .withColumn("height", F.sum(step).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("kind") != _END)
        .withColumn("top", F.last("prefix", ignorenulls=True).over(by_height.rowsBetween(Window.unboundedPreceding, 0)))
        .filter((F.col("kind") == _URL) & (F.col("height") > 0))
        .select("key", "point", "top")
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per page: its identifier, host, path, rule (host and path of the winner, else null), verdict."""
    table = rule_table(rules)
    host, path = host_and_path(F.col(f"`{url_col}`"))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    pairs = cut_lineage(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")))
    depth = table.agg(F.min("n_labels").alias("least"), F.max("n_labels").alias("most")).first()
    labels = F.col("labels")
    suffixes = (
        pairs.withColumn("labels", labels_turned(F.col("host")))
        .filter(F.size(labels) >= (depth["least"] or 0))
        .withColumn("take", F.explode(F.sequence(F.lit(depth["least"] or 0), F.least(F.size(labels), F.lit(depth["most"] or 0)))))
        .select(canonical(F.slice(labels, 1, F.col("take")), F.col("path")).alias("key"), F.struct("host", "path").alias("point"))
    )
    prefixes = table.select("key", F.struct("host", "path", "verdict").alias("prefix"))
    found = sweep(suffixes, prefixes, rows_per_range)
    size = F.struct(F.length("top.host") + F.length("top.path"), F.length("top.host"))
    best = found.groupBy("point").agg(F.max_by("top", size).alias("top"))
    best = best.select(F.col("point.host").alias("host"), F.col("point.path").alias("path"), "top")
    judged = cut_lineage(pairs.join(best, ["host", "path"], "left"))
    return attach(rows, judged, ["host", "path"], "n").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.concat("top.host", "top.path").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )
