"""Small pieces shared by the corpus operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.scale import ensure_checkpoint_dir

#: The white space of the contracts, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
WORD_GAPS = "[\\x20\\x09-\\x0D]+"
#: Most keys that ``attach`` broadcasts; a key is hot from rows / HOT_KEYS rows on.
HOT_KEYS = 10_000
PORTION = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array; empty for a text without words."""
    return F.array_remove(F.split(text, WORD_GAPS), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def portions(batches: Iterator[pa.RecordBatch], rows: int = PORTION) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to ``rows`` rows, which bounds what a worker makes of a batch; nothing is copied."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release()


def release() -> None:
    """Give freed memory back to the system; a worker kept for the next tasks would hold it beside what they take."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder, as a URI without a trailing slash."""
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir()
    if base.startswith("file:/") and not base.startswith("file://"):
        base = "file://" + base[len("file:") :]
    return f"{base}/{name}-{uuid.uuid4().hex}"


def attach(rows: DataFrame, groups: DataFrame, key: Sequence[str], n: str) -> DataFrame:
    """Inner join of ``rows`` with one row of ``groups`` per key; ``n`` holds the rows of the key.

    Keys with at least rows / HOT_KEYS rows are at most HOT_KEYS by arithmetic: they are broadcast, so
    a key with a third of all rows is never shuffled. All other keys are small and meet in a shuffle join.
    Both inputs are read twice: pass tables that are cut.
    """
    key = list(key)
    total = groups.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    hot = F.col(n) >= F.lit(max(2, -(-total // HOT_KEYS)))
    few = groups.filter(hot).withColumn("__hot", F.lit(True))
    marked = rows.join(F.broadcast(few), key, "left")
    taken = marked.filter(F.col("__hot")).drop("__hot")
    rest = rows.join(F.broadcast(few.select(*key)), key, "left_anti").join(groups.filter(~hot), key)
    return taken.unionByName(rest)
