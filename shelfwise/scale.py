"""Building blocks that keep plans safe when data grows or one key is hot.

* ``cut_lineage``       reliable checkpoint for iterative plans (never a local one)
* ``cut_and_count``     the same, with the rows counted on the way
* ``broadcast_if_small`` broadcast hint behind a measured byte bound
* ``shared_arrays``     what tasks need of a table, read by the tasks themselves where it is large
* ``deal_texts``        items in tasks of about equal text
* ``skew_join``         equi-join whose hot keys are salted on the big side
* ``number_rows``       dense row numbers without a single-task window
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
JOIN_BYTES = 16 * 1024 * 1024
HOT_ROWS = 5_000_000
TEXT_PER_TASK = 2 << 20
ROWS_PER_BUCKET = 1_000_000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; fall back to a temp folder in local mode only."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is not None:
        return
    if configured:
        sc.setCheckpointDir(configured)
    elif re.match(r"local(\[|$)", sc.master):  # tests and trials on one machine
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder; survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_and_count(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` with the number of rows, which is observed while they are written."""
    seen = Observation()
    cut = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return cut, seen.get["n"]


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows to the configured number of shuffle partitions.

    For steps that are heavy on CPU but light in bytes: adaptive execution sizes partitions by
    bytes and would run them in too few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory row bytes of a flat table (runs one aggregate job)."""
    width = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
        else:
            width = width + 8
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()["b"]


def deal_texts(items: DataFrame, text_per_task: int = TEXT_PER_TASK) -> DataFrame:
    """Items dealt by ``pos`` to tasks of about ``text_per_task`` bytes."""
    tasks = max(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-measured_bytes(items) // text_per_task))
    return items.repartition(tasks, "pos")


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the measured size allows it; else leave the join to AQE.

    The driver holds a broadcast table several times, as rows, as a hash table and in blocks: a query that has many takes ``JOIN_BYTES``.
    """
    return F.broadcast(df) if is_small(df, max_bytes) else df


class StoredArrays:
    """``value``: what ``build`` makes of a table in the shared checkpoint folder. A Python worker reads it once and keeps the last few."""

    kept: dict[str, object] = {}

    def __init__(self, folder: str, build: Callable[[pa.Table], object]):
        self.folder, self.build = folder, build

    @property
    def value(self) -> object:
        if self.folder not in StoredArrays.kept:
            system, path = fs.FileSystem.from_uri(self.folder)
            files = sorted(f.path for f in system.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet"))
            table = pa.concat_tables([pq.read_table(f, filesystem=system) for f in files])
            while len(StoredArrays.kept) > 1:
                StoredArrays.kept.pop(next(iter(StoredArrays.kept)))
            StoredArrays.kept[self.folder] = self.build(table)
        return StoredArrays.kept[self.folder]


def shared_arrays(df: DataFrame, build: Callable[[pa.Table], object], max_bytes: int = JOIN_BYTES):
    """``value`` in every task: ``build`` of the whole table. Above ``max_bytes`` it is not gathered by the driver: tasks write it
    to the shared checkpoint folder and read it there."""
    if is_small(df, max_bytes):
        return df.sparkSession.sparkContext.broadcast(build(df.toArrow()))
    ensure_checkpoint_dir(df.sparkSession)
    base = df.sparkSession.sparkContext.getCheckpointDir()
    folder = f"{base.replace('file:/', 'file:///', 1) if re.match('file:/[^/]', base) else base}/arrays-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return StoredArrays(folder, build)


def skew_join(
    big: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    key_counts: DataFrame,
    count_col: str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """Join ``big`` with ``dim`` (few rows per key); keys with ``hot_rows`` or more rows are salted.

    A hot key gets as many salts as it holds portions of ``hot_rows`` (twice that, or ``salts``). ``key_counts`` holds the number of big-side rows per key. At most rows/hot_rows keys can be
    hot, which bounds the broadcast list by arithmetic.
    """
    on = list(on)
    portions = F.lit(salts) if salts else F.ceil(F.col("__rows") * 2 / hot_rows)
    hot = F.broadcast(
        key_counts.filter(F.col(count_col) >= hot_rows)
        .groupBy(*on)
        .agg(F.max(count_col).alias("__rows"))
        .select(*on, portions.cast("int").alias("__salts"))
    )
    row_hash = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.col("__salts")).cast("int")
    left = big.join(hot, on, "left").withColumn("__salt", F.coalesce(row_hash, F.lit(0))).drop("__salts")
    right = dim.join(hot, on, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts") - 1, F.lit(0))))
    ).drop("__salts")
    return left.join(right, on + ["__salt"], how).drop("__salt")


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    out: str,
    within: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    start: int = 1,
) -> DataFrame:
    """Number rows densely by the (unique) ascending ``order`` columns, per ``within`` group.

    Rows are dealt to range partitions of about ``rows_per_bucket`` rows, which are written once with the number of their
    partition. Rows are numbered inside it, and shifted by a prefix sum over the partitions' counts. So neither the whole
    table nor a hot group meets one task, and no key comes to the driver.
    """
    within, order = list(within), list(order)
    n = df.count()
    if n <= rows_per_bucket:  # one range
        w = Window.partitionBy(*within).orderBy(*order) if within else Window.partitionBy(F.lit(0)).orderBy(*order)
        return df.withColumn(out, (F.row_number().over(w) + (start - 1)).cast("long"))

    ranges = -(-n // rows_per_bucket)
    ranged = cut_lineage(df.repartitionByRange(ranges, *within, *order).withColumn("__range", F.spark_partition_id()))
    sizes = ranged.groupBy(*within, "__range").agg(F.count(F.lit(1)).alias("__n"))
    # a row per range, and per group
    before = Window.partitionBy(*(within or [F.lit(0)])).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"__w{k}") for k, c in enumerate(within)],
        F.col("__range").alias("__r"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
    )
    numbered = ranged.withColumn("__rn", F.row_number().over(Window.partitionBy(*within, "__range").orderBy(*order)))
    same = F.col("__range") == F.col("__r")
    for k, c in enumerate(within):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"__w{k}"))
    joined = numbered.join(offsets if within else F.broadcast(offsets), same)  # without groups, one row per range
    return joined.withColumn(out, (F.col("__rn") + F.col("__off") + (start - 1)).cast("long")).drop(
        "__range", "__rn", "__off", "__r", *[f"__w{k}" for k in range(len(within))]
    )


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Columns of several one-row results in one row, without a join."""
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for r in rows for c in r.columns])
