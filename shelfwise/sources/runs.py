"""Run-partitioned tables: write a result under (env, run_id), find it again, list runs.

``runs(run_id, env, run_ts, step, source_run_id, taxonomy_version)`` is the registry kept next to the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import text as tx


def newest(kind: str = "run_id") -> Column:
    """Newest run by time, then id."""
    return F.max_by(kind, F.struct("run_ts", "run_id"))


def latest_run(runs: DataFrame, env: str, keys: list[str] = ["step"]) -> DataFrame:
    """Newest run of an environment per key, else the newest of all."""
    match = F.col("env") == env if env else F.lit(True)
    order = F.when(match, F.struct("run_ts", "run_id"))
    return runs.groupBy(*keys).agg(
        F.max_by(F.when(match, F.col("run_id")), order).alias("own"), newest().alias("any")
    ).select(*keys, F.lit(env).alias("env"), F.coalesce("own", "any").alias("run_id"))


def latest_for_source(runs: DataFrame, keys: list[str] = ["step"]) -> DataFrame:
    """Newest run made from each source run."""
    return runs.groupBy(*keys, "source_run_id").agg(newest().alias("run_id"))


def require_source(runs: DataFrame, run_id: str, source_run_id: str) -> None:
    """Refuse a decision set that was made from another input."""
    if runs.filter((F.col("run_id") == run_id) & (F.col("source_run_id") == source_run_id)).isEmpty():
        raise ValueError(f"run {run_id} was not made from {source_run_id}")


def latest_pair(runs: DataFrame, first: str, second: str) -> DataFrame:
    """Newest source that has a run of both steps, with the newest run of each."""
    sides = (
        runs.filter(F.col("step").isin(first, second))
        .groupBy("source_run_id")
        .agg(
            F.max_by(F.when(F.col("step") == first, F.col("run_id")), F.when(F.col("step") == first, F.struct("run_ts", "run_id"))).alias("first_run"),
            F.max_by(F.when(F.col("step") == second, F.col("run_id")), F.when(F.col("step") == second, F.struct("run_ts", "run_id"))).alias("second_run"),
            F.max("run_ts").alias("run_ts"),
        )
        .filter("first_run IS NOT NULL AND second_run IS NOT NULL")
    )
    return sides.agg(F.max_by(F.struct("source_run_id", "first_run", "second_run"), F.struct("run_ts", "source_run_id")).alias("r")).select("r.*")


def run_list(runs: DataFrame, rows: DataFrame) -> DataFrame:
    """Runs with their row counts, newest first; the newest is the default."""
    counts = rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_items"))
    top = runs.agg(newest().alias("run_id")).withColumn("is_default", F.lit(True))
    return (
        runs.join(counts, "run_id", "left")
        .join(F.broadcast(top), "run_id", "left")
        .select("run_id", "env", "run_ts", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("is_default", F.lit(False)).alias("is_default"))
        .orderBy(F.desc("run_ts"), F.desc("run_id"))
    )


def taxonomy_of_run(runs: DataFrame, default: str) -> DataFrame:
    """Tree version recorded with a run, else the default."""
    return runs.select("run_id", F.coalesce(F.nullif(tx.strip(F.col("taxonomy_version")), F.lit("")), F.lit(default)).alias("taxonomy_version"))


def input_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """16 hex digits over path, size and change time of every input file; one row per file, contents are not read."""
    meta = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("file_modification_time")
    )
    return meta.select(
        "file_path", "file_size",
        F.left(F.sha2(F.concat_ws("|", "file_path", "file_size", "file_modification_time"), 256), F.lit(16)).alias("fingerprint"),
    )


def write_run(df: DataFrame, base: str, table: str, env: str, run_id: str, fmt: str = "parquet", by: tuple[str, ...] = ()) -> None:
    """One table of a run; ``by`` adds partition columns (one folder per category, for example).

    Writing a run again replaces it: only the partitions that are written change.
    """
    tagged = df.withColumn("env", F.lit(env or "unset")).withColumn("run_id", F.lit(run_id))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("env", "run_id", *by).format(fmt).save(f"{base}/{table}")


def write_summary(spark: SparkSession, base: str, env: str, run_id: str, step: str, counts: DataFrame, **extra: str) -> None:
    """Run summary: a one-row ``counts`` table stored as name/value rows."""
    names = counts.columns
    flat = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in names])))
    for k, v in extra.items():
        flat = flat.unionByName(spark.createDataFrame([(k, v)], "name string, value string"))
    write_run(flat.withColumn("step", F.lit(step)), base, "run_summary", env, run_id, by=("step",))


def read_run(spark: SparkSession, base: str, table: str, env: str, run_id: str) -> DataFrame:
    """A run's table; partition pruning leaves only its folder."""
    return spark.read.parquet(f"{base}/{table}").filter((F.col("env") == (env or "unset")) & (F.col("run_id") == run_id)).drop("env", "run_id")


def publish_bundle(base: str, env: str, run_id: str, **tables: DataFrame) -> None:
    """Attributes, tree and matched rows of one result under one run."""
    for name, df in tables.items():
        write_run(df, base, name, env, run_id)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
