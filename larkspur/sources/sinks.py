"""Where results go."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.sets import latest_per_key


def append_results(rows: DataFrame, path: str) -> None:
    """Add result rows; jobs append side by side and never rewrite each other's files."""
    rows.write.mode("append").parquet(path)


def log_run(rows: DataFrame, path: str, run: str, attempt: int = 0) -> None:
    """Write the results of one run; the same run and attempt written again replaces itself.

    Every (run, attempt) is a partition folder of its own.  A job that is repeated after a
    failure either rewrites its folder or writes the next attempt, so nothing is counted
    twice, and runs side by side never touch each other's files.
    """
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}/attempt={int(attempt)}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Result rows with ``run`` and ``attempt``: of each run, its last attempt."""
    rows = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/run=*/attempt=*")
    rows = rows.withColumn("run", F.col("run").cast("string"))
    last = rows.groupBy("run").agg(F.max("attempt").alias("_last"))
    return rows.join(last, "run").where(F.col("attempt") == F.col("_last")).drop("_last")


def compact_runs(
    spark: SparkSession, path: str, target: str, keys: list[str], order: list[str]
) -> DataFrame:
    """One row per key over all runs, the last by ``order``, stored under ``target``.

    The log itself is left as it is, so a compaction that fails can be repeated.
    """
    rows = read_runs(spark, path)
    values = [c for c in rows.columns if c not in keys]
    latest_per_key(rows, keys, order, values).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def write_csv(rows: DataFrame, path: str) -> None:
    """Small result table as CSV with header."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def save_model(model: MLWritable, path: str) -> str:
    """Store a fitted model, replacing what the path holds."""
    model.write().overwrite().save(path)
    return path
