"""Experiment grids and learning curves."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.hashing import hash_share, in_fraction, threshold
from larkspur.operators import metrics
from larkspur.operators.layout import spread

# The models and data sizes of the learning curve, and the
# values an experiment starts from.
MODELS = ["RF", "GBT", "MPC"]
SIZES = [0.05, 0.1, 0.3, 0.5, 0.7, 0.8, 0.9, 1.0]
INITIAL_RUNTIME = 1800.0
INITIAL_METRIC = 0.0

CURVE_SCHEMA = (
    "model string, datasize double, n_rows long, runtime double, runtime_min double, "
    "accuracy double, auc double"
)


def every_setting(subjects: DataFrame, grid: Mapping[str, Sequence]) -> DataFrame:
    """One row per subject and combination of grid values.

    The grid lists unfold row by row, so there is no product of two tables.
    """
    rows = subjects
    for name, values in grid.items():
        rows = rows.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return rows


def experiment_grid(models: DataFrame, sizes: Sequence[float] = SIZES) -> DataFrame:
    """An experiment log to start from: every model and size with initial values."""
    return every_setting(models, {"datasize": list(sizes)}).select(
        "*",
        F.lit(INITIAL_RUNTIME).alias("runtime"),
        F.lit(INITIAL_METRIC).alias("accuracy"),
        F.lit(INITIAL_METRIC).alias("auc"),
    )


def in_parallel(spark: SparkSession, tasks: Sequence[Callable], parallelism: int) -> list:
    """Results of independent driver calls, each of which submits Spark jobs."""
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks)


def sample_sizes(
    rows: DataFrame, keys: list[str], seed: int, sizes: Sequence[float] = SIZES
) -> DataFrame:
    """Rows in the sample of each size: one pass, whatever the number of sizes.

    Samples are nested, so a row belongs to the smallest size that reaches it
    and to all larger ones.
    """
    counts = rows.agg(
        *[F.count_if(in_fraction(keys, seed, s)).alias(f"s{i}") for i, s in enumerate(sizes)]
    )
    cells = [
        F.struct(F.lit(float(s)).alias("datasize"), F.col(f"s{i}").alias("n_rows"))
        for i, s in enumerate(sizes)
    ]
    return counts.select(F.inline(F.array(*cells)))


def held_out_scores(model: Model, rows: DataFrame, label: str) -> tuple[float, float]:
    """Accuracy and exact AUC of a model from one scoring of ``rows``.

    Scored rows collapse to counts of (label, prediction, score) where they are; both metrics are
    taken over these, since each of them would score all rows again.
    """
    raw = "rawPrediction"
    scored = model.transform(rows).select(label, "prediction", vector_to_array(raw)[1].alias(raw))
    levels = metrics.collapsed(scored, [label, "prediction", raw]).persist()
    try:
        share = levels.agg(metrics.accuracy(label, "prediction", "n")).first()[0]
        return share, metrics.area_under_roc(levels, label, raw, "n")
    finally:
        levels.unpersist()


def learning_curve(
    train: DataFrame,
    test: DataFrame,
    models: Mapping[str, Estimator],
    keys: list[str],
    label: str,
    seed: int,
    sizes: Sequence[float] = SIZES,
    parallelism: int = 1,
    expand: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    unstored: Sequence[str] = (),
) -> DataFrame:
    """Model x data size: rows, seconds, minutes, accuracy and AUC on ``test``.

    ``train`` and ``test`` are kept in memory and disk while the models are fitted;
    every sample is a filter over the stored place of a row.  ``expand`` turns stored
    rows into rows with features when they are read, and ``unstored`` columns are left out
    once the rows are placed, so that what is kept is as small as the rows allow.
    One fit runs at a time: fits that share the cores would slow each other down, and
    the ``runtime`` column would say so.
    """
    numbered = placed(train, keys, seed).drop(*unstored).persist()
    held_out = spread(test, keys).drop(*unstored).persist()
    try:
        points = curve_points(numbered, held_out, models, label, sizes, parallelism, expand)
    finally:
        numbered.unpersist()
        held_out.unpersist()
    return train.sparkSession.createDataFrame(points, CURVE_SCHEMA)


def placed(rows: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Rows dealt out by their key, with their place among the samples of ``seed``."""
    return spread(rows, keys).select("*", hash_share(keys, seed).alias("_place"))


def curve_points(
    numbered: DataFrame,
    held_out: DataFrame,
    models: Mapping[str, Estimator],
    label: str,
    sizes: Sequence[float] = SIZES,
    parallelism: int = 1,
    expand: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> list[tuple]:
    """The rows of ``learning_curve`` over stored rows, the training rows ``placed``."""
    fitted_on, scored_on = expand(numbered), expand(held_out)

    def point(name: str, size: float) -> Callable[[], tuple]:
        def run() -> tuple:
            start = time.perf_counter()
            reached = F.col("_place") < threshold(size)
            model = models[name].fit(fitted_on.filter(reached))
            share, area = held_out_scores(model, scored_on, label)
            seconds = time.perf_counter() - start
            return name, float(size), numbered.filter(reached).count(), seconds, seconds / 60, share, area

        return run

    points = [point(name, size) for name in models for size in sizes]
    return in_parallel(numbered.sparkSession, points, parallelism)
