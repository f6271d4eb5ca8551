"""Grid searches over classifiers whose points share fits, judged by several metrics at once.

A *fit* serves one or more grid points.  Boosting is fitted once with the most rounds: its
first k trees are the model of k rounds, because every round only adds a tree.  A forest
draws its samples for all trees together, so the first trees of a large forest are not the
small forest of the same seed, and forests are fitted per size.  Where every input has at
most ``values`` distinct values, numbers of bins from that on give the same candidate splits
and the same trees, so one fit serves them all.  Perceptrons are fitted per point.

All fits of all folds are scored in one pass over the held-out rows.  Scores collapse to one
row per distinct (model, point, fold, label, score) before any metric is taken, and each
metric is an aggregate over that table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators import metrics
from larkspur.operators.durable import cut, shared_dir
from larkspur.plans import classify
from larkspur.plans.experiments import in_parallel

POINT_SCHEMA = "model string, point int, settings string"


@dataclass(frozen=True)
class Point:
    """One setting of a model's grid; ``number`` is its place in the grid."""

    model: str
    number: int
    settings: Mapping[str, object]

    def text(self) -> str:
        """Settings by name, as one string."""
        return ";".join(f"{k}={self.settings[k]}" for k in sorted(self.settings))


@dataclass(frozen=True)
class Fit:
    """An estimator and the grid points its model serves."""

    estimator: Estimator
    points: Sequence[Point]

    def scored(self, model: Model, rows: DataFrame, name: str) -> tuple[DataFrame, list[Column]]:
        """Rows with the model's scores, and per point a struct (score, prediction)."""
        if self.points[0].model == "boosting":
            return _prefix_scores(model, rows, [int(p.settings["maxIter"]) for p in self.points], name)
        raw, prediction = f"{name}_raw", f"{name}_prediction"
        model.setRawPredictionCol(raw).setPredictionCol(prediction).setProbabilityCol("")
        found = model.transform(rows).withColumn(raw, vector_to_array(raw)[1])
        own = F.struct(F.col(raw).alias("score"), F.col(prediction).alias("prediction"))
        return found, [own] * len(self.points)


def _prefix_scores(
    model: Model, rows: DataFrame, sizes: Sequence[int], name: str
) -> tuple[DataFrame, list[Column]]:
    """Margins of the first trees of a boosted model, for every wanted number of trees."""
    margins: dict[int, Column] = {}
    total = F.lit(0.0)
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights)):
        column = f"{name}_tree{i}"
        rows = tree.setPredictionCol(column).transform(rows)
        total = total + F.lit(float(weight)) * F.col(column)
        margins[i + 1] = total
    own = [margins[k] for k in sizes]
    positive = [F.when(m > 0, 1.0).otherwise(0.0) for m in own]
    return rows, [F.struct(m.alias("score"), p.alias("prediction")) for m, p in zip(own, positive)]


def forest_points() -> list[Point]:
    return _points(
        "forest",
        {"maxDepth": classify.TREE_DEPTHS, "maxBins": classify.TREE_BINS, "numTrees": classify.FOREST_SIZES},
    )


def boosting_points() -> list[Point]:
    return _points(
        "boosting",
        {"maxDepth": classify.TREE_DEPTHS, "maxBins": classify.TREE_BINS, "maxIter": classify.BOOSTING_ROUNDS},
    )


def perceptron_points(inputs: int) -> list[Point]:
    return _points(
        "perceptron",
        {
            "blockSize": classify.PERCEPTRON_BLOCKS,
            "layers": [[inputs, *hidden, 2] for hidden in classify.PERCEPTRON_LAYERS],
            "maxIter": classify.PERCEPTRON_ITERATIONS,
        },
    )


def _points(model: str, values: Mapping[str, Sequence]) -> list[Point]:
    """Every combination of the values, the last name varying fastest."""
    combined: list[dict] = [{}]
    for name, options in values.items():
        combined = [{**c, name: option} for c in combined for option in options]
    return [Point(model, i, c) for i, c in enumerate(combined)]


def fits(points: Sequence[Point], values: int | None = None) -> list[Fit]:
    """As few fits as serve all points; ``values`` bounds the distinct values of any input."""
    shared: dict[tuple, list[Point]] = {}
    for point in points:
        settings = dict(point.settings)
        if point.model == "perceptron":
            key = (point.number,)
        else:
            bins = settings["maxBins"]
            alike = "enough" if values is not None and bins >= values else bins
            key = (settings["maxDepth"], alike, settings.get("numTrees"))
        shared.setdefault((point.model, *key), []).append(point)
    return [Fit(_estimator(own), own) for own in shared.values()]


def _estimator(points: Sequence[Point]) -> Estimator:
    """An estimator whose model serves all the points."""
    settings = dict(points[0].settings)
    if points[0].model == "forest":
        return classify.forest(**settings)
    if points[0].model == "boosting":
        settings["maxIter"] = max(int(p.settings["maxIter"]) for p in points)
        return classify.boosting(**settings)
    layers = settings.pop("layers")
    return classify.perceptron(layers[0], layers[1:-1], **settings)


def _histogram(rows: DataFrame, fitted: Sequence[tuple[Fit, Model]], label: str) -> DataFrame:
    """(model, point, label, score, prediction, n) of all points, from one pass over the rows."""
    cells: list[Column] = []
    wide = rows
    for i, (fit, model) in enumerate(fitted):
        wide, structs = fit.scored(model, wide, f"f{i}")
        for point, cell in zip(fit.points, structs):
            cells.append(
                F.struct(
                    F.lit(point.model).alias("model"), F.lit(point.number).alias("point"),
                    cell["score"].alias("score"), cell["prediction"].alias("prediction"),
                )
            )
    long = wide.select(F.col(label).alias("label"), F.inline(F.array(*cells)))
    keys = ["model", "point", "label", "score", "prediction"]
    return long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def scored_search(
    rows: DataFrame,
    points: Sequence[Point],
    label: str,
    folds: int,
    fold_col: str = "fold",
    values: int | None = None,
    parallelism: int = 8,
) -> DataFrame:
    """Stored score levels of every point on every held-out fold: ``_histogram`` with ``fold``.

    ``rows`` carry their fold and a feature vector.  Every fit is a task of its own.
    """
    spark = rows.sparkSession
    shared_dir(spark)
    held = [rows.filter(F.col(fold_col) == i) for i in range(folds)]
    others = [rows.filter(F.col(fold_col) != i) for i in range(folds)]
    wanted = fits(points, values)

    def task(fold: int, fit: Fit) -> Callable:
        return lambda: fit.estimator.fit(others[fold])

    # the longest fits first, so that none of them is left to the end
    work = sorted(((f, k) for f in range(folds) for k in range(len(wanted))), key=lambda w: -_effort(wanted[w[1]]))
    models = in_parallel(spark, [task(f, wanted[k]) for f, k in work], parallelism)
    by_fold: list[list] = [[None] * len(wanted) for _ in range(folds)]
    for (fold, k), model in zip(work, models):
        by_fold[fold][k] = (wanted[k], model)
    parts = [
        _histogram(held[i], by_fold[i], label).withColumn("fold", F.lit(i)) for i in range(folds)
    ]
    return cut(reduce(DataFrame.unionByName, parts))


def _effort(fit: Fit) -> float:
    """Rough relative cost of a fit."""
    settings = fit.points[-1].settings
    return float(settings.get("numTrees", settings.get("maxIter", 1))) * float(settings.get("maxDepth", 1))


def fold_scores(levels: DataFrame, by: Sequence[str] = ("model", "point", "fold")) -> DataFrame:
    """(by, metric, value): accuracy and exact AUC from score levels."""
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    accuracy = levels.groupBy(*by).agg((hits / F.sum("n")).alias("value"))
    area = metrics.area_by_group(levels, list(by), "label", "score", "n")
    return accuracy.select(*by, F.lit("accuracy").alias("metric"), "value").unionByName(
        area.select(*by, F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    )


def search_table(levels: DataFrame, points: Sequence[Point]) -> DataFrame:
    """One row per point and metric: settings, mean and deviation over the folds."""
    scores = fold_scores(levels)
    means = scores.groupBy("model", "point", "metric").agg(
        F.avg("value").alias("mean_metric"), F.stddev_pop("value").alias("std_metric")
    )
    named = [(p.model, p.number, p.text()) for p in points]
    settings = levels.sparkSession.createDataFrame(named, POINT_SCHEMA)
    return settings.join(means, ["model", "point"])


def winners(table: DataFrame, smaller_is_better: Sequence[str] = ("rmse",)) -> DataFrame:
    """The best point of every (model, metric); of equal ones, the first of the grid."""
    signed = F.when(F.col("metric").isin(*smaller_is_better), -F.col("mean_metric")).otherwise(F.col("mean_metric"))
    best = F.max_by(F.struct("point", "settings", "mean_metric"), F.struct(signed, -F.col("point")))
    return table.groupBy("model", "metric").agg(best.alias("best")).select("model", "metric", "best.*")


def test_scores(
    chosen: DataFrame,
    points: Sequence[Point],
    train: DataFrame,
    test: DataFrame,
    label: str,
    parallelism: int = 8,
) -> DataFrame:
    """Winners refitted on all training rows and scored on the test rows by their metric.

    There is one winner per model and metric, so they are few whatever the grids and the data.
    """
    spark = train.sparkSession
    by_place = {(p.model, p.number): p for p in points}
    rows = chosen.collect()
    wanted = sorted({(r.model, r.point) for r in rows})
    # one fit per winner: the setting itself is refitted, not a prefix of a longer fit
    single = [fits([by_place[w]])[0] for w in wanted]
    models = in_parallel(spark, [lambda f=f: f.estimator.fit(train) for f in single], parallelism)
    levels = cut(_histogram(test, list(zip(single, models)), label))
    scores = fold_scores(levels, ("model", "point")).withColumnRenamed("value", "test_score")
    kept = chosen.join(scores, ["model", "point", "metric"])
    return kept.select("model", "metric", "point", "settings", "mean_metric", "test_score")
