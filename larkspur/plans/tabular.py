"""Tabular models: flags in, generalised linear models out.

Flags repeat.  However many encounters there are, rows that agree in all flags,
label and fold can be counted once and fitted with that count as weight; the
likelihood is the same sum.  A grid search then makes its many passes over the
distinct combinations instead of the raw rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.columns import binary_label, flag_mask, flags, unmasked
from larkspur.operators.durable import cut
from larkspur.plans.experiments import in_parallel

# Search grids, iterations and seed of the published analysis.
REG_PARAMS = [0.001, 0.01, 0.1, 1, 10, 100]
ELASTIC_NET_PARAMS = [0, 0.2, 0.5, 0.8, 1]
MAX_ITERATIONS = 50
SEED = 66896
FOLDS = 3

WEIGHT = "n_rows"
FEATURES = "features"
#: Parts of the stored combinations that every iteration of a fit reads.
FIT_PARTS = 8


def encode(
    rows: DataFrame,
    off_values: Mapping[str, str],
    outcome: str,
    negative: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Flags and a 0.0/1.0 ``label`` from text columns, in a single select."""
    label = binary_label(F.col(outcome), negative).alias("label")
    return rows.select(*flags(off_values), label, *keep)


def collapse(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns`` with the number of rows behind each."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(WEIGHT))


def collapse_flags(rows: DataFrame, names: Sequence[str], others: Sequence[str] = ()) -> DataFrame:
    """Distinct combinations of 0/1 ``names`` and ``others`` with the rows behind each.

    All flags travel as one long: the key of the shuffle is 8 bytes however many flags
    there are.
    """
    masked = rows.select(flag_mask(names).alias("_mask"), *others)
    counted = collapse(masked, ["_mask", *others])
    return counted.select(*unmasked(F.col("_mask"), names), *others, WEIGHT)


def compact(collapsed: DataFrame, parts: int = FIT_PARTS) -> DataFrame:
    """Collapsed rows stored once, in a fixed number of parts and in one order.

    Each iteration of a fit is a job over these parts, so combinations should not be spread
    over hundreds of tasks; raise ``parts`` with their number.  Sums over rows run in the
    same order whatever the cluster, so the fit is the same everywhere.
    """
    keys = collapsed.columns
    return cut(collapsed.repartition(parts, *keys).sortWithinPartitions(*keys))


def assemble(rows: DataFrame, inputs: Sequence[str], output: str = FEATURES) -> DataFrame:
    """Input columns gathered into one feature vector."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output).transform(rows)


def sample_scale(collapsed: DataFrame, inputs: Sequence[str]) -> dict[str, float]:
    """Sample standard deviation of each input over the rows behind ``collapsed``."""
    n = F.sum(WEIGHT)
    spread = []
    for c in inputs:
        total = F.sum(F.col(c) * F.col(WEIGHT))
        squares = F.sum(F.col(c) * F.col(c) * F.col(WEIGHT))
        variance = (squares - total * total / n) / (n - 1)
        spread.append(F.sqrt(F.greatest(variance, F.lit(0.0))).alias(c))
    return collapsed.agg(*spread).first().asDict()


def scale(rows: DataFrame, inputs: Sequence[str], scales: Mapping[str, float]) -> DataFrame:
    """Inputs divided by their scale; an input that never varies becomes 0."""
    scaled = [
        (F.col(c) / F.lit(scales[c]) if scales[c] else F.lit(0.0)).alias(c) for c in inputs
    ]
    return rows.select(*scaled, *[c for c in rows.columns if c not in inputs])


def poisson_model(
    label: str, reg_param: float = 0.0, weight: str | None = WEIGHT
) -> GeneralizedLinearRegression:
    model = GeneralizedLinearRegression(
        family="poisson",
        link="log",
        featuresCol=FEATURES,
        labelCol=label,
        maxIter=MAX_ITERATIONS,
        regParam=reg_param,
    )
    return model.setWeightCol(weight) if weight else model


def logistic_model(
    label: str,
    reg_param: float = 0.0,
    elastic_net: float = 0.0,
    weight: str | None = WEIGHT,
) -> LogisticRegression:
    """Logistic regression for inputs that went through ``scale``.

    Spark's own standardisation works with a weighted deviation that depends on
    how rows were collapsed; scaling by the deviation of the raw rows and
    penalising the scaled coefficients gives the fit of the raw rows.
    """
    model = LogisticRegression(
        featuresCol=FEATURES,
        labelCol=label,
        maxIter=MAX_ITERATIONS,
        regParam=reg_param,
        elasticNetParam=elastic_net,
        standardization=False,
    )
    return model.setWeightCol(weight) if weight else model


def grid(values: Mapping[Param, Sequence]) -> list[dict]:
    """All combinations of parameter values."""
    builder = ParamGridBuilder()
    for param, options in values.items():
        builder = builder.addGrid(param, list(options))
    return builder.build()


def grid_search(
    estimator: Estimator,
    settings: list[dict],
    evaluator: Evaluator,
    rows: DataFrame,
    folds: int = FOLDS,
    fold_col: str = "fold",
    parallelism: int = 4,
    keep_models: bool = False,
) -> CrossValidatorModel:
    """Cross-validated search over rows that carry their fold.

    Every fold and grid point is a task of its own with its own copy of the session's
    local properties; concurrent fits that share one copy can clear each other's entries.
    """
    spark, sides = rows.sparkSession, []
    for i in range(folds):
        held = F.col(fold_col) == i
        sides.append((rows.filter(~held), rows.filter(held)))

    def task(train: DataFrame, test: DataFrame, setting: dict) -> Callable:
        def fit_and_score():
            model = estimator.fit(train, setting)
            return evaluator.evaluate(model.transform(test)), model if keep_models else None

        return fit_and_score

    tasks = [task(train, test, setting) for train, test in sides for setting in settings]
    results = in_parallel(spark, tasks, parallelism)
    metrics = np.array([metric for metric, _ in results]).reshape(folds, len(settings))
    means = metrics.mean(axis=0)
    best = int(means.argmax() if evaluator.isLargerBetter() else means.argmin())
    models = [m for _, m in results]
    kept = [models[i : i + len(settings)] for i in range(0, len(models), len(settings))]
    searched = CrossValidatorModel(
        estimator.fit(rows, settings[best]),
        means.tolist(),
        kept if keep_models else None,
        metrics.std(axis=0).tolist(),
    )
    searched.set(searched.estimatorParamMaps, settings)
    return searched


def optimality(
    rows: DataFrame,
    model: Model,
    inputs: Sequence[str],
    label: str,
    prediction: Column,
    reg_param: float,
    elastic_net: float = 0.0,
    per_unit_mean: bool = False,
    weight: str = WEIGHT,
) -> DataFrame:
    """How far each coefficient is from the optimum of its penalised likelihood.

    At the optimum the weighted gradient of the likelihood plus the L2 part of the penalty
    lies within the L1 part: equal to it, against the coefficient's sign, where the
    coefficient is not zero.  ``residual`` is what is left over, of the penalty as given
    here, whatever penalty the model was fitted with.  ``rows`` hold the inputs as fitted
    and the counts behind them.  ``per_unit_mean`` divides by the summed prediction
    instead of the row count, the scale of a Poisson model's penalty.
    Columns: feature, coefficient, residual, n_rows.
    """
    scored = model.transform(rows).select(
        *inputs, F.col(weight).alias("_n"), F.col(label).alias("_y"), prediction.alias("_p")
    )
    scale = F.sum(F.col("_n") * F.col("_p")) if per_unit_mean else F.sum("_n")
    error = F.col("_n") * (F.col("_p") - F.col("_y"))
    cells = []
    for name, value in zip(inputs, model.coefficients):
        gradient = F.sum(error * F.col(name)) / scale
        smooth = gradient + F.lit(reg_param * (1 - elastic_net) * float(value))
        bound = reg_param * elastic_net
        if value:
            residual = F.abs(smooth + F.lit(bound * (1.0 if value > 0 else -1.0)))
        else:
            residual = F.greatest(F.abs(smooth) - F.lit(bound), F.lit(0.0))
        cells.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.lit(float(value)).alias("coefficient"),
                residual.alias("residual"),
                F.sum("_n").alias("n_rows"),
            )
        )
    return scored.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def setting_values(setting: Mapping[Param, object]) -> dict[str, str]:
    return {param.name: str(value) for param, value in setting.items()}


def search_table(rows: DataFrame, fitted: CrossValidatorModel) -> DataFrame:
    """One row per grid point: its parameters, metric mean and deviation over folds."""
    names = sorted(p.name for p in fitted.getEstimatorParamMaps()[0])
    points = []
    for setting, mean, std in zip(
        fitted.getEstimatorParamMaps(), fitted.avgMetrics, fitted.stdMetrics
    ):
        values = setting_values(setting)
        points.append((*[values[n] for n in names], float(mean), float(std)))
    columns = ", ".join(f"{n} string" for n in names)
    return rows.sparkSession.createDataFrame(
        points, f"{columns}, mean_metric double, std_metric double"
    )


def best_point(search: DataFrame, larger_is_better: bool) -> DataFrame:
    """The winning row of a search table."""
    metric = F.col("mean_metric")
    names = [c for c in search.columns if not c.endswith("_metric")]
    return search.orderBy(metric.desc() if larger_is_better else metric.asc(), *names).limit(1)


def validation_curve(search: DataFrame, x: str, series: str | None = None) -> DataFrame:
    """The points of a search as one curve per ``series``: x, mean and deviation."""
    name = F.col(series) if series else F.lit(None)
    return search.select(
        name.cast("double").alias("series"),
        F.col(x).cast("double").alias("x"),
        F.col("mean_metric").alias("mean"),
        F.col("std_metric").alias("std"),
    )
