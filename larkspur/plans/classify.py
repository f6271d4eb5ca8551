"""Binary classifiers over bit vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.columns import signed_label, strings_to_double

# Seed, chosen settings and search grids of the published analysis.
SEED = 66896
FOREST = {"maxDepth": 7, "maxBins": 16, "numTrees": 5}
BOOSTING = {"maxDepth": 5, "maxBins": 16, "maxIter": 5}
PERCEPTRON = {"blockSize": 32, "maxIter": 50}
PERCEPTRON_HIDDEN = [15, 8]
TREE = {"maxDepth": 10, "impurity": "entropy"}
TREE_DEPTHS = [3, 5, 7]
TREE_BINS = [16, 32, 64]
FOREST_SIZES = [5, 20, 50]
BOOSTING_ROUNDS = [3, 5, 7]
PERCEPTRON_BLOCKS = [32, 64, 128]
PERCEPTRON_LAYERS = [[10], [15, 8]]
PERCEPTRON_ITERATIONS = [20, 50, 100]

FEATURES = "features"
LABEL = "labels"


def typed_vectors(raw: DataFrame, label: str) -> DataFrame:
    """Text bits to doubles and a -1/1 label to 0.0/1.0, in one select."""
    labelled = raw.select(
        *[c for c in raw.columns if c != label], signed_label(F.col(label)).alias(LABEL)
    )
    return labelled.select(*strings_to_double(labelled))


def with_features(rows: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """The inputs as one vector, assembled once for all models."""
    keep = [c for c in rows.columns if c not in inputs]
    assembled = VectorAssembler(inputCols=list(inputs), outputCol=FEATURES).transform(rows)
    return assembled.select(*keep, FEATURES)


def labelled_vectors(rows: DataFrame, label: str) -> DataFrame:
    """Rows that already hold a feature vector, with the label as 0.0/1.0."""
    keep = [c for c in rows.columns if c != label]
    return rows.select(*keep, signed_label(F.col(label)).alias(LABEL))


def forest(seed: int = SEED, **settings) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, seed=seed, **{**FOREST, **settings}
    )


def boosting(seed: int = SEED, **settings) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=LABEL, seed=seed, **{**BOOSTING, **settings}
    )


def perceptron(
    inputs: int, hidden: Sequence[int] = PERCEPTRON_HIDDEN, seed: int = SEED, **settings
) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        layers=[inputs, *hidden, 2],
        seed=seed,
        **{**PERCEPTRON, **settings},
    )


def tree(**settings) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        featuresCol=FEATURES, labelCol=LABEL, seed=SEED, **{**TREE, **settings}
    )


def curve_models(inputs: int) -> dict[str, Estimator]:
    """The three compared models under the names of the learning curve."""
    return {"RF": forest(), "GBT": boosting(), "MPC": perceptron(inputs)}


def pipeline(inputs: Sequence[str], estimator: Estimator) -> Pipeline:
    """Assembler and estimator as one stage list, for rows of plain columns."""
    return Pipeline(
        stages=[VectorAssembler(inputCols=list(inputs), outputCol=FEATURES), estimator]
    )


def importances(rows: DataFrame, model: Model, inputs: Sequence[str]) -> DataFrame:
    """Importance of every input of a fitted tree model, zeros included."""
    weights = model.featureImportances.toArray()
    table = [(i, name, float(weights[i])) for i, name in enumerate(inputs)]
    return rows.sparkSession.createDataFrame(
        table, "position int, feature string, importance double"
    )
