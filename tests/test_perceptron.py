"""Perceptrons over packed rows, and the stored vectors that the fits of a curve read."""

import numpy as np
import pytest
from conftest import SMALL
from larkspur.operators import durable
from larkspur.plans import classify, experiments, perceptron
from larkspur.registry import models
from larkspur.sources import standins
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def words(spark):
    """Packed rows in one part, as many as fill the blocks of Spark's trainer."""
    pairs = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, (640, 2)).tolist()
    ones = [[(w % 2**64).bit_count() for w in pair] for pair in pairs]
    rows = [(*pair, float(a > b)) for pair, (a, b) in zip(pairs, ones)]
    return spark.createDataFrame(rows, f"high long, low long, {classify.LABEL} double").coalesce(1).cache()


@pytest.mark.parametrize("iterations", [1, 20])
def test_packed_rows_give_the_weights_of_spark(words, iterations):
    estimator = classify.perceptron(standins.CHALLENGE_BITS, maxIter=iterations)
    want = estimator.fit(standins.unpacked(words)).weights.toArray()
    model = perceptron.PackedPerceptron(estimator, standins.WORDS).fit(words)
    assert np.allclose(model.weights.toArray(), want, rtol=0, atol=1e-6)
    assert {"prediction", "rawPrediction"} <= set(model.transform(standins.unpacked(words)).columns)


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(5)
    layers = [6, 4, 3, 2]
    inputs, classes = rng.integers(0, 2, (9, 6)).astype(float), rng.integers(0, 2, 9)
    weights = rng.normal(size=sum((a + 1) * b for a, b in zip(layers, layers[1:])))
    _, gradient = perceptron.loss_and_gradient(inputs, classes, weights, layers)
    for i in range(len(weights)):
        step = np.zeros_like(weights)
        step[i] = 1e-6
        up, down = (perceptron.loss_and_gradient(inputs, classes, weights + s, layers)[0] for s in (step, -step))
        assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


@pytest.mark.parametrize(("label", "said"), [(None, "null"), (2.0, "whole numbers below 2"), (0.5, "whole numbers")])
def test_labels_that_are_no_class_are_refused(spark, label, said):
    rows = spark.createDataFrame([(1, 2, 0.0), (3, 4, label)], f"high long, low long, {classify.LABEL} double")
    fit = perceptron.PackedPerceptron(classify.perceptron(standins.CHALLENGE_BITS), standins.WORDS)
    with pytest.raises(Exception, match=said):
        fit.fit(rows)


def test_stored_parts_are_read_as_written(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        stored = durable.stored_parts(spark.range(1000).repartition(37, "id"))
        assert stored.rdd.getNumPartitions() == 37
        assert stored.sparkSession.conf.get("spark.sql.shuffle.partitions") == "5"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    part = F.spark_partition_id().alias("part")
    assert stored.select("id", part).groupBy("part").count().count() == 37
    assert stored.agg(F.sum("id")).first()[0] == 499500


def test_quality_reads_stored_vectors_and_fits_one_model_at_a_time(spark, monkeypatch):
    seen, plain = {}, experiments.curve_points

    def noted(train, test, fitted, *args, parallelism=1, **settings):
        seen.update(plan=train._jdf.queryExecution().optimizedPlan().toString(), n=parallelism, fitted=fitted)
        few = {"DT": classify.tree(maxDepth=2)}
        return plain(train, test, few, *args, parallelism=parallelism, **settings)

    monkeypatch.setattr(experiments, "curve_points", noted)
    found = models.QUERIES["clf_quality"](spark, SMALL).first()
    assert "UDF" not in seen["plan"] and "shiftright" not in seen["plan"] and "parquet" in seen["plan"].lower()
    assert seen["n"] == 1 and isinstance(seen["fitted"]["MPC"], perceptron.PackedPerceptron)
    train, test = models.packed_sides(spark, SMALL)
    assert (found.n_train, found.n_test) == (train.count(), test.count())


def test_few_rows_are_fitted_in_few_parts(spark, monkeypatch):
    """Every pass starts a Python task per part, which takes longer than the work on a few thousand rows."""
    seen, plain = [], perceptron.minimise

    def noted(loss, start, *args):
        parts = next(c.cell_contents for c in loss.__closure__ if hasattr(c.cell_contents, "getNumPartitions"))
        seen.append(parts.getNumPartitions())
        return plain(loss, start, *args)

    monkeypatch.setattr(perceptron, "minimise", noted)
    rows = spark.range(300).select(
        F.xxhash64("id").alias("high"), F.xxhash64(F.col("id") + 1).alias("low"), (F.col("id") % 2).cast("double").alias(classify.LABEL)
    ).repartition(40)
    fit = perceptron.PackedPerceptron(classify.perceptron(standins.CHALLENGE_BITS, maxIter=2), standins.WORDS)
    few = fit.fit(rows).weights.toArray()
    monkeypatch.setattr(perceptron, "PART_ROWS", 100)
    three = fit.fit(rows).weights.toArray()
    monkeypatch.setattr(perceptron, "PART_ROWS", 1)
    fit.fit(rows)
    assert seen == [1, 3, perceptron.PARTS]
    assert three == pytest.approx(few, abs=1e-9)
