"""Model plans: equivalences, invariants and quality on learnable data."""

import math
import random

import pytest
from __spark_entry__ import queries
from conftest import SMALL
from larkspur.plans import classify, experiments, recommend, tabular
from larkspur.operators import sampling
from larkspur.registry import models
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

INPUTS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def raw(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1200):
        a, b = int(rng.random() < 0.3), int(rng.random() < 0.6)
        p = 1 / (1 + math.exp(-(0.8 * a - 1.1 * b + 0.2)))
        rows.append((i, a, b, 0, float(rng.random() < p), 1 + a + rng.randrange(4)))
    df = spark.createDataFrame(rows, "k int, a int, b int, c int, label double, stay int")
    return sampling.assign_folds(df, ["k"], 3, 1).cache()


def test_collapsed_logistic_fit_equals_the_raw_fit(raw):
    """The penalised fit on counted rows is the default fit on all rows."""
    for reg, mix in ((0.1, 0.0), (0.02, 0.5)):
        plain = LogisticRegression(
            featuresCol="features", labelCol="label", maxIter=50, regParam=reg,
            elasticNetParam=mix, tol=1e-10,
        ).fit(tabular.assemble(raw, INPUTS))
        counted = tabular.compact(tabular.collapse(raw, [*INPUTS, "label"]))
        scales = tabular.sample_scale(counted, INPUTS)
        model = tabular.logistic_model("label", reg, mix).setTol(1e-10).fit(
            tabular.assemble(tabular.scale(counted, INPUTS, scales), INPUTS)
        )
        back = [w / scales[c] if scales[c] else 0.0 for w, c in zip(model.coefficients, INPUTS)]
        assert back == pytest.approx(list(plain.coefficients), abs=1e-5)
        assert model.intercept == pytest.approx(plain.intercept, abs=1e-5)


def test_collapsed_poisson_search_equals_the_raw_search(raw):
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    plain = GeneralizedLinearRegression(
        family="poisson", link="log", featuresCol="features", labelCol="stay", maxIter=50
    )
    grid = ParamGridBuilder().addGrid(plain.regParam, [0.001, 1.0]).build()
    want = CrossValidator(
        estimator=plain, estimatorParamMaps=grid, numFolds=3, foldCol="fold",
        evaluator=RegressionEvaluator(labelCol="stay", metricName="rmse"),
    ).fit(tabular.assemble(raw, INPUTS[:2]))
    counted = tabular.compact(tabular.collapse(raw, [*INPUTS, "stay", "fold"]))
    rows = tabular.assemble(counted, INPUTS[:2])
    model = tabular.poisson_model("stay")
    got = tabular.grid_search(
        model, tabular.grid({model.regParam: [0.001, 1.0]}), models._rmse_evaluator(), rows
    )
    assert got.avgMetrics == pytest.approx(want.avgMetrics, abs=1e-8)
    assert got.stdMetrics == pytest.approx(want.stdMetrics, abs=1e-8)
    table = tabular.search_table(rows, got)
    assert table.columns == ["regParam", "mean_metric", "std_metric"] and table.count() == 2
    best = tabular.best_point(table, larger_is_better=False).first()
    assert best.mean_metric == min(got.avgMetrics)
    assert float(best.regParam) == got.bestModel.getRegParam()


def test_full_grids_have_the_published_sizes():
    logit = tabular.logistic_model("label")
    assert len(tabular.grid({logit.regParam: tabular.REG_PARAMS})) == 6
    assert len(tabular.grid({logit.regParam: tabular.REG_PARAMS,
                             logit.elasticNetParam: tabular.ELASTIC_NET_PARAMS})) == 30


def test_validation_curve_splits_series(spark):
    search = spark.createDataFrame(
        [("0.0", "0.1", 0.6, 0.01), ("0.5", "0.1", 0.5, 0.02)],
        "elasticNetParam string, regParam string, mean_metric double, std_metric double",
    )
    rows = tabular.validation_curve(search, "regParam", "elasticNetParam").collect()
    assert sorted((r.series, r.x) for r in rows) == [(0.0, 0.1), (0.5, 0.1)]
    alone = tabular.validation_curve(search.drop("elasticNetParam"), "regParam").collect()
    assert {r.series for r in alone} == {None} and [r.x for r in alone] == [0.1, 0.1]


@pytest.fixture(scope="module")
def sides(spark):
    train, test = models.challenge_sides(spark, SMALL)
    return train.cache(), test.cache()


def test_classifiers_learn_and_learning_curve_has_every_point(sides):
    train, test = sides
    curve = experiments.learning_curve(
        train, test, classify.curve_models(128), ["vec_key"], classify.LABEL, 1, sizes=[0.5, 1.0]
    ).collect()
    assert {(r.model, r.datasize) for r in curve} == {
        (m, s) for m in experiments.MODELS for s in (0.5, 1.0)
    }
    total = train.count()
    for row in curve:
        assert 0.5 < row.accuracy <= 1 and 0.5 < row.auc <= 1
        assert row.n_rows == total if row.datasize == 1.0 else 0.4 * total < row.n_rows < 0.6 * total
        assert row.runtime_min == pytest.approx(row.runtime / 60)


def test_tree_importances_cover_all_inputs_and_sum_to_one(spark):
    rows = queries()["tree_importances"](spark, SMALL).collect()
    assert len(rows) == 64 and sum(r.importance for r in rows) == pytest.approx(1.0)


@pytest.mark.parametrize("name", ["clf_forest", "clf_boosting", "clf_perceptron", "clf_tree"])
def test_classifier_queries_score_every_test_row(spark, name):
    rows = queries()[name](spark, SMALL).collect()
    keys = {r.vec_id for r in models._bits(spark, SMALL).filter("fold = 0").collect()}
    assert {r.vec_id for r in rows} == keys and len(rows) == len(keys)
    assert all(r.prediction in (0.0, 1.0) and 0 <= r.p_positive <= 1 for r in rows)


def test_search_queries_have_one_row_per_point(spark):
    assert queries()["cv_logit_elastic"](spark, SMALL).count() == 30
    assert queries()["cv_best_params"](spark, SMALL).count() == 1


@pytest.fixture(scope="module")
def folded(spark):
    """Ratings with structure: user taste times item kind."""
    rng = random.Random(4)
    rows = [(u, i, 2.5 + (1 if u % 2 == i % 2 else -1) + rng.random() * 0.2)
            for u in range(60) for i in range(40) if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    return sampling.assign_folds(df, ["user_id", "item_id"], 2, 3).cache()


def test_fold_metrics_and_report(folded):
    settings = {"1": {}, "2": {"rank": 4, "regParam": 0.05}}
    rows = recommend.fold_metrics(folded, settings, folds=2)
    got = rows.collect()
    assert {(r.fold, r.setting) for r in got} == {(f, s) for f in (0, 1) for s in settings}
    assert all(0 < r.mae <= r.rmse < 0.8 for r in got)
    report = {r.fold: r for r in recommend.report(rows, tuple(settings)).collect()}
    assert set(report) == {"0", "1", "mean", "std"}
    ones = [r.rmse for r in got if r.setting == "1"]
    assert report["mean"].rmse_1 == pytest.approx(sum(ones) / 2)


def test_clusters_and_profiles(spark, folded):
    factors = recommend.factors_per_fold(folded, folds=2)
    assert set(factors) == {0, 1}
    assigned = recommend.clusters_per_fold(factors, k=2)
    sizes = recommend.largest_clusters(assigned, ["fold"]).collect()
    assert {r.fold for r in sizes} == {0, 1}
    assert sum(r.n_items for r in sizes) == sum(f.count() for f in factors.values())
    model = recommend.fit_clusters(factors[0], k=2)
    placed = model.transform(factors[0])
    check = recommend.misplaced(placed, model, "prediction").first()
    assert (check.n_rows, check.n_misplaced) == (placed.count(), 0)
    wrong = placed.withColumn("prediction", 1 - F.col("prediction"))
    assert recommend.misplaced(wrong, model, "prediction").first().n_misplaced == placed.count()


def test_profile_per_group_against_plain_python(spark):
    rng = random.Random(8)
    assigned = [(f, i, rng.randrange(5)) for f in range(2) for i in range(60)]
    scores = [(i, t, round(rng.random(), 3)) for i in range(50) for t in range(8)]
    frame = spark.createDataFrame(assigned, "fold int, id int, cluster int")
    tags = spark.createDataFrame(scores, "item_id int, tag_id int, relevance double").withColumn(
        "relevance", F.col("relevance").cast("decimal(18,6)")
    )
    names = spark.createDataFrame([(t, f"t{t}") for t in range(8)], "tag_id int, tag string")
    got = {
        (r.fold, r.cluster, r.place): (r.tag, float(r.sum_score))
        for r in recommend.profile(frame, tags, names, ["fold"]).collect()
    }
    want = {}
    for fold in range(2):
        members = {}
        for f, i, c in assigned:
            if f == fold:
                members.setdefault(c, []).append(i)
        top = sorted(members, key=lambda c: (-len(members[c]), c))[:3]
        for c in top:
            sums = {}
            for i, t, v in scores:
                if i in members[c]:
                    sums[t] = sums.get(t, 0) + v
            for place, t in enumerate(sorted(sums, key=lambda t: (-round(sums[t], 6), t))[:3], 1):
                want[fold, c, place] = (f"t{t}", pytest.approx(sums[t]))
    assert got == want


def test_searches_side_by_side_do_not_disturb_each_other(spark):
    rows = spark.createDataFrame(
        [(float(i % 3), float(i % 2), i // 2 % 2, 1) for i in range(24)],
        f"label double, x double, fold int, {tabular.WEIGHT} long",
    )
    vectors = tabular.assemble(rows, ["x"]).persist()
    model = tabular.poisson_model("label")
    settings = tabular.grid({model.regParam: [0.0, 0.1]})
    found = {
        tuple(tabular.grid_search(model, settings, RegressionEvaluator(), vectors, folds=2, parallelism=8).avgMetrics)
        for _ in range(3)
    }
    assert len(found) == 1
