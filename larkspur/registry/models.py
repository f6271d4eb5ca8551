"""Model queries: linear models, classifiers, grid searches, learning curves.

Where a fitted model has a property SQL can state (a saturated model predicts
group means, an unpenalised intercept makes the mean prediction the mean label)
the query reports that property; other queries report the model's output.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators import durable, metrics, sampling
from larkspur.plans import classify, experiments, searches, tabular
from larkspur.plans.perceptron import PackedPerceptron
from larkspur.registry.tables import ENCOUNTERS_SQL, bucket_sql, share_sql
from larkspur.sources import standins

SEED = tabular.SEED
FLAGS = list(standins.ENCOUNTER_OFF)
TRAIN_SHARE = {0.0: 0.8, 1.0: 0.8}
TEST_FOLD, BIT_FOLDS = 0, 5
LONG_STAY = 4


# -- encounters ---------------------------------------------------------------


def _encounters(s, d):
    return tabular.encode(
        standins.encounters(s, d), standins.ENCOUNTER_OFF, "outcome", "O",
        keep=["encounter_id", "stay"],
    )


def _split(s, d):
    """Encounters with their stratified side and fold."""
    split = sampling.split_strata(
        _encounters(s, d), "label", ["encounter_id"], TRAIN_SHARE, SEED
    )
    return sampling.assign_folds(split, ["encounter_id"], tabular.FOLDS, SEED + 1)


def _counted(s, d):
    """Distinct (flags, label, stay, fold, split) with row counts: the tables read once for many fits."""
    return tabular.compact(tabular.collapse_flags(_split(s, d), FLAGS, ["label", "stay", "fold", "split"]))


def _collapsed(s, d, target, split=None, counted=None):
    """Distinct (flags, target, fold) of one side, or of all rows, with row counts.

    ``counted`` rows (see ``_counted``) are added up instead of reading the tables again.
    """
    rows = _split(s, d) if counted is None else counted
    if split:
        rows = rows.filter(F.col("split") == split)
    if counted is None:
        return tabular.compact(tabular.collapse_flags(rows, FLAGS, [target, "fold"]))
    added = rows.groupBy(*FLAGS, target, "fold").agg(F.sum(tabular.WEIGHT).alias(tabular.WEIGHT))
    return tabular.compact(added)


def _scaled(s, d, split=None, counted=None):
    rows = _collapsed(s, d, "label", split, counted)
    return tabular.assemble(
        tabular.scale(rows, FLAGS, tabular.sample_scale(rows, FLAGS)), FLAGS
    )


def _per_flag(s, d, target, model, prediction):
    """One saturated model per flag; its predictions per flag value."""
    rows = tabular.compact(tabular.collapse_flags(_encounters(s, d), FLAGS, [target]))

    def one(name):
        single = rows.select(F.col(name).alias("flag"), target, tabular.WEIGHT)
        vectors = tabular.assemble(single, ["flag"])
        scored = model(target).setTol(1e-10).fit(vectors).transform(vectors)
        return scored.select(
            F.lit(name).alias("feature"), "flag", tabular.WEIGHT,
            prediction.alias("predicted"),
        )

    parts = experiments.in_parallel(s, [partial(one, name) for name in FLAGS], len(FLAGS))
    return (
        reduce(DataFrame.union, parts)
        .groupBy("feature", "flag")
        .agg(
            F.sum(tabular.WEIGHT).alias("n_rows"),
            F.round(F.max("predicted"), 4).alias("predicted"),
        )
    )


def _glm_poisson(s, d):
    return _per_flag(s, d, "stay", tabular.poisson_model, F.col("prediction"))


def _logit_l2(s, d):
    return _per_flag(s, d, "label", tabular.logistic_model, vector_to_array("probability")[1])


ELASTIC = {"reg_param": 0.01, "elastic_net": 0.5}
#: What may be left of a coefficient's optimality condition after the last iteration.
TOLERANCE = 1e-6


def _positive():
    """Predicted probability of the positive label."""
    return vector_to_array("probability")[1]


def _logit_elastic(s, d):
    """Mean prediction, and how many coefficients meet the optimality condition of the penalty."""
    rows = _scaled(s, d)
    model = tabular.logistic_model("label", **ELASTIC).setTol(1e-12).setMaxIter(500).fit(rows)
    at = tabular.optimality(rows, model, FLAGS, "label", _positive(), **ELASTIC)
    weighted = _positive() * F.col(tabular.WEIGHT)
    mean = F.round(F.sum(weighted) / F.sum(tabular.WEIGHT), 4)
    scored = model.transform(rows).agg(F.sum(tabular.WEIGHT).alias("n_rows"), mean.alias("mean_predicted"))
    met = at.agg(F.max("n_rows").alias("n_rows"), F.count_if(F.col("residual") < TOLERANCE).alias("n_optimal"))
    return scored.join(met, "n_rows")


def _wide_encoded(s, d):
    """Encounters with one flag per medicine."""
    off = dict.fromkeys(standins.MEDICINES, "No")
    rows = standins.wide_encounters(s, d)
    return tabular.encode(rows, off, "outcome", "O", keep=["encounter_id", "stay"])


WIDE_PENALTIES = {
    "poisson": {"reg_param": 0.01},
    "logistic_l2": {"reg_param": 0.1},
    "logistic_elastic": {"reg_param": 0.01, "elastic_net": 0.5},
}


def wide_fits(s, d, penalties=None):
    """The three linear models over all medicines' flags: name -> (rows, model, inputs, label, prediction)."""
    penalties = {**WIDE_PENALTIES, **(penalties or {})}
    names, encoded = standins.MEDICINES, _wide_encoded(s, d)
    stays = tabular.assemble(tabular.compact(tabular.collapse_flags(encoded, names, ["stay"])), names)
    labels = tabular.compact(tabular.collapse_flags(encoded, names, ["label"]))
    labels = tabular.assemble(tabular.scale(labels, names, tabular.sample_scale(labels, names)), names)

    def fit(name):
        if name == "poisson":
            model = tabular.poisson_model("stay", **penalties[name]).setTol(1e-12)
            return stays, model.fit(stays), names, "stay", F.col("prediction")
        model = tabular.logistic_model("label", **penalties[name]).setTol(1e-12).setMaxIter(500)
        return labels, model.fit(labels), names, "label", _positive()

    found = experiments.in_parallel(s, [partial(fit, name) for name in penalties], len(penalties))
    return dict(zip(penalties, found))


def wide_residuals(s, d, penalties=None):
    """Residuals of the optimality conditions of ``WIDE_PENALTIES``, whatever was fitted."""
    parts = []
    for name, (rows, model, names, label, prediction) in wide_fits(s, d, penalties).items():
        at = tabular.optimality(
            rows, model, names, label, prediction, per_unit_mean=name == "poisson", **WIDE_PENALTIES[name]
        )
        parts.append(at.select(F.lit(name).alias("model"), "*"))
    return reduce(DataFrame.union, parts)


def _glm_optimality(s, d):
    """Whether every coefficient of the three penalised models is at its optimum."""
    return wide_residuals(s, d).select(
        "model", "feature", "n_rows", (F.col("residual") < TOLERANCE).alias("at_optimum")
    )


def _rmse_evaluator():
    return RegressionEvaluator(
        labelCol="stay", predictionCol="prediction", metricName="rmse", weightCol=tabular.WEIGHT
    )


def _accuracy_evaluator(label="label", weight=tabular.WEIGHT):
    evaluator = MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName="accuracy"
    )
    return evaluator.setWeightCol(weight) if weight else evaluator


def _glm_search(s, d, counted=None):
    rows = tabular.assemble(_collapsed(s, d, "stay", "train", counted), FLAGS)
    model = tabular.poisson_model("stay")
    settings = tabular.grid({model.regParam: tabular.REG_PARAMS})
    return rows, tabular.grid_search(model, settings, _rmse_evaluator(), rows)


def _cv_glm(s, d):
    return tabular.search_table(*_glm_search(s, d))


def _logit_search(s, d, penalties, mixes=None, counted=None):
    rows = _scaled(s, d, "train", counted)
    model = tabular.logistic_model("label")
    values = {model.regParam: penalties}
    if mixes:
        values[model.elasticNetParam] = mixes
    return rows, tabular.grid_search(model, tabular.grid(values), _accuracy_evaluator(), rows)


def _cv_logit_l2(s, d):
    return tabular.search_table(*_logit_search(s, d, tabular.REG_PARAMS))


def _cv_logit_elastic(s, d):
    return tabular.search_table(
        *_logit_search(s, d, tabular.REG_PARAMS, tabular.ELASTIC_NET_PARAMS)
    )


def _validation_curve(s, d):
    search = tabular.search_table(*_logit_search(s, d, tabular.REG_PARAMS, tabular.ELASTIC_NET_PARAMS))
    return tabular.validation_curve(search, "regParam", "elasticNetParam")


def _cv_best_params(s, d):
    return tabular.best_point(_cv_glm(s, d), larger_is_better=False)


def _cv_saturated(s, d):
    """Cross-validated error of one saturated model per flag; SQL can state it exactly."""
    folded = sampling.assign_folds(_encounters(s, d), ["encounter_id"], tabular.FOLDS, SEED + 1)
    rows = tabular.compact(tabular.collapse_flags(folded, FLAGS, ["stay", "fold"]))

    def one(name):
        vectors = tabular.assemble(rows.select(name, "stay", "fold", tabular.WEIGHT), [name])
        model = tabular.poisson_model("stay").setTol(1e-10)
        settings = tabular.grid({model.regParam: [0.0]})
        search = tabular.grid_search(model, settings, _rmse_evaluator(), vectors)
        return tabular.search_table(vectors, search).select(
            F.lit(name).alias("feature"),
            F.round("mean_metric", 6).alias("mean_rmse"),
            F.round("std_metric", 6).alias("std_rmse"),
        )

    parts = experiments.in_parallel(s, [partial(one, name) for name in FLAGS], len(FLAGS))
    return reduce(DataFrame.union, parts)


def _tree_majority(s, d):
    """A tree grown over all flag combinations predicts each one's majority."""
    long_stay = F.when(F.col("stay") >= LONG_STAY, 1.0).otherwise(0.0).alias(classify.LABEL)
    rows = tabular.compact(
        tabular.collapse_flags(_encounters(s, d).select(*FLAGS, long_stay), FLAGS, [classify.LABEL])
    )
    vectors = tabular.assemble(rows, FLAGS)
    model = classify.tree().setWeightCol(tabular.WEIGHT).fit(vectors)
    return (
        model.transform(vectors)
        .groupBy(*FLAGS)
        .agg(F.sum(tabular.WEIGHT).alias("n_rows"), F.max("prediction").alias("prediction"))
    )


def _refit_equals_best(s, d):
    """The winner of a search against a fresh fit with its parameters, on the test side."""
    rows, search = _glm_search(s, d)
    best = search.bestModel
    fresh = tabular.poisson_model("stay", best.getRegParam()).fit(rows)
    test = tabular.assemble(_collapsed(s, d, "stay", "test"), FLAGS)
    both = best.transform(test).withColumnRenamed("prediction", "of_best")
    both = fresh.transform(both)
    gap = F.abs(
        metrics.rmse("stay", "prediction", tabular.WEIGHT)
        - metrics.rmse("stay", "of_best", tabular.WEIGHT)
    )
    return both.agg(
        F.sum(tabular.WEIGHT).alias("n_rows"), (gap < 1e-9).alias("same_error")
    )


# -- bit vectors --------------------------------------------------------------


def _bits(s, d):
    rows = classify.typed_vectors(standins.bit_vectors(s, d), "lbl")
    return sampling.assign_folds(rows, ["vec_id"], BIT_FOLDS, SEED)


def _bit_sides(s, d):
    """Assembled train and test vectors: fold 0 tests, the others train."""
    vectors = classify.with_features(_bits(s, d), standins.BIT_COLUMNS)
    return sampling.fold_pair(vectors, TEST_FOLD)


def _predictions(estimator):
    """Pipeline of assembler and estimator; predictions for the test fold."""

    def query(s, d):
        train, test = sampling.fold_pair(_bits(s, d), TEST_FOLD)
        train = train.persist()
        try:
            model = classify.pipeline(standins.BIT_COLUMNS, estimator()).fit(train)
        finally:
            train.unpersist()
        return model.transform(test).select(
            "vec_id", classify.LABEL, "prediction",
            F.round(vector_to_array("probability")[1], 6).alias("p_positive"),
        )

    return query


CLASSIFIERS = {
    "forest": classify.forest,
    "boosting": classify.boosting,
    "perceptron": lambda: classify.perceptron(len(standins.BIT_COLUMNS)),
    "tree": classify.tree,
}


def _classified_rows(s, d):
    """Test vectors of all four classifiers: key, label, and whether prediction and probability agree."""
    parts = []
    for name, make in CLASSIFIERS.items():
        rows = _predictions(make)(s, d)
        agree = F.col("prediction") == F.when(F.col("p_positive") > 0.5, 1.0).otherwise(0.0)
        undecided = F.col("p_positive") == 0.5
        valid = F.col("p_positive").between(0.0, 1.0) & (agree | undecided)
        parts.append(rows.select(F.lit(name).alias("model"), "vec_id", classify.LABEL, valid.alias("valid")))
    return reduce(DataFrame.union, parts)


def _importances_sum(s, d):
    """Importances of the tree: one per input, none negative, one in total."""
    weights = _tree_importances(s, d).agg(
        F.count(F.lit(1)).alias("n_inputs"),
        F.round(F.sum("importance"), 9).alias("total"),
        F.count_if(F.col("importance") < 0).alias("n_negative"),
    )
    told = [F.lit(v).cast(weights.schema[n].dataType).alias(n) for n, v in weights.first().asDict().items()]
    return _bit_sides(s, d)[0].agg(F.count(F.lit(1)).alias("n_rows"), *told)


def _tree_importances(s, d):
    train, _ = _bit_sides(s, d)
    return classify.importances(train, classify.tree().fit(train), standins.BIT_COLUMNS)


def _folded_bits(s, d):
    train, _ = _bit_sides(s, d)
    return sampling.assign_folds(train.drop("fold"), ["vec_id"], tabular.FOLDS, SEED + 1)


#: Distinct values of an input of the bit vectors.
BIT_VALUES = 2
TREE_POINTS = [*searches.forest_points(), *searches.boosting_points()]
NET_POINTS = searches.perceptron_points(len(standins.BIT_COLUMNS))


def _searched(s, d, points):
    """Score levels of all points over the folds of the training vectors."""
    rows = _folded_bits(s, d).persist()
    try:
        return searches.scored_search(rows, points, classify.LABEL, tabular.FOLDS, values=BIT_VALUES)
    finally:
        rows.unpersist()


def _cv_points(points):
    """Cross-validated accuracy of every grid point."""

    def query(s, d):
        found = searches.search_table(_searched(s, d, points), points)
        return found.filter(F.col("metric") == "accuracy").drop("metric")

    return query


def _cv_by_metric(s, d):
    """Forest, boosting and perceptron searched once, every point judged by both metrics."""
    points = [*TREE_POINTS, *NET_POINTS]
    return searches.search_table(_searched(s, d, points), points)


def _linear_points():
    poisson, logit = tabular.poisson_model("stay"), tabular.logistic_model("label")
    return {
        "poisson": tabular.grid({poisson.regParam: tabular.REG_PARAMS}),
        "logistic_l2": tabular.grid({logit.regParam: tabular.REG_PARAMS}),
        "logistic_elastic": tabular.grid(
            {logit.regParam: tabular.REG_PARAMS, logit.elasticNetParam: tabular.ELASTIC_NET_PARAMS}
        ),
    }


def _setting_text(setting):
    return ";".join(f"{k}={v}" for k, v in sorted(tabular.setting_values(setting).items()))


def _linear_winners(s, d):
    """Winner, its mean over the folds and its test score for the three linear searches.

    All sides of all searches come from one table of counts, so the tables are read once.
    """
    counted = _counted(s, d)
    stays, labels = (_collapsed(s, d, target, "test", counted) for target in ("stay", "label"))
    scales = tabular.sample_scale(_collapsed(s, d, "label", "train", counted), FLAGS)
    stay_test = tabular.assemble(stays, FLAGS)
    label_test = tabular.assemble(tabular.scale(labels, FLAGS, scales), FLAGS)
    work = {
        "poisson": (lambda: _glm_search(s, d, counted), _rmse_evaluator(), stay_test),
        "logistic_l2": (
            lambda: _logit_search(s, d, tabular.REG_PARAMS, counted=counted), _accuracy_evaluator(), label_test,
        ),
        "logistic_elastic": (
            lambda: _logit_search(s, d, tabular.REG_PARAMS, tabular.ELASTIC_NET_PARAMS, counted),
            _accuracy_evaluator(), label_test,
        ),
    }
    tables, scores = [], []
    for name, (search, evaluator, test) in work.items():
        _, found = search()
        metric = evaluator.getMetricName()
        points = [
            (name, metric, i, _setting_text(setting), float(mean))
            for i, (setting, mean) in enumerate(zip(found.getEstimatorParamMaps(), found.avgMetrics))
        ]
        tables += points
        scores.append((name, float(evaluator.evaluate(found.bestModel.transform(test)))))
    columns = "model string, metric string, point int, settings string, mean_metric double"
    chosen = searches.winners(s.createDataFrame(tables, columns))
    return chosen.join(s.createDataFrame(scores, "model string, test_score double"), "model")


def _search_winners(s, d):
    """The winner of every search by every metric, with its score on the test side."""
    points = [*TREE_POINTS, *NET_POINTS]
    train, test = _bit_sides(s, d)
    train, test = train.persist(), test.persist()
    try:
        chosen = searches.winners(searches.search_table(_searched(s, d, points), points))
        classifiers = searches.test_scores(chosen, points, train, test, classify.LABEL)
    finally:
        train.unpersist()
        test.unpersist()
    return classifiers.unionByName(_linear_winners(s, d).select(*classifiers.columns))


def _search_grids(s, d):
    """Every point of every search with the rows it is fitted and scored on per fold."""
    linear = [
        (name, i, _setting_text(setting))
        for name, settings in _linear_points().items()
        for i, setting in enumerate(settings)
    ]
    others = [(p.model, p.number, p.text()) for p in [*TREE_POINTS, *NET_POINTS]]
    points = s.createDataFrame([*linear, *others], searches.POINT_SCHEMA)
    tabular_rows = _split(s, d).filter(F.col("split") == "train").groupBy("fold").count()
    vectors = _folded_bits(s, d).groupBy("fold").count()
    classifiers = F.col("model").isin("forest", "boosting", "perceptron")
    kinds = tabular_rows.select(F.lit(False).alias("vectors"), "*").union(vectors.select(F.lit(True), "*"))
    total = kinds.groupBy("vectors").agg(F.sum("count").alias("_all"))
    sizes = kinds.join(total, "vectors").select(
        "vectors", "fold", (F.col("_all") - F.col("count")).alias("n_fit"), F.col("count").alias("n_scored")
    )
    return points.withColumn("vectors", classifiers).join(sizes, "vectors").drop("vectors")


def _validation_curves(s, d):
    """The curves of the Poisson, L2 and elastic-net searches as one table."""
    curves = [
        tabular.validation_curve(_cv_glm(s, d), "regParam").select(F.lit("poisson").alias("model"), "*"),
        tabular.validation_curve(_cv_logit_l2(s, d), "regParam").select(F.lit("logistic_l2").alias("model"), "*"),
        tabular.validation_curve(_cv_logit_elastic(s, d), "regParam", "elasticNetParam").select(
            F.lit("logistic_elastic").alias("model"), "*"
        ),
    ]
    return reduce(DataFrame.union, curves)


def challenge_sides(s, d):
    """Train and test side of the 128-bit vectors."""
    rows = classify.labelled_vectors(standins.challenge_vectors(s, d), "lbl")
    return sampling.fold_pair(
        sampling.assign_folds(rows, ["vec_key"], BIT_FOLDS, SEED), TEST_FOLD
    )


def _challenge_vectors(s, d):
    """Label and number of ones per vector."""
    rows = classify.labelled_vectors(standins.challenge_vectors(s, d), "lbl")
    ones = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, b: a + b)
    return rows.select("vec_key", classify.LABEL, ones.cast("int").alias("n_ones"))


def _packed_folds(s, d):
    """The same vectors with their fold, their bits in two longs."""
    rows = classify.labelled_vectors(standins.packed_vectors(s, d), "lbl")
    return sampling.assign_folds(rows, ["vec_key"], BIT_FOLDS, SEED)


def packed_sides(s, d):
    """Train and test side of the packed vectors."""
    return sampling.fold_pair(_packed_folds(s, d), TEST_FOLD)


def _stored_sides(s, d):
    """Train and test side, placed and stored with their bits both in longs and as vectors.

    The tables are read once.  In files a vector takes about as much as its bits, so every fit reads
    vectors instead of making them anew in each of its passes.
    """
    rows = experiments.placed(_packed_folds(s, d), ["vec_key"], SEED).drop("vec_key").persist()
    try:
        return [
            durable.stored_parts(standins.unpacked(side.drop("fold"), keep_words=True), name)
            for side, name in zip(sampling.fold_pair(rows, TEST_FOLD), ("train", "test"))
        ]
    finally:
        rows.unpersist()


def _curve(s, train, test, models, **settings):
    """Learning curve over stored sides; perceptrons are fitted on the packed bits."""
    fitted = {
        name: PackedPerceptron(model, standins.WORDS) if isinstance(model, MultilayerPerceptronClassifier) else model
        for name, model in models.items()
    }
    points = experiments.curve_points(train, test, fitted, classify.LABEL, **settings)
    return s.createDataFrame(points, experiments.CURVE_SCHEMA)


def challenge_curve(s, d, models, **settings):
    """Learning curve over the packed vectors."""
    return _curve(s, *_stored_sides(s, d), models, **settings)


def _learning_curve(s, d):
    return challenge_curve(s, d, classify.curve_models(standins.CHALLENGE_BITS))


def _quality(s, d):
    """Whether each model beats the constant guess on the test vectors.

    One fit at a time: a tree model stores half a kilobyte a row while it is fitted.
    """
    fitted = {
        "RF": classify.forest(), "GBT": classify.boosting(), "DT": classify.tree(maxDepth=7),
        "MPC": classify.perceptron(standins.CHALLENGE_BITS),
    }
    train, test = _stored_sides(s, d)
    curve = _curve(s, train, test, fitted, sizes=[1.0])
    positive = F.avg(classify.LABEL)
    guess = test.agg(
        F.count(F.lit(1)).alias("n_test"), F.greatest(positive, 1 - positive).alias("guess")
    ).first()
    return curve.select(
        "model",
        F.col("n_rows").alias("n_train"),
        F.lit(guess["n_test"]).cast("long").alias("n_test"),
        (F.col("accuracy") > guess["guess"]).alias("beats_guess"),
    )


def _learning_curve_sizes(s, d):
    train, _ = packed_sides(s, d)
    return experiments.sample_sizes(train.select("vec_key"), ["vec_key"], SEED)


QUERIES = {
    "glm_poisson": _glm_poisson,
    "logit_l2": _logit_l2,
    "logit_elastic": _logit_elastic,
    "cv_glm": _cv_glm,
    "cv_logit_l2": _cv_logit_l2,
    "cv_logit_elastic": _cv_logit_elastic,
    "validation_curve": _validation_curve,
    "cv_best_params": _cv_best_params,
    "cv_saturated": _cv_saturated,
    "refit_equals_best": _refit_equals_best,
    "clf_tree_majority": _tree_majority,
    "clf_quality": _quality,
    "clf_forest": _predictions(classify.forest),
    "clf_boosting": _predictions(classify.boosting),
    "clf_perceptron": _predictions(lambda: classify.perceptron(len(standins.BIT_COLUMNS))),
    "clf_tree": _predictions(classify.tree),
    "clf_rows": _classified_rows,
    "tree_importances": _tree_importances,
    "importances_sum": _importances_sum,
    "cv_trees": _cv_points(TREE_POINTS),
    "cv_perceptron": _cv_points(NET_POINTS),
    "cv_by_metric": _cv_by_metric,
    "search_grids": _search_grids,
    "search_winners": _search_winners,
    "validation_curves": _validation_curves,
    "flags_wide": _wide_encoded,
    "glm_optimality": _glm_optimality,
    "challenge_vectors": _challenge_vectors,
    "learning_curve_sizes": _learning_curve_sizes,
    "learning_curve": _learning_curve,
}


_WIDE_SQL = """
wide AS (
  SELECT """ + ", ".join(
    f"CASE WHEN count(*) FILTER (WHERE l_partkey % {len(standins.MEDICINES)} = {i}) > 0 THEN 1 ELSE 0 END AS {name}"
    for i, name in enumerate(standins.MEDICINES)
) + """,
         CASE WHEN contains(o_orderstatus, 'O') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label,
         o_orderkey AS encounter_id, count(*) AS stay
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus)"""


def _group_means(target):
    parts = [
        f"SELECT '{name}' AS feature, {name} AS flag, count(*) AS n_rows, "
        f"round(avg({target}), 4) AS predicted FROM encounters GROUP BY {name}"
        for name in FLAGS
    ]
    return f"WITH {ENCOUNTERS_SQL} " + " UNION ALL ".join(parts)


_CHALLENGES = """
keyed AS (SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS vec_key
          FROM lineitem),
words AS (SELECT vec_key, """ + ", ".join(
    f"bit_count(('0x' || substr(vec_key, {1 + 8 * i}, 8))::BIGINT) AS n{i}" for i in range(4)
) + """ FROM keyed)"""


def _fold_errors():
    parts = [
        f"""SELECT '{name}' AS feature, f.fold, sqrt(avg((f.stay - m.mean) * (f.stay - m.mean))) AS e
            FROM folded f JOIN (
              SELECT t.fold, e.{name} AS flag, avg(e.stay) AS mean
              FROM (SELECT DISTINCT fold FROM folded) t JOIN folded e ON e.fold <> t.fold
              GROUP BY 1, 2) m ON m.fold = f.fold AND m.flag = f.{name}
            GROUP BY f.fold"""
        for name in FLAGS
    ]
    return " UNION ALL ".join(parts)


ORACLES = {
    "cv_saturated": f"""WITH {ENCOUNTERS_SQL},
        folded AS (SELECT *, {bucket_sql('encounter_id', tabular.FOLDS, SEED + 1)} AS fold
                   FROM encounters),
        errors AS ({_fold_errors()})
        SELECT feature, round(avg(e), 6) AS mean_rmse, round(stddev_pop(e), 6) AS std_rmse
        FROM errors GROUP BY feature""",
    "clf_tree_majority": f"""WITH {ENCOUNTERS_SQL}
        SELECT {", ".join(FLAGS)}, count(*) AS n_rows,
               CASE WHEN avg(CASE WHEN stay >= {LONG_STAY} THEN 1.0 ELSE 0.0 END) > 0.5
                    THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
        FROM encounters GROUP BY {", ".join(FLAGS)}""",
    "clf_quality": f"""WITH {_CHALLENGES}
        SELECT model, count(*) FILTER (WHERE {bucket_sql('vec_key', BIT_FOLDS)} <> {TEST_FOLD})
                 AS n_train,
               count(*) FILTER (WHERE {bucket_sql('vec_key', BIT_FOLDS)} = {TEST_FOLD}) AS n_test,
               true AS beats_guess
        FROM words, (VALUES ('RF'), ('GBT'), ('DT'), ('MPC')) AS models(model) GROUP BY model""",
    "clf_rows": f"""SELECT model, vec_id, CASE WHEN label % 2 = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS labels, true AS valid
        FROM embeddings, unnest({list(CLASSIFIERS)}) AS m(model) WHERE {bucket_sql('vec_id', BIT_FOLDS)} = {TEST_FOLD}""",
    "importances_sum": f"""SELECT count(*) AS n_rows, 64::BIGINT AS n_inputs, 1.0::DOUBLE AS total, 0::BIGINT AS n_negative
        FROM embeddings WHERE {bucket_sql('vec_id', BIT_FOLDS)} <> {TEST_FOLD}""",
    "challenge_vectors": f"""WITH {_CHALLENGES}
        SELECT vec_key, CASE WHEN n0 + n1 > n2 + n3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                 AS labels,
               CAST(n0 + n1 + n2 + n3 AS INTEGER) AS n_ones
        FROM words""",
    "learning_curve_sizes": f"""WITH {_CHALLENGES}
        SELECT datasize, count(*) AS n_rows
        FROM words, unnest({experiments.SIZES}::DOUBLE[]) AS sizes(datasize)
        WHERE {bucket_sql('vec_key', BIT_FOLDS)} <> {TEST_FOLD}
          AND {share_sql('vec_key', 'datasize')}
        GROUP BY datasize""",
    "glm_poisson": _group_means("stay"),
    "logit_l2": _group_means("label"),
    "logit_elastic": f"""WITH {ENCOUNTERS_SQL}
        SELECT count(*) AS n_rows, round(avg(label), 4) AS mean_predicted,
               {len(FLAGS)}::BIGINT AS n_optimal
        FROM encounters""",
    "flags_wide": f"""WITH {_WIDE_SQL} SELECT * FROM wide""",
    "glm_optimality": f"""WITH {_WIDE_SQL}
        SELECT model, feature, count(*) AS n_rows, true AS at_optimum
        FROM wide, unnest({list(WIDE_PENALTIES)}) AS m(model), unnest({standins.MEDICINES}) AS f(feature)
        GROUP BY model, feature""",
    "search_grids": f"""WITH {ENCOUNTERS_SQL},
        reg AS (SELECT row_number() OVER () - 1 AS i, r FROM unnest({[str(float(v)) for v in tabular.REG_PARAMS]}) AS t(r)),
        mix AS (SELECT row_number() OVER () - 1 AS i, e FROM unnest({[str(float(v)) for v in tabular.ELASTIC_NET_PARAMS]}) AS t(e)),
        depths AS (SELECT row_number() OVER () - 1 AS i, v FROM unnest({classify.TREE_DEPTHS}) AS t(v)),
        bins AS (SELECT row_number() OVER () - 1 AS i, v FROM unnest({classify.TREE_BINS}) AS t(v)),
        trees AS (SELECT row_number() OVER () - 1 AS i, v FROM unnest({classify.FOREST_SIZES}) AS t(v)),
        rounds AS (SELECT row_number() OVER () - 1 AS i, v FROM unnest({classify.BOOSTING_ROUNDS}) AS t(v)),
        blocks AS (SELECT row_number() OVER () - 1 AS i, v FROM unnest({classify.PERCEPTRON_BLOCKS}) AS t(v)),
        layers AS (SELECT row_number() OVER () - 1 AS i, v FROM unnest({[str([len(standins.BIT_COLUMNS), *h, 2]) for h in classify.PERCEPTRON_LAYERS]}) AS t(v)),
        turns AS (SELECT row_number() OVER () - 1 AS i, v FROM unnest({classify.PERCEPTRON_ITERATIONS}) AS t(v)),
        points AS (
          SELECT m AS model, i AS point, 'regParam=' || r AS settings, false AS vectors
          FROM reg, unnest(['poisson', 'logistic_l2']) AS k(m)
          UNION ALL SELECT 'logistic_elastic', reg.i * 5 + mix.i, 'elasticNetParam=' || e || ';regParam=' || r, false FROM reg, mix
          UNION ALL SELECT 'forest', d.i * 9 + b.i * 3 + t.i,
                 'maxBins=' || b.v || ';maxDepth=' || d.v || ';numTrees=' || t.v, true FROM depths d, bins b, trees t
          UNION ALL SELECT 'boosting', d.i * 9 + b.i * 3 + r.i,
                 'maxBins=' || b.v || ';maxDepth=' || d.v || ';maxIter=' || r.v, true FROM depths d, bins b, rounds r
          UNION ALL SELECT 'perceptron', b.i * 6 + l.i * 3 + t.i,
                 'blockSize=' || b.v || ';layers=' || l.v || ';maxIter=' || t.v, true FROM blocks b, layers l, turns t),
        folded AS (
          SELECT false AS vectors, {bucket_sql('encounter_id', tabular.FOLDS, SEED + 1)} AS fold
          FROM encounters WHERE {share_sql('encounter_id', 0.8)}
          UNION ALL
          SELECT true, {bucket_sql('vec_id', tabular.FOLDS, SEED + 1)}
          FROM embeddings WHERE {bucket_sql('vec_id', BIT_FOLDS)} <> {TEST_FOLD}),
        sizes AS (
          SELECT vectors, fold, count(*) AS n, sum(count(*)) OVER (PARTITION BY vectors) AS whole
          FROM folded GROUP BY vectors, fold)
        SELECT model, CAST(point AS INTEGER) AS point, settings, CAST(fold AS INTEGER) AS fold,
               CAST(whole - n AS BIGINT) AS n_fit, n AS n_scored
        FROM points JOIN sizes USING (vectors)""",
    "refit_equals_best": f"""WITH {ENCOUNTERS_SQL}
        SELECT count(*) AS n_rows, true AS same_error FROM encounters
        WHERE NOT {share_sql('encounter_id', 0.8)}""",
}
