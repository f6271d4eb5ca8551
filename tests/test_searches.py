"""Searches that share fits, exact areas per group, optimality conditions, packed rows."""

import itertools
import random
import time

import duckdb
import pytest
from __spark_entry__ import queries
from conftest import SMALL
from larkspur.operators import durable, metrics, sampling, sets
from larkspur.plans import classify, experiments, recommend, searches, tabular
from larkspur.registry import models, tables
from larkspur.sources import sinks, standins
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def bits(spark):
    """Eight 0/1 inputs and a label that depends on three of them."""
    rng = random.Random(21)
    rows = []
    for i in range(500):
        x = [float(rng.random() < 0.4) for _ in range(8)]
        rows.append((i, x, float((x[0] + x[1] * x[2] > 0.5) != (rng.random() < 0.15))))
    df = spark.createDataFrame(rows, f"k int, x array<double>, {classify.LABEL} double")
    vectors = df.select("k", array_to_vector("x").alias("features"), classify.LABEL)
    return sampling.assign_folds(vectors, ["k"], 2, 3).cache()


def predictions(model, rows):
    return {r.k: r.prediction for r in model.transform(rows).collect()}


def test_boosting_prefixes_equal_separate_fits(bits):
    points = [p for p in searches.boosting_points() if p.settings["maxDepth"] == 3 and p.settings["maxBins"] == 16]
    (fit,) = searches.fits(points)
    assert [p.settings["maxIter"] for p in fit.points] == [3, 5, 7]
    model = fit.estimator.fit(bits)
    rows, cells = fit.scored(model, bits, "f")
    got = rows.select("k", *[c.alias(f"c{i}") for i, c in enumerate(cells)]).collect()
    for i, point in enumerate(fit.points):
        alone = classify.boosting(**point.settings).fit(bits)
        assert {r.k: r[f"c{i}"].prediction for r in got} == predictions(alone, bits)
        raw = {r.k: float(r.rawPrediction[1]) for r in alone.transform(bits).collect()}
        signs = {k: (v > 0) - (v < 0) for k, v in raw.items()}
        assert {r.k: (r[f"c{i}"].score > 0) - (r[f"c{i}"].score < 0) for r in got} == signs


@pytest.mark.parametrize("make", [classify.forest, classify.boosting])
def test_bins_beyond_the_distinct_values_change_nothing(bits, make):
    few, many = (make(maxDepth=4, maxBins=b).fit(bits) for b in (16, 64))
    assert few.toDebugString.split("\n")[1:] == many.toDebugString.split("\n")[1:]


def test_forest_prefixes_are_not_smaller_forests(bits):
    """Why forests are fitted per size."""
    small, large = (classify.forest(numTrees=n, maxDepth=4).fit(bits) for n in (3, 9))
    assert [t.toDebugString for t in small.trees] != [t.toDebugString for t in large.trees[:3]]


def test_grids_and_fits_have_the_published_sizes():
    trees = [*searches.forest_points(), *searches.boosting_points()]
    nets = searches.perceptron_points(64)
    assert (len(trees), len(nets)) == (54, 18)
    assert len(searches.fits(trees)) == 27 + 9 and len(searches.fits(trees, values=2)) == 9 + 3
    assert len(searches.fits(nets)) == 18
    assert len({(p.model, p.text()) for p in [*trees, *nets]}) == 72


def some_points():
    every = [*searches.forest_points(), *searches.boosting_points(), *searches.perceptron_points(8)]
    return [p for p in every if p.settings.get("maxBins", 16) == 16 and p.settings.get("maxDepth", 3) == 3
            and p.settings.get("numTrees", 5) == 5 and p.settings.get("maxIter", 3) in (3, 5, 20)
            and p.settings.get("blockSize", 32) == 32]


@pytest.fixture(scope="module")
def searched(bits):
    points = some_points()
    levels = searches.scored_search(bits, points, classify.LABEL, 2)
    return points, searches.search_table(levels, points)


def test_search_agrees_with_a_search_per_point(bits, searched):
    points, table = searched
    got = {(r.model, r.point, r.metric): (r.mean_metric, r.std_metric, r.settings) for r in table.collect()}
    assert len(got) == 2 * len(points) == 10
    evaluators = {
        "accuracy": models._accuracy_evaluator(classify.LABEL, None),
        "auc": BinaryClassificationEvaluator(labelCol=classify.LABEL, numBins=0),
    }
    for point in points:
        (fit,) = searches.fits([point])
        values = {m: [] for m in evaluators}
        for fold in (0, 1):
            train, test = sampling.fold_pair(bits, fold)
            scored = fit.estimator.fit(train).transform(test)
            for metric, evaluator in evaluators.items():
                values[metric].append(evaluator.evaluate(scored))
        for metric, (a, b) in values.items():
            mean, std, text = got[point.model, point.number, metric]
            assert text == point.text()
            assert (mean, std) == (pytest.approx((a + b) / 2, abs=1e-9), pytest.approx(abs(a - b) / 2, abs=1e-9))


def test_winners_and_their_test_scores(spark, bits, searched):
    points, table = searched
    chosen = searches.winners(table)
    rows = [tuple(r) for r in table.select("model", "metric", "point", "mean_metric").collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE found (model VARCHAR, metric VARCHAR, point INT, mean DOUBLE)")
    con.executemany("INSERT INTO found VALUES (?, ?, ?, ?)", rows)
    want = con.execute(
        "SELECT model, metric, point FROM found QUALIFY row_number() OVER (PARTITION BY model, metric ORDER BY mean DESC, point) = 1"
    ).fetchall()
    assert sorted((r.model, r.metric, r.point) for r in chosen.collect()) == sorted(want)
    train, test = sampling.fold_pair(bits, 0)
    scored = searches.test_scores(chosen, points, train, test, classify.LABEL).collect()
    assert len(scored) == 6
    by_place = {(p.model, p.number): p for p in points}
    for row in scored:
        model = searches.fits([by_place[row.model, row.point]])[0].estimator.fit(train)
        if row.metric == "accuracy":
            truth = models._accuracy_evaluator(classify.LABEL, None).evaluate(model.transform(test))
            assert row.test_score == pytest.approx(truth, abs=1e-12)
        assert 0.5 < row.test_score <= 1


def test_equal_points_give_the_first(spark):
    table = spark.createDataFrame(
        [("m", 2, "c", "rmse", 1.0), ("m", 1, "b", "rmse", 1.0), ("m", 0, "a", "rmse", 3.0), ("m", 0, "a", "auc", 0.7), ("m", 1, "b", "auc", 0.9)],
        "model string, point int, settings string, metric string, mean_metric double",
    )
    assert {(r.metric, r.settings) for r in searches.winners(table).collect()} == {("rmse", "b"), ("auc", "b")}


# -- exact areas per group ----------------------------------------------------


def brute_auc(rows):
    pos = [(s, w) for y, s, w in rows if y == 1 and s is not None]
    neg = [(s, w) for y, s, w in rows if y == 0 and s is not None]
    if not pos or not neg:
        return None
    won = sum(a * b * (1.0 if p > n else 0.5 if p == n else 0.0) for (p, a), (n, b) in itertools.product(pos, neg))
    return won / (sum(w for _, w in pos) * sum(w for _, w in neg))


@pytest.mark.parametrize("ranges", [64, 3, 1])
def test_area_by_group_against_all_pairs(spark, ranges):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(2), rng.choice([None, round(rng.random(), 1), rng.gauss(0, 1)]), rng.randrange(1, 4)) for _ in range(400)]
    rows += [("only", 1, 0.5, 1), ("only", 1, 0.1, 2), ("hot", 1, 0.5, 3)] + [("hot", 0, 0.5, 1)] * 50 + [("hot", 0, 0.1, 1)] * 50
    df = spark.createDataFrame(rows, "g string, y int, s double, w int")
    got = {r.g: r.auc for r in metrics.area_by_group(df, ["g"], "y", "s", "w", ranges).collect()}
    for g in {r[0] for r in rows}:
        assert got[g] == pytest.approx(brute_auc([r[1:] for r in rows if r[0] == g]), abs=1e-12)
    whole = metrics.area_by_group(df, [], "y", "s", ranges=ranges).first()
    assert whole.auc == pytest.approx(brute_auc([(y, s, 1) for _, y, s, _ in rows]), abs=1e-12)
    assert whole.n_pos == sum(y == 1 and s is not None for _, y, s, _ in rows)


def test_area_reads_its_input_lazily(spark):
    scored = spark.range(10).select(F.expr("raise_error('read')").cast("double").alias("s"), F.lit(1).alias("y"))
    metrics.area_by_group(scored, [], "y", "s")


# -- optimality of the linear models ------------------------------------------


def test_residuals_tell_another_penalty(spark):
    right = models.wide_residuals(spark, SMALL).collect()
    assert len(right) == 3 * len(standins.MEDICINES) and all(r.residual < models.TOLERANCE for r in right)
    other = {"poisson": {"reg_param": 0.02}, "logistic_l2": {"reg_param": 0.2}, "logistic_elastic": {"reg_param": 0.01, "elastic_net": 0.6}}
    wrong = models.wide_residuals(spark, SMALL, other).collect()
    for name in other:
        assert sum(r.residual > models.TOLERANCE for r in wrong if r.model == name) > len(standins.MEDICINES) / 2
    assert any(r.coefficient == 0 for r in right if r.model == "logistic_elastic")


def test_flags_travel_as_one_number(spark):
    names = standins.MEDICINES
    rows = models._wide_encoded(spark, SMALL)
    masked, plain = tabular.collapse_flags(rows, names, ["label"]), tabular.collapse(rows, [*names, "label"])
    assert masked.columns == plain.columns
    assert sorted(map(tuple, masked.collect())) == sorted(map(tuple, plain.collect()))
    plan = masked._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "hashpartitioning" in line and "_mask" in line]
    assert keys and not any(name in keys[0].split("hashpartitioning")[1].split(")")[0] for name in names)
    weights = tabular.assemble(tabular.compact(masked), names)
    raw = tabular.assemble(rows, names)
    counted = tabular.logistic_model("label", 0.1).setTol(1e-10).fit(weights)
    every = tabular.logistic_model("label", 0.1, weight=None).setTol(1e-10).fit(raw)
    assert list(counted.coefficients) == pytest.approx(list(every.coefficients), abs=1e-6)


def test_masks_hold_63_flags(spark):
    names = [f"f{i}" for i in range(63)]
    rng = random.Random(1)
    rows = [tuple(rng.randrange(2) for _ in names) for _ in range(20)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    assert sorted(map(tuple, tabular.collapse_flags(df, names).drop(tabular.WEIGHT).collect())) == sorted(rows)
    with pytest.raises(ValueError):
        tabular.collapse_flags(df, [*names, "f0"])


def test_layout_of_collapsed_rows_does_not_follow_the_session(spark):
    rows = models._wide_encoded(spark, SMALL)
    parts = []
    for shuffles in ("3", "11"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        stored = tabular.compact(tabular.collapse_flags(rows, standins.MEDICINES, ["label"]))
        parts.append([tuple(r) for r in stored.collect()])
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert parts[0] == parts[1]


# -- recommender ---------------------------------------------------------------


def test_user_factors_solve_the_normal_equations(spark):
    rng = random.Random(6)
    rows = [(u, i, 2.0 + (u * i) % 3 + rng.random()) for u in range(40) for i in range(50) if u == 0 or rng.random() < 0.3]
    ratings = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    folded = sampling.assign_folds(ratings, ["user_id", "item_id"], 2, 3)
    for fold, (users, items) in recommend.models_per_fold(folded, folds=2, rank=4, regParam=0.05).items():
        train, _ = sampling.fold_pair(folded, fold)
        found = recommend.normal_residuals(train, users, items, 4, 0.05).collect()
        assert len(found) == users.count() and sum(r.n_ratings for r in found) == train.count()
        assert all(r.residual < 1e-4 * r["size"] for r in found)
        for wrong in (recommend.normal_residuals(train, users, items, 4, 0.06),
                      recommend.normal_residuals(train, users.withColumn("features", F.transform("features", lambda x: x * 1.01)), items, 4, 0.05)):
            assert all(r.residual > 1e-4 * r["size"] for r in wrong.collect())


def shuffle_files(spark):
    """Number of shuffle files on this machine's disks."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


@pytest.mark.parametrize("run", ["factors_per_fold", "predictions_per_fold"])
def test_fits_leave_no_shuffles_of_their_iterations(spark, run):
    rows = [(u, i, float((u * i) % 5)) for u in range(30) for i in range(30) if (u + i) % 3]
    ratings = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    folded = sampling.assign_folds(ratings, ["user_id", "item_id"], 2, 3)
    durable.release(spark)
    time.sleep(2)
    before = shuffle_files(spark)
    getattr(recommend, run)(folded, folds=2)
    # the ten iterations of both fits write 40 shuffles of ten tasks with two files each
    assert shuffle_files(spark) < before + 400
    assert recommend.factor_model().getCheckpointInterval() == 1


@pytest.mark.parametrize("run", ["factors_per_fold", "predictions_per_fold", "models_per_fold", "fold_metrics", "item_factors"])
def test_blocks_of_a_model_grow_with_the_ratings(spark, monkeypatch, run):
    """A task builds a whole block in memory, so twice the ratings are dealt out over twice the blocks."""
    rows = [(u, i, float((u * i) % 5)) for u in range(40) for i in range(40)]
    ratings = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    folded = sampling.assign_folds(ratings, ["user_id", "item_id"], 2, 3)
    seen, turns, plain, in_turn = [], [], recommend.factor_model, recommend.in_turn

    def noted(*args, **settings):
        model = plain(*args, **{**settings, "maxIter": 1})
        seen.append((model.getNumUserBlocks(), model.getNumItemBlocks()))
        return model

    monkeypatch.setattr(recommend, "factor_model", noted)
    monkeypatch.setattr(recommend, "in_turn", lambda s, t, n: turns.append(n) or in_turn(s, t, n))
    settings = {"settings": {"1": {}}} if run == "fold_metrics" else {}
    monkeypatch.setattr(recommend, "ALONE_BLOCKS", 20)
    for size, blocks, at_once in ((100, 16, 2), (80, 20, 1)):
        monkeypatch.setattr(recommend, "BLOCK_RATINGS", size)
        if run == "item_factors":
            assert recommend.item_factors(ratings).count() == 40
        else:
            getattr(recommend, run)(folded, folds=2, **settings)
            assert turns.pop() == at_once
        assert set(seen) == {(blocks, blocks)}
        seen.clear()


def test_normal_equations_are_checked_fold_by_fold(spark):
    found = queries()["als_normal_equations"](spark, SMALL)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    rows = found.collect()
    assert sorted(r.fold for r in rows) == [0, 1, 2, 3] and all(r.n_solved == r.n_users for r in rows)


# -- linear searches -------------------------------------------------------------


def test_linear_searches_read_the_tables_once(spark, monkeypatch):
    """And give what each search finds from the tables themselves."""
    monkeypatch.setattr(tabular, "REG_PARAMS", [0.1])
    monkeypatch.setattr(tabular, "ELASTIC_NET_PARAMS", [0.5])
    want = {"poisson": models._cv_glm(spark, SMALL), "logistic_elastic": models._cv_logit_elastic(spark, SMALL)}
    seen, plain = [], standins.encounters
    monkeypatch.setattr(standins, "encounters", lambda s, d: seen.append(d) or plain(s, d))
    found = {r.model: r for r in models._linear_winners(spark, SMALL).collect()}
    assert len(seen) == 1 and set(found) == {"poisson", "logistic_l2", "logistic_elastic"}
    for name, table in want.items():
        assert found[name].mean_metric == pytest.approx(table.first().mean_metric, rel=1e-12)


# -- packed vectors --------------------------------------------------------------


def test_packed_vectors_store_little_and_predict_alike(spark):
    packed = classify.labelled_vectors(standins.packed_vectors(spark, SMALL), "lbl")
    dense = classify.labelled_vectors(standins.challenge_vectors(spark, SMALL), "lbl")
    before = stored_bytes(spark)
    whole = packed.drop("vec_key").persist()
    n = whole.count()
    size = stored_bytes(spark) - before
    whole.unpersist()
    assert 0 < size < 4 * 16 * n
    key = ["vec_key"]
    got = {}
    for name, rows in (("packed", standins.unpacked(packed)), ("dense", dense)):
        rows = rows.repartition(4, *key).sortWithinPartitions(*key)
        scored = classify.tree(maxDepth=5).fit(rows).transform(rows)
        got[name] = {r.vec_key: r.prediction for r in scored.select("vec_key", "prediction").collect()}
    assert got["packed"] == got["dense"]
    first = dense.orderBy("vec_key").first()
    want = [float(b) for digit in first.vec_key for b in f"{int(digit, 16):04b}"]
    assert list(first.features) == want


def test_unpacking_takes_four_bits_at_a_time(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    words = spark.range(8).select(F.col("id").alias("high"), (-F.col("id")).alias("low"))
    plan = standins.unpacked(words)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert 0 < plan.count("shiftright") <= standins.CHALLENGE_BITS // 4


def test_unpacked_words_of_both_signs(spark):
    words = [(0, -1), (-(2**63), 2**63 - 1), (0x0123456789ABCDEF, 1)]
    got = [list(r.features) for r in standins.unpacked(spark.createDataFrame(words, "high long, low long")).collect()]
    want = [[float(b) for w in pair for b in f"{w % 2**64:064b}"] for pair in words]
    assert got == want


def test_curve_scores_the_held_out_rows_once(spark, monkeypatch):
    stored, plain = [], metrics.area_under_roc

    def noted(scored, *args):
        stored.append(scored.storageLevel.useMemory)
        return plain(scored, *args)

    monkeypatch.setattr(metrics, "area_under_roc", noted)
    found = models.challenge_curve(spark, SMALL, {"DT": classify.tree(maxDepth=3)}, sizes=[1.0]).first()
    monkeypatch.undo()
    assert stored == [True]
    train, test = models.challenge_sides(spark, SMALL)
    scored = classify.tree(maxDepth=3).fit(train).transform(test)
    assert found.auc == pytest.approx(metrics.area_under_roc(scored, classify.LABEL))
    assert found.accuracy == pytest.approx(scored.agg(metrics.accuracy(classify.LABEL, "prediction")).first()[0])


def stored_bytes(spark):
    """Bytes that stored frames take."""
    return sum(i.memSize() + i.diskSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())


def test_learning_curve_runs_one_fit_at_a_time(spark, monkeypatch):
    seen = []
    plain = experiments.in_parallel
    monkeypatch.setattr(experiments, "in_parallel", lambda s, tasks, n: seen.append(n) or plain(s, tasks, n))
    curve = models.challenge_curve(spark, SMALL, {"DT": classify.tree(maxDepth=3)}, sizes=[0.3, 1.0])
    assert seen == [1] and {r.datasize for r in curve.collect()} == {0.3, 1.0}


# -- results ----------------------------------------------------------------------


def test_latest_per_key_for_every_kind_of_order(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3]), i, f"t{i:03d}", float(i), f"v{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, major int, minor long, word string, x double, name string")
    for order, values in ((["major", "minor"], ["x"]), (["major", "minor"], ["x", "name"]), (["minor"], ["name"]),
                          (["word"], ["x", "name"]), (["minor", "major"], ["x"]), (["major", "word"], ["name"])):
        want = {}
        for r in rows:
            own = dict(zip(df.columns, r, strict=True))
            place = tuple((own[c] is not None, own[c] or 0 if c != "word" else own[c]) for c in order)
            if own["k"] not in want or place > want[own["k"]][0]:
                want[own["k"]] = (place, tuple(own[v] for v in values))
        got = sets.latest_per_key(df, ["k"], order, values)
        assert got.columns == ["k", *values]
        assert {r.k: tuple(r)[1:] for r in got.collect()} == {k: v for k, (_, v) in want.items()}


@pytest.mark.parametrize("name", ["results_upsert", "results_update"])
def test_upserts_are_hash_aggregated(spark, name):
    df = queries()[name](spark, SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    below = [line for line in plan.splitlines() if "Exchange" in line or " Sort [" in line]
    for i, line in enumerate(below):
        assert " Sort [" not in line or any("Exchange" in later for later in below[i + 1 :])


def test_repeated_jobs_leave_one_row_per_key(spark, tmp_path):
    path, target = str(tmp_path / "log"), str(tmp_path / "kept")
    def rows(value, keys):
        return spark.createDataFrame([(k, value, int(value)) for k in keys], "fold int, rmse double, at int")

    sinks.log_run(rows(1.0, range(4)), path, "a")
    for _ in range(3):
        sinks.log_run(rows(2.0, range(3)), path, "a", 1)
    sinks.log_run(rows(3.0, [1]), path, "2024")
    assert sinks.read_runs(spark, path).count() == 4
    for _ in range(2):
        kept = sinks.compact_runs(spark, path, target, ["fold"], ["at"])
        got = sorted((r.fold, r.rmse, r.run, r.attempt) for r in kept.collect())
        assert got == [(0, 2.0, "a", 1), (1, 3.0, "2024", 0), (2, 2.0, "a", 1)]


def test_tiny_fractions_keep_their_share(spark):
    keys = spark.range(0, 60_000_000, 1, 64)
    assert 10 <= sampling.sample_rows(keys, ["id"], 5e-7, 7).count() <= 55
    assert sampling.sample_rows(spark.range(1000), ["id"], 1.0, 7).count() == 1000
    assert sampling.sample_rows(spark.range(1000), ["id"], 0.0, 7).count() == 0
    assert tables.share_sql("id", 0.5).count(str(2**60)) == 1
