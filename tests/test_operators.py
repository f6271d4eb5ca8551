"""Operators against brute force, on skewed and awkward rows."""

import itertools
import random
from collections import Counter

import pytest
from larkspur.functions.columns import flags, signed_label, strings_to_double
from larkspur.operators import durable, layout, metrics, ranking, sampling, sets
from larkspur.plans import experiments
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F


def skewed_counts(groups=3, items=400, seed=5):
    """Group 0 holds most items, and most items have count 1."""
    rng = random.Random(seed)
    rows = []
    for i in range(items):
        group = 0 if i % 3 else rng.randrange(groups)
        rows.append((f"g{group}" if group < groups - 1 else None, f"i{i}",
                     1 if rng.random() < 0.6 else rng.randrange(1, 40)))
    return rows


def brute_rank(rows):
    return {
        item: 1 + sum(1 for g, _, m in rows if g == group and m > n) for group, item, n in rows
    }


def test_rank_without_a_window_over_items(spark):
    rows = skewed_counts()
    counted = spark.createDataFrame(rows, "g string, item string, n long")
    got = {r.item: r.rnk for r in ranking.rank_in_group(counted, "g").collect()}
    assert got == brute_rank(rows)


def test_top_k_and_rest(spark):
    rows = skewed_counts()
    rank = brute_rank(rows)
    counted = spark.createDataFrame(rows, "g string, item string, n long")
    top = {r.item for r in ranking.top_k(counted, "g", 4).collect()}
    assert top == {item for _, item, _ in rows if rank[item] <= 4}
    got = {(r.g, r.item, r.rnk): r.n
           for r in ranking.top_k_with_rest(counted, "g", "item", 4, "rest").collect()}
    want = Counter()
    for group, item, n in rows:
        key = (group, item, rank[item]) if rank[item] <= 4 else (group, "rest", 0)
        want[key] += n
    assert got == want


def test_top_k_when_every_item_ties(spark):
    counted = spark.createDataFrame([("g", f"i{i}", 1) for i in range(50)], "g string, item string, n long")
    assert ranking.top_k(counted, "g", 3).count() == 50


def test_samples_are_nested_and_layout_free(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    small = {r.k for r in sampling.sample_rows(rows, ["k"], 0.1, 7).collect()}
    large = {r.k for r in sampling.sample_rows(rows.repartition(5), ["k"], 0.3, 7).collect()}
    assert small < large
    assert abs(len(small) - 2000) < 150 and abs(len(large) - 6000) < 300


def test_split_sides_are_complements(spark):
    rows = spark.range(9_000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"))
    shares = {0: 0.8, 1: 0.25}
    split = sampling.split_strata(rows, "s", ["k"], shares, 3)
    train = {r.k for r in split.filter("split = 'train'").collect()}
    assert train == {r.k for r in sampling.sample_strata(rows, "s", ["k"], shares, 3).collect()}
    per = Counter(k % 3 for k in train)
    assert abs(per[0] - 2400) < 90 and abs(per[1] - 750) < 90 and per[2] == 0
    assert split.count() == 9_000


def test_folds_cover_all_rows_once(spark):
    folded = sampling.assign_folds(spark.range(4_000), ["id"], 4, 1)
    sizes = {r.fold: r["count"] for r in folded.groupBy("fold").count().collect()}
    assert set(sizes) == {0, 1, 2, 3} and sum(sizes.values()) == 4_000
    train, test = sampling.fold_pair(folded, 2)
    assert train.count() + test.count() == 4_000 and test.count() == sizes[2]


def test_except_distinct_is_null_safe_and_deduplicates(spark):
    left = [(1, "a"), (1, "a"), (None, "b"), (None, None), (2, None), (3, "c")] + [(7, "hot")] * 500
    right = [(None, "b"), (2, None), (9, "z")]
    a = spark.createDataFrame(left, "x int, y string")
    b = spark.createDataFrame(right, "p int, q string")
    got = sets.except_distinct(a, b)
    assert got.columns == ["x", "y"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == set(left) - set(right)
    assert sorted(map(str, rows)) == sorted(str(tuple(r)) for r in a.subtract(b.toDF("x", "y")).collect())


def test_latest_and_update(spark):
    rows = [("k", i, float(i)) for i in range(300)] + [("m", 5, 1.0), ("m", 4, 9.0)]
    results = spark.createDataFrame(rows, "key string, seq int, value double")
    latest = {r.key: r.value for r in sets.latest_per_key(results, ["key"], ["seq"], ["value"]).collect()}
    assert latest == {"k": 299.0, "m": 1.0}
    log = spark.createDataFrame([("k", 0.0, "x"), ("other", -1.0, "y")], "key string, value double, note string")
    updated = {r.key: (r.value, r.note)
               for r in sets.update_log(log, results, ["key"], ["seq"], ["value"]).collect()}
    assert updated == {"k": (299.0, "x"), "other": (-1.0, "y")}


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y",)], "name string")
    assert {tuple(r) for r in sets.union_by_name(a, b).collect()} == {(1, "x"), (None, "y")}


def brute_auc(rows):
    pos = [(s, w) for y, s, w in rows if y == 1]
    neg = [(s, w) for y, s, w in rows if y == 0]
    wins = sum(wp * wn * (1.0 if p > n else 0.5 if p == n else 0.0)
               for (p, wp), (n, wn) in itertools.product(pos, neg))
    return wins / (sum(w for _, w in pos) * sum(w for _, w in neg))


def test_area_under_roc_with_ties_and_weights(spark):
    rng = random.Random(2)
    rows = [(float(rng.random() < 0.4), round(rng.random(), 2), float(rng.randrange(1, 4)))
            for _ in range(1500)]
    scored = spark.createDataFrame(rows, "y double, score double, w double")
    plain = [(y, s, 1.0) for y, s, _ in rows]
    assert metrics.area_under_roc(scored, "y", "score") == pytest.approx(brute_auc(plain), abs=1e-12)
    assert metrics.area_under_roc(scored, "y", "score", "w") == pytest.approx(brute_auc(rows), abs=1e-12)


def test_weighted_errors_equal_repeated_rows(spark):
    rows = [(1.0, 2.0, 3), (4.0, 4.0, 1), (0.0, 5.0, 2)]
    weighted = spark.createDataFrame(rows, "y double, p double, w int")
    repeated = spark.createDataFrame([(y, p) for y, p, w in rows for _ in range(w)], "y double, p double")
    for metric in (metrics.rmse, metrics.mae, metrics.accuracy):
        a = weighted.agg(metric("y", "p", "w")).first()[0]
        assert a == pytest.approx(repeated.agg(metric("y", "p")).first()[0])


def test_summary_rows_are_over_the_metric_rows_only(spark):
    folds = spark.createDataFrame([(i, float(i)) for i in range(4)], "fold int, m double")
    table = {r.fold: r.m for r in metrics.with_summary_rows(folds, "fold", ["m"]).collect()}
    assert table["mean"] == 1.5 and table["std"] == pytest.approx(1.2909944487)
    assert len(table) == 6


def test_bulk_casts_flags_and_labels(spark):
    rows = spark.createDataFrame([("1.5", "No", 3), ("x", "no", 4), (None, None, 5)], "a string, b string, c int")
    cast = rows.select(*strings_to_double(rows))
    assert [t for _, t in cast.dtypes] == ["double", "double", "int"]
    assert [r.a for r in cast.collect()] == [1.5, None, None]
    assert [r.b for r in rows.select(*flags({"b": "No"})).collect()] == [0, 1, 1]
    labels = spark.createDataFrame([("-1",), ("1",), ("x",), (None,)], "v string")
    assert [r[0] for r in labels.select(signed_label(F.col("v"))).collect()] == [0.0, 1.0, 1.0, 1.0]


def test_grid_has_every_combination(spark):
    models = spark.createDataFrame([("RF",), ("GBT",)], "model string")
    grid = experiments.experiment_grid(models)
    assert grid.count() == 2 * len(experiments.SIZES)
    assert grid.first().runtime == experiments.INITIAL_RUNTIME


def test_sample_sizes_equal_real_samples(spark):
    rows = spark.range(5_000)
    sizes = {r.datasize: r.n_rows for r in experiments.sample_sizes(rows, ["id"], 3).collect()}
    for size in (0.05, 0.5, 1.0):
        assert sizes[size] == sampling.sample_rows(rows, ["id"], size, 3).count()


def test_cut_keeps_rows_in_the_shared_folder(spark):
    folder = durable.shared_dir(spark)
    stored = durable.cut(spark.range(100))
    assert stored.count() == 100
    assert durable.shared_path(spark, "x").startswith(folder)
    assert "Scan ExistingRDD" in stored._jdf.queryExecution().executedPlan().toString()


def test_spread_is_the_same_for_any_input_layout(spark):
    layouts = [spark.range(0, 1000, 1, n) for n in (1, 13)]
    parts = [
        {r.id: r.part for r in layout.spread(df, ["id"]).selectExpr("id", "spark_partition_id() part").collect()}
        for df in layouts
    ]
    assert parts[0] == parts[1] and len(set(parts[0].values())) > layout.PARTS // 2


def test_area_moves_the_scores_once(spark):
    """The evaluator sorts them in several passes; one class only gives what it gives, too."""
    rng = random.Random(5)
    for name, rows in {
        "both": [(float(rng.random() < 0.4), rng.randrange(40) / 8, rng.randrange(1, 4)) for _ in range(500)],
        "negatives": [(0.0, float(i % 3), 1) for i in range(9)],
        "positives": [(1.0, float(i % 3), 1) for i in range(9)],
    }.items():
        scored = spark.createDataFrame(rows, "y double, score double, w long").repartition(7).persist()
        scored.count()
        want = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0).setWeightCol("w").evaluate(scored)
        spark.sparkContext.setJobGroup(name, name)
        found = metrics.area_under_roc(scored, "y", "score", "w")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(name)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert found == pytest.approx(want, abs=1e-12), name
        # ranges of the scores, the scores dealt out, the sums
        assert 0 < len(jobs) <= 3, name


def test_equal_rows_collapse_where_they_are(spark):
    rows = spark.createDataFrame([(float(i % 2), i % 3) for i in range(600)], "a double, b int").repartition(4).persist()
    found = metrics.collapsed(rows, ["a", "b"])
    assert found.count() <= 4 * 6
    assert {(r.a, r.b): r.n for r in found.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()} == {(a, b): 100 for a in (0.0, 1.0) for b in range(3)}
