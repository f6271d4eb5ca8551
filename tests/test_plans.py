"""What the physical plans must and must not contain."""

import pytest
from __spark_entry__ import queries
from conftest import CHECKED
from larkspur.registry import recommend, tables, weblog

PLAIN = sorted([*weblog.QUERIES, *tables.QUERIES, "cluster_tags", "cluster_profile_fixed"])


def final_plan(spark, name):
    df = queries()[name](spark, CHECKED)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", PLAIN)
def test_no_products_and_no_python(spark, name):
    plan = final_plan(spark, name)
    for word in ("Cartesian", "NestedLoop", "Python", "Pandas"):
        assert word not in plan


@pytest.mark.parametrize(
    "name",
    ["log_top9_rest", "log_host_rank", "log_share", "log_country_slice", "log_top_host",
     "log_heatmap", "log_busy_hours", "metric_table"],
)
def test_tables_are_scanned_once(spark, name):
    plan = final_plan(spark, name)
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_ranking_windows_never_see_items(spark):
    plan = final_plan(spark, "log_host_rank")
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert len(windows) == 1 and "sum(items" in windows[0] and "host" not in windows[0]


def test_tag_places_are_cut_down_before_the_shuffle(spark):
    assert final_plan(spark, "cluster_tags").count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["sample_hash", "sample_stratified", "split_train_test", "kfold_assign"])
def test_sampling_does_not_shuffle(spark, name):
    assert "Exchange" not in final_plan(spark, name)


def test_scans_read_the_needed_columns_only(spark):
    plan = final_plan(spark, "eval_rmse_mae")
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in plan
    plan = final_plan(spark, "tag_scores")
    assert "l_extendedprice" not in plan


def test_filters_reach_the_scan(spark):
    assert "GreaterThanOrEqual(value,100.0)" in final_plan(spark, "results_update")


def test_registry_names_are_unique():
    names = [n for m in (weblog, tables, recommend) for n in m.QUERIES]
    assert len(names) == len(set(names))


def test_a_hot_level_is_split_and_keeps_every_row(spark):
    """Most items share one count: the join back to the levels must not gather them."""
    from larkspur.operators.ranking import rank_in_group
    from pyspark.sql import functions as F

    items = spark.range(300_000).select(
        F.lit("other").alias("country"),
        F.sha2(F.col("id").cast("string"), 256).alias("host"),
        F.when(F.col("id") % 20 == 0, F.col("id") % 997 + 2).otherwise(1).alias("n"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ranked = rank_in_group(items, "country")
        spread = ranked.groupBy("rnk").agg(
            F.count(F.lit(1)).alias("rows"), F.max(F.length("host"))
        )
        rows = {r.rnk: r.rows for r in spread.collect()}
        plan = spread._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in plan
    assert sum(rows.values()) == 300_000
    assert rows[15_001] == 285_000  # all hot items, ranked behind the 15,000 others
