"""Recommender, clustering and tag-profile queries."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators import sampling
from larkspur.operators.durable import cut, shared_path
from larkspur.plans import recommend
from larkspur.registry.tables import RATINGS_SQL, bucket_sql
from larkspur.sources import standins
from larkspur.sources.readers import table
from larkspur.sources.sinks import save_model

RANKED_BY = ["cluster"]


def _folded(s, d):
    return sampling.assign_folds(
        standins.ratings(s, d), ["user_id", "item_id"], recommend.FOLDS, recommend.SEED
    )


def _als_predict(s, d):
    """Predictions for every fold, each from a model of the other folds."""
    return recommend.predictions_per_fold(_folded(s, d)).select(
        "fold",
        F.col("user_id").cast("long").alias("user_id"),
        F.col("item_id").cast("long").alias("item_id"),
        "rating",
        "prediction",
    )


def _als_item_factors(s, d):
    """Item factors of every fold's training side."""
    factors = recommend.factors_per_fold(_folded(s, d))
    return reduce(
        DataFrame.unionByName,
        [part.withColumn("fold", F.lit(fold)) for fold, part in sorted(factors.items())],
    )


def _finite(value):
    return value.isNotNull() & ~F.isnan(value)


def _als_coverage(s, d):
    """Which test ratings get a prediction: those whose user and item were trained on."""
    return _als_predict(s, d).select(
        "fold", "user_id", "item_id", "rating", _finite(F.col("prediction")).alias("finite")
    )


def _als_factor_shape(s, d):
    """Items with factors, how many each has, and whether all are finite."""
    return _als_item_factors(s, d).select(
        "fold",
        "id",
        F.size("features").alias("n_factors"),
        F.forall("features", _finite).alias("finite"),
    )


#: Rank and penalty of the model with default settings, and the share of the right side of the
#: normal equations that 32-bit factors may leave over.
RANK, PENALTY, LEFT_OVER = 10, 0.1, 1e-4


def _als_normal_equations(s, d):
    """Users whose factors solve the normal equations of the ratings they were fitted to, per fold."""
    folded = _folded(s, d)
    models = recommend.models_per_fold(folded)
    rows = folded.persist()

    def check(fold):
        train, _ = sampling.fold_pair(rows, fold)
        at = recommend.normal_residuals(train, *models[fold], RANK, PENALTY)
        solved = F.col("residual") <= LEFT_OVER * F.col("size")
        return cut(
            at.agg(
                F.count(F.lit(1)).alias("n_users"),
                F.sum("n_ratings").alias("n_ratings"),
                F.count_if(solved).alias("n_solved"),
            ).select(F.lit(fold).alias("fold"), "*")
        )

    try:
        parts = recommend.in_turn(s, [partial(check, fold) for fold in sorted(models)], 1)
    finally:
        rows.unpersist()
    return reduce(DataFrame.unionByName, parts)


def _fold_metrics(s, d):
    return recommend.fold_metrics(_folded(s, d))


def _als_report(s, d):
    return recommend.report(_fold_metrics(s, d))


def _als_report_checked(s, d):
    """Rows of the report: whether each fold has all metrics and the last rows are their mean and deviation."""
    found = cut(_fold_metrics(s, d))
    lines = recommend.report(found)
    names = lines.columns[1:]
    wide = found.groupBy("fold").pivot("setting", list(recommend.SETTINGS)).agg(F.first("rmse").alias("rmse"), F.first("mae").alias("mae"))
    stacked = wide.select("fold", *[F.col(f"{n.split('_')[1]}_{n.split('_')[0]}").alias(n) for n in names])
    plain = stacked.agg(
        *[F.avg(n).alias(f"{n}_mean") for n in names],
        *[F.sqrt(F.var_samp(n)).alias(f"{n}_std") for n in names],
    )
    want = plain.select(
        F.inline(F.array(*[F.struct(F.lit(kind).alias("row"), *[F.col(f"{n}_{kind}").alias(f"want_{n}") for n in names]) for kind in ("mean", "std")]))
    ).unionByName(stacked.select(F.col("fold").cast("string").alias("row"), *[F.col(n).alias(f"want_{n}") for n in names]))
    close = [F.abs(F.col(n) - F.col(f"want_{n}")) < 1e-9 for n in names]
    bounded = [F.col(f"mae_{k}") <= F.col(f"rmse_{k}") + 1e-12 for k in recommend.SETTINGS]
    ok = reduce(lambda a, b: a & b, [*close, *bounded]) if names else F.lit(False)
    met = lines.join(want, lines["fold"] == want["row"])
    same = reduce(lambda a, b: a & b, close)
    return met.select("fold", F.when(F.col("fold") == "std", same).otherwise(ok).alias("right"))


def _vectors(s, d):
    return table(s, d, "embeddings").select(
        F.col("vec_id").alias("id"), array_to_vector("embedding").alias("features")
    )


def _kmeans_assign(s, d):
    """Clusters of the embeddings, checked against the distances to all centres."""
    rows = _vectors(s, d).persist()
    try:
        model = recommend.fit_clusters(rows)
    finally:
        rows.unpersist()
    return recommend.misplaced(model.transform(rows), model, "prediction")


def _kmeans_roundtrip(s, d):
    """A stored and loaded model places every row as the fitted one does."""
    rows = _vectors(s, d).persist()
    try:
        model = recommend.fit_clusters(rows)
    finally:
        rows.unpersist()
    loaded = KMeansModel.load(save_model(model, shared_path(s, "kmeans")))
    fitted = model.transform(rows).withColumnRenamed("prediction", "before")
    return loaded.transform(fitted).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("before") == F.col("prediction")).alias("n_same"),
    )


def _item_scores(s, d):
    return recommend.cluster_item_scores(
        standins.fixed_clusters(s, d), standins.item_tag_scores(s, d)
    )


def _tag_scores(s, d):
    return recommend.tag_scores(_item_scores(s, d))


def _as_double(df, *columns):
    return df.select(
        *[F.col(c).cast("double").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def _cluster_tags(s, d, lowest=False):
    tags = recommend.extreme_tags(_tag_scores(s, d), RANKED_BY, lowest=lowest)
    return _as_double(recommend.name_tags(tags, standins.tag_names(s, d)), "sum_score")


def _overall_tags(s, d):
    """The three tags with the highest sum over all clusters."""
    totals = recommend.tag_scores(_item_scores(s, d), ())
    return totals.orderBy(F.desc("sum_score"), "tag_id").limit(recommend.TOP_TAGS)


def _fixed_profile(s, d):
    """Profile of the largest clusters of the given assignment."""
    rows = recommend.profile(
        standins.fixed_clusters(s, d), standins.item_tag_scores(s, d), standins.tag_names(s, d)
    )
    return _as_double(rows, "sum_score")


def _cluster_profile(s, d):
    """Factors per fold, clusters per fold, tags of each fold's largest clusters."""
    assigned = recommend.clusters_per_fold(recommend.factors_per_fold(_folded(s, d)))
    return _as_double(
        recommend.profile(
            assigned, standins.item_tag_scores(s, d), standins.tag_names(s, d), by=["fold"]
        ),
        "sum_score",
    )


QUERIES = {
    "cluster_item_scores": lambda s, d: _as_double(_item_scores(s, d), "relevance"),
    "tag_scores": lambda s, d: _as_double(_tag_scores(s, d), "sum_score"),
    "tag_lookup": lambda s, d: _as_double(
        recommend.name_tags(_overall_tags(s, d), standins.tag_names(s, d)), "sum_score"
    ),
    "tag_lookup_both_keys": lambda s, d: _as_double(
        recommend.name_tags_keep_both(_overall_tags(s, d), standins.tag_names(s, d)),
        "sum_score",
    ),
    "cluster_top3": lambda s, d: recommend.largest_clusters(standins.fixed_clusters(s, d)),
    "cluster_tags": _cluster_tags,
    "cluster_tags_bottom": lambda s, d: _cluster_tags(s, d, lowest=True),
    "cluster_profile_fixed": _fixed_profile,
    "als_predict": _als_predict,
    "als_item_factors": _als_item_factors,
    "als_coverage": _als_coverage,
    "als_factor_shape": _als_factor_shape,
    "als_normal_equations": _als_normal_equations,
    "als_fold_metrics": _fold_metrics,
    "als_report": _als_report,
    "als_report_checked": _als_report_checked,
    "kmeans_assign": _kmeans_assign,
    "kmeans_roundtrip": _kmeans_roundtrip,
    "cluster_profile": _cluster_profile,
}

_SCORES = """
scores AS (
  SELECT l_partkey AS item_id, s_nationkey AS tag_id,
         CAST(round(CAST(sum(CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) / count(*), 6)
              AS DECIMAL(18,6)) AS relevance
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
item_scores AS (
  SELECT vec_id AS id, label AS cluster, tag_id, relevance
  FROM embeddings JOIN scores ON item_id = vec_id),
tag_sums AS (
  SELECT cluster, tag_id, sum(relevance) AS sum_score FROM item_scores GROUP BY 1, 2),
names AS (SELECT n_nationkey AS tag_id, n_name AS tag FROM nation)"""

_OVERALL = f"""{_SCORES},
overall AS (SELECT tag_id, sum(relevance) AS sum_score FROM item_scores GROUP BY 1
            ORDER BY sum_score DESC, tag_id LIMIT 3)"""


def _places(order):
    return f"""WITH {_SCORES}
        SELECT tag_id, cluster, CAST(sum_score AS DOUBLE) AS sum_score,
               CAST(place AS INTEGER) AS place, tag
        FROM (SELECT *, row_number() OVER (PARTITION BY cluster
                ORDER BY sum_score {order}, tag_id) AS place FROM tag_sums)
        JOIN names USING (tag_id) WHERE place <= 3"""


_FOLDED = f"""{RATINGS_SQL},
folded AS (
  SELECT *, {bucket_sql("user_id || ':' || item_id", recommend.FOLDS, recommend.SEED)} AS fold
  FROM ratings)"""

ORACLES = {
    "als_coverage": f"""WITH {_FOLDED},
        seen_users AS (SELECT DISTINCT user_id, fold FROM folded),
        seen_items AS (SELECT DISTINCT item_id, fold FROM folded)
        SELECT CAST(fold AS INTEGER) AS fold, user_id, item_id, rating, true AS finite
        FROM folded f
        WHERE EXISTS (SELECT 1 FROM seen_users u WHERE u.user_id = f.user_id AND u.fold <> f.fold)
          AND EXISTS (SELECT 1 FROM seen_items i WHERE i.item_id = f.item_id AND i.fold <> f.fold)""",
    "als_normal_equations": f"""WITH {_FOLDED}
        SELECT CAST(h.fold AS INTEGER) AS fold, count(DISTINCT user_id) AS n_users,
               count(*) AS n_ratings, count(DISTINCT user_id) AS n_solved
        FROM folded f JOIN (SELECT DISTINCT fold FROM folded) h ON f.fold <> h.fold
        GROUP BY h.fold""",
    "als_report_checked": f"""WITH {_FOLDED}
        SELECT DISTINCT fold::VARCHAR AS fold, true AS "right" FROM folded
        UNION ALL SELECT 'mean', true UNION ALL SELECT 'std', true""",
    "als_factor_shape": f"""WITH {_FOLDED}
        SELECT DISTINCT CAST(h.fold AS INTEGER) AS fold, CAST(item_id AS INTEGER) AS id,
               10::INTEGER AS n_factors, true AS finite
        FROM folded f JOIN (SELECT DISTINCT fold FROM folded) h ON f.fold <> h.fold""",
    "cluster_item_scores": f"""WITH {_SCORES}
        SELECT id, cluster, tag_id, CAST(relevance AS DOUBLE) AS relevance FROM item_scores""",
    "tag_scores": f"""WITH {_SCORES}
        SELECT cluster, tag_id, CAST(sum_score AS DOUBLE) AS sum_score FROM tag_sums""",
    "tag_lookup": f"""WITH {_OVERALL}
        SELECT tag_id, CAST(sum_score AS DOUBLE) AS sum_score, tag
        FROM overall JOIN names USING (tag_id)""",
    "tag_lookup_both_keys": f"""WITH {_OVERALL}
        SELECT o.tag_id, CAST(sum_score AS DOUBLE) AS sum_score, n.tag_id AS name_tag_id, tag
        FROM overall o JOIN names n ON o.tag_id = n.tag_id""",
    "cluster_top3": """SELECT label AS cluster, count(*) AS n_items FROM embeddings
        GROUP BY label ORDER BY n_items DESC, cluster LIMIT 3""",
    "cluster_tags": _places("DESC"),
    "cluster_tags_bottom": _places("ASC"),
    "cluster_profile_fixed": f"""WITH {_SCORES},
        largest AS (SELECT label AS cluster, count(*) AS n_items FROM embeddings
                    GROUP BY label ORDER BY n_items DESC, cluster LIMIT 3)
        SELECT tag_id, cluster, n_items, CAST(sum_score AS DOUBLE) AS sum_score,
               CAST(place AS INTEGER) AS place, tag
        FROM (SELECT *, row_number() OVER (PARTITION BY cluster
                ORDER BY sum_score DESC, tag_id) AS place
              FROM tag_sums JOIN largest USING (cluster))
        JOIN names USING (tag_id) WHERE place <= 3""",
    "kmeans_assign": """SELECT count(*) AS n_rows, 0::BIGINT AS n_misplaced,
        19::BIGINT AS n_clusters FROM embeddings""",
    "kmeans_roundtrip": "SELECT count(*) AS n_rows, count(*) AS n_same FROM embeddings",
}
