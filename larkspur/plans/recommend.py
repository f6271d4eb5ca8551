"""Recommender: factor models over folds, clusters of items, tag profiles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators import metrics
from larkspur.operators.durable import cut, release, shared_dir, stored
from larkspur.operators.sampling import fold_pair
from larkspur.plans.experiments import in_parallel

# Seed, folds, factor settings, cluster and profile sizes of the
# published analysis.
SEED = 1840977
FOLDS = 4
SETTINGS = {
    "1": {},
    "2": {"rank": 20, "blockSize": 1024, "maxIter": 15},
    "3": {"rank": 40, "blockSize": 1024, "regParam": 0.05},
}
CLUSTERS = 19
TOP_CLUSTERS = 3
TOP_TAGS = 3

#: User and item blocks of a factor model, at least; more ratings get more blocks (``blocks_for``).
BLOCKS = 10
#: Ratings a block may hold.  A task builds a whole block in memory, several times over, and
#: later meets the factors of all that is rated in it.
BLOCK_RATINGS = 2_000_000
#: Fits that run at the same time.  Each keeps its rating blocks and the shuffles of one
#: iteration, so the disk a query needs is a multiple of this.
FITS = 2
#: From so many blocks on a fit runs alone: its tasks fill the cluster, its blocks the memory.
ALONE_BLOCKS = 40
#: Tasks that the check of one user's normal equations may start in.
PIECES = 4
FOLD_SCHEMA = "fold int, setting string, rmse double, mae double"


def typed_ratings(raw: DataFrame) -> DataFrame:
    """Text ratings as long ids and a double."""
    return raw.select(
        F.col("user_id").try_cast("long").alias("user_id"),
        F.col("item_id").try_cast("long").alias("item_id"),
        F.col("rating").try_cast("double").alias("rating"),
    )


def factor_model(blocks: int = BLOCKS, **settings) -> ALS:
    """Alternating least squares over a fixed number of user and item blocks.

    Sums run in block order, so the number follows from the ratings (``blocks_for``) and never from
    the cluster: the same data and seed then give the same model anywhere.  Factors are checkpointed in
    every iteration (where the session has a folder for it, see ``fitted``): only then does
    the fit delete the shuffles behind it, otherwise those of all iterations pile up on disk.
    """
    return ALS(
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        seed=SEED,
        coldStartStrategy="drop",
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=1,
        **settings,
    )


def blocks_for(n_ratings: int) -> int:
    """Blocks of a model of so many ratings: what one task holds does not grow with them."""
    return max(BLOCKS, -(-n_ratings // BLOCK_RATINGS))


def fitted(ratings: DataFrame, blocks: int | None = None, **settings) -> ALSModel:
    """A factor model of the ratings that keeps the shuffles of one iteration on disk."""
    shared_dir(ratings.sparkSession)
    return factor_model(blocks or blocks_for(ratings.count()), **settings).fit(ratings)


def in_turn(spark: SparkSession, tasks: Sequence[Callable], parallelism: int) -> list:
    """Results of the tasks; what a task left on disk is deleted before the next begins."""

    def cleared(task: Callable) -> Callable:
        def run():
            result = task()
            release(spark)
            return result

        return run

    return in_parallel(spark, [cleared(t) for t in tasks], parallelism)


def fitted_in_turn(
    rows: DataFrame, tasks: Callable[[int], Sequence[Callable]], parallelism: int
) -> list:
    """``in_turn`` for fits to parts of ``rows``; ``tasks`` makes them for a number of blocks."""
    blocks = blocks_for(rows.count())
    return in_turn(rows.sparkSession, tasks(blocks), 1 if blocks >= ALONE_BLOCKS else parallelism)


def fold_metrics(
    folded: DataFrame,
    settings: Mapping[str, Mapping] = SETTINGS,
    folds: int = FOLDS,
    parallelism: int = FITS,
) -> DataFrame:
    """RMSE and MAE per fold and setting, trained on the other folds.

    Both errors come from one pass over the predictions; the ratings are kept
    in memory and disk for all fits.
    """
    spark = folded.sparkSession
    rows = folded.persist()

    def one(fold: int, name: str, blocks: int) -> Callable[[], tuple]:
        def run() -> tuple:
            train, test = fold_pair(rows, fold)
            scored = fitted(train, blocks, **settings[name]).transform(test)
            error = scored.agg(
                metrics.rmse("rating", "prediction"), metrics.mae("rating", "prediction")
            ).first()
            return fold, name, error[0], error[1]

        return run

    try:
        results = fitted_in_turn(
            rows, lambda n: [one(fold, name, n) for fold in range(folds) for name in settings], parallelism
        )
    finally:
        rows.unpersist()
    return spark.createDataFrame(results, FOLD_SCHEMA)


def predictions_per_fold(
    folded: DataFrame, folds: int = FOLDS, parallelism: int = FITS
) -> DataFrame:
    """Ratings of every fold with a prediction from a model of the other folds, stored."""
    shared_dir(folded.sparkSession)
    rows = folded.persist()

    def one(fold: int, blocks: int) -> Callable[[], DataFrame]:
        def run() -> DataFrame:
            train, test = fold_pair(rows, fold)
            scored = fitted(train, blocks).transform(test)
            return stored(scored.withColumn("fold", F.lit(fold)), "predictions")

        return run

    try:
        parts = fitted_in_turn(rows, lambda n: [one(f, n) for f in range(folds)], parallelism)
    finally:
        rows.unpersist()
    return reduce(DataFrame.unionByName, parts)


def report(fold_rows: DataFrame, settings: Sequence[str] = tuple(SETTINGS)) -> DataFrame:
    """Fold x (metric per setting) with a mean and a std row below."""
    cells = [
        F.max(F.when(F.col("setting") == s, F.col(m))).alias(f"{m}_{s}")
        for s in settings
        for m in ("rmse", "mae")
    ]
    wide = fold_rows.groupBy("fold").agg(*cells)
    return metrics.with_summary_rows(wide, "fold", wide.columns[1:])


def item_factors(ratings: DataFrame, **settings) -> DataFrame:
    """Latent factors of the items, ``id`` and ``features``."""
    return fitted(ratings, **settings).itemFactors


def factors_per_fold(
    folded: DataFrame, folds: int = FOLDS, parallelism: int = FITS
) -> dict[int, DataFrame]:
    """Item factors of each training side, stored so later steps never refit."""
    shared_dir(folded.sparkSession)
    rows = folded.persist()

    def one(fold: int, blocks: int) -> Callable[[], tuple]:
        return lambda: (fold, cut(item_factors(fold_pair(rows, fold)[0], blocks=blocks)))

    try:
        return dict(fitted_in_turn(rows, lambda n: [one(f, n) for f in range(folds)], parallelism))
    finally:
        rows.unpersist()


def models_per_fold(
    folded: DataFrame, folds: int = FOLDS, parallelism: int = FITS, **settings
) -> dict[int, tuple[DataFrame, DataFrame]]:
    """User and item factors of a model of each training side, stored."""
    shared_dir(folded.sparkSession)
    rows = folded.persist()

    def one(fold: int, blocks: int) -> Callable[[], tuple]:
        def run() -> tuple:
            model = fitted(fold_pair(rows, fold)[0], blocks, **settings)
            return fold, (cut(model.userFactors), cut(model.itemFactors))

        return run

    try:
        return dict(fitted_in_turn(rows, lambda n: [one(f, n) for f in range(folds)], parallelism))
    finally:
        rows.unpersist()


def normal_residuals(
    ratings: DataFrame, users: DataFrame, items: DataFrame, rank: int, reg_param: float
) -> DataFrame:
    """How well each user's factors solve the normal equations of their ratings.

    The last half-step of alternating least squares makes a user's factors x the solution of
    ``(sum v v' + reg n I) x = sum r v`` over the factors v of the n rated items.  The left side
    minus the right is ``sum (v.x - r) v + reg n x``: the product of the partial Gram matrices
    with x, without building them.  Ratings meet the item factors first, so that each travels with
    one factor once, and then those of their user, each user ``PIECES`` times: a user's sums start
    in as many tasks, and only sums of ``rank`` numbers per user and piece travel on.
    Columns: id, n_ratings, residual, size (of the right side); users without ratings have none.
    """
    own = users.select(F.col("id").alias("user_id"), F.col("features").alias("_x"))
    split = own.select("*", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))).alias("_piece"))
    other = items.select(F.col("id").alias("item_id"), F.col("features").alias("_v"))
    placed_items = ratings.select("user_id", "item_id", "rating").join(other, "item_id")
    piece = F.pmod(F.xxhash64("item_id"), F.lit(PIECES)).cast("int").alias("_piece")
    met = placed_items.select("user_id", piece, "rating", "_v").join(split, ["user_id", "_piece"])
    product = F.aggregate(
        F.zip_with("_x", "_v", lambda x, v: x.cast("double") * v.cast("double")),
        F.lit(0.0),
        lambda total, term: total + term,
    )
    error = met.withColumn("_e", product - F.col("rating"))
    place = [F.get("_v", F.lit(k)).cast("double") for k in range(rank)]
    left_names = [f"_g{k}" for k in range(rank)]
    right_names = [f"_b{k}" for k in range(rank)]
    pieces = error.groupBy("user_id", "_piece").agg(
        F.count(F.lit(1)).alias("n_ratings"),
        *[F.sum(F.col("_e") * v).alias(name) for name, v in zip(left_names, place)],
        *[F.sum(F.col("rating") * v).alias(name) for name, v in zip(right_names, place)],
    )
    sums = pieces.groupBy("user_id").agg(
        *[F.sum(name).alias(name) for name in ("n_ratings", *left_names, *right_names)]
    )
    placed = sums.join(own, "user_id")
    left = [
        F.col(f"_g{k}") + reg_param * F.col("n_ratings") * F.get("_x", F.lit(k)) for k in range(rank)
    ]

    def norm(parts):
        return F.sqrt(reduce(lambda a, b: a + b, [p * p for p in parts]))

    return placed.select(
        F.col("user_id").alias("id"),
        "n_ratings",
        norm(left).alias("residual"),
        norm([F.col(f"_b{k}") for k in range(rank)]).alias("size"),
    )


def fit_clusters(factors: DataFrame, k: int = CLUSTERS) -> KMeansModel:
    return KMeans(k=k, seed=SEED, featuresCol="features").fit(factors)


def misplaced(
    assigned: DataFrame, model: KMeansModel, cluster: str, tolerance: float = 1e-6
) -> DataFrame:
    """Rows, and rows that have a centre nearer than that of their cluster.

    The centres go into the plan as literals: ``k`` of them, whatever the rows.
    """
    is_array = isinstance(assigned.schema["features"].dataType, T.ArrayType)
    features = F.col("features") if is_array else vector_to_array("features")
    centres = [F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()]
    squared = [
        F.aggregate(
            F.zip_with(features, c, lambda x, y: (x - y) * (x - y)),
            F.lit(0.0),
            lambda total, term: total + term,
        )
        for c in centres
    ]
    measured = assigned.select(cluster, F.array(*squared).alias("far"))
    own = F.element_at("far", F.col(cluster) + 1)
    return measured.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(own > F.array_min("far") + tolerance).alias("n_misplaced"),
        F.countDistinct(cluster).alias("n_clusters"),
    )


def assign_clusters(factors: DataFrame, k: int = CLUSTERS) -> DataFrame:
    """Items with the cluster of their factors."""
    return (
        fit_clusters(factors, k)
        .transform(factors)
        .select("id", F.col("prediction").alias("cluster"))
    )


def clusters_per_fold(
    factors: Mapping[int, DataFrame], k: int = CLUSTERS, parallelism: int = 4
) -> DataFrame:
    """Items of every fold with the cluster of their factors in that fold."""

    def one(fold: int) -> Callable[[], DataFrame]:
        return lambda: assign_clusters(factors[fold], k).select(F.lit(fold).alias("fold"), "*")

    spark = next(iter(factors.values())).sparkSession
    return reduce(DataFrame.union, in_parallel(spark, [one(f) for f in factors], parallelism))


def cluster_sizes(assigned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return assigned.groupBy(*by, "cluster").agg(F.count(F.lit(1)).alias("n_items"))


def largest_clusters(
    assigned: DataFrame, by: Sequence[str] = (), k: int = TOP_CLUSTERS
) -> DataFrame:
    """The ``k`` clusters with most items (per ``by``); the lower id wins a tie.

    Ranked are cluster sizes, at most the number of clusters per group.
    """
    sizes = cluster_sizes(assigned, by)
    order = [F.desc("n_items"), F.asc("cluster")]
    if not by:
        return sizes.orderBy(*order).limit(k)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return sizes.select("*", place.alias("_place")).filter(F.col("_place") <= k).drop("_place")


def cluster_item_scores(assigned: DataFrame, scores: DataFrame) -> DataFrame:
    """Tag scores of every assigned item."""
    return assigned.join(scores, assigned["id"] == scores["item_id"]).drop("item_id")


def tag_scores(item_scores: DataFrame, by: Sequence[str] = ("cluster",)) -> DataFrame:
    """Summed relevance of each tag (per ``by``); decimals add up in any order."""
    return item_scores.groupBy(*by, "tag_id").agg(F.sum("relevance").alias("sum_score"))


def extreme_tags(
    scored: DataFrame, by: Sequence[str], k: int = TOP_TAGS, lowest: bool = False
) -> DataFrame:
    """The ``k`` tags with the highest (or lowest) sum per group; lower id wins a tie.

    Row numbers have no ties, so every task passes on ``k`` rows per group at
    most, and no task meets all tags of a group.
    """
    score = F.col("sum_score").asc() if lowest else F.col("sum_score").desc()
    place = F.row_number().over(Window.partitionBy(*by).orderBy(score, F.asc("tag_id")))
    return scored.select("*", place.alias("place")).filter(F.col("place") <= k)


def name_tags(tags: DataFrame, names: DataFrame) -> DataFrame:
    """Tag names next to the tag ids."""
    return tags.join(names, "tag_id")


def name_tags_keep_both(tags: DataFrame, names: DataFrame) -> DataFrame:
    """The same lookup with the key of either side."""
    named = names.select(F.col("tag_id").alias("name_tag_id"), "tag")
    return tags.join(named, tags["tag_id"] == named["name_tag_id"])


def profile(
    assigned: DataFrame, scores: DataFrame, names: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Top tags, with names, of the largest clusters (per ``by``), in one plan.

    The largest clusters are ``TOP_CLUSTERS`` rows per group of ``by``, so they
    are broadcast and cut the items down before the score join.
    """
    keys = [*by, "cluster"]
    top = largest_clusters(assigned, by)
    kept = assigned.join(F.broadcast(top), keys)
    scored = tag_scores(cluster_item_scores(kept, scores), [*keys, "n_items"])
    return name_tags(extreme_tags(scored, [*keys, "n_items"]), names)
