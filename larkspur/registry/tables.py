"""Encoding, sampling, set, metric and experiment queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larkspur.functions.columns import binary_label, strings_to_double
from larkspur.functions.hashing import FRACTION_BITS, hash_bucket
from larkspur.operators import metrics, sampling, sets
from larkspur.operators.durable import shared_path
from larkspur.operators.ranking import count_rows
from larkspur.plans import classify, experiments, recommend, tabular
from larkspur.sources import sinks, standins
from larkspur.sources.readers import table

SEED = tabular.SEED
STRATA = {"O": 0.8, "F": 0.5, "P": 0.25}
SAMPLE = 0.1
FOLDS = 4
SUMMARISED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Three predictors of the quantity of a line, each a formula over its own row.
PREDICTORS = {
    "1": "l_extendedprice / 2000",
    "2": "l_extendedprice / 1500",
    "3": "25.5 - 10 * l_discount",
}
METRIC_COLUMNS = [f"{m}_{p}" for p in PREDICTORS for m in ("rmse", "mae")]


def _encoded(s, d):
    return tabular.encode(
        standins.encounters(s, d), standins.ENCOUNTER_OFF, "outcome", "O",
        keep=["encounter_id", "stay"],
    )


def _orders(s, d):
    return table(s, d, "orders")


def _labelled_orders(s, d):
    return _orders(s, d).select(
        "o_orderkey", "o_orderstatus", binary_label(F.col("o_orderstatus"), "O").alias("label")
    )


def _raw_ratings(s, d):
    rows = standins.ratings(s, d)
    return rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])


def _feature_cells(s, d):
    rows = classify.typed_vectors(standins.bit_vectors(s, d), "lbl")
    vectors = classify.with_features(rows, standins.BIT_COLUMNS)
    return vectors.select(
        "vec_id", "labels", F.posexplode(vector_to_array("features")).alias("pos", "value")
    )


def _customer_and_supplier(s, d):
    upper = table(s, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    lower = table(s, d, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
    )
    return sets.union_by_name(upper, lower)


def _except(s, d):
    pairs = _orders(s, d).select("o_custkey", "o_orderstatus", "o_totalprice")
    dear = pairs.filter(F.col("o_totalprice") > 150000)
    return sets.except_distinct(pairs.drop("o_totalprice"), dear.drop("o_totalprice"))


def _fold_metrics(s, d):
    """Errors of the three predictors per fold of the orders."""
    lines = table(s, d, "lineitem").select(
        hash_bucket(["l_orderkey"], SEED, FOLDS).alias("fold"),
        "l_quantity",
        *[F.expr(formula).cast("double").alias(f"p{p}") for p, formula in PREDICTORS.items()],
    )
    return lines.groupBy("fold").agg(
        *[
            column
            for p in PREDICTORS
            for column in (
                metrics.rmse("l_quantity", f"p{p}").alias(f"rmse_{p}"),
                metrics.mae("l_quantity", f"p{p}").alias(f"mae_{p}"),
            )
        ]
    )


def _rounded(df, columns):
    return df.select(
        *[F.round(c, 6).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def _metric_row_mean(s, d):
    means = _fold_metrics(s, d).select(
        metrics.row_mean([f"rmse_{p}" for p in PREDICTORS]).alias("rmse"),
        metrics.row_mean([f"mae_{p}" for p in PREDICTORS]).alias("mae"),
    )
    summary = metrics.column_summary(means, ["rmse", "mae"])
    return _rounded(summary, summary.columns)


def _metric_summary(s, d):
    summary = metrics.column_summary(table(s, d, "lineitem"), SUMMARISED)
    return _rounded(summary, summary.columns)


def _rmse_mae(s, d):
    lines = table(s, d, "lineitem").select(
        "l_quantity", (F.col("l_extendedprice") / 2000).alias("prediction")
    )
    return lines.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(metrics.rmse("l_quantity", "prediction"), 6).alias("rmse"),
        F.round(metrics.mae("l_quantity", "prediction"), 6).alias("mae"),
    )


def _accuracy(s, d):
    scored = _orders(s, d).select(
        binary_label(F.col("o_orderstatus"), "O").alias("label"),
        F.when(F.col("o_totalprice") > 150000, 1.0).otherwise(0.0).alias("prediction"),
    )
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(metrics.accuracy("label", "prediction"), 6).alias("accuracy"),
    )


def _auc(s, d):
    """How well the length of a document tells its quality label."""
    scored = (
        table(s, d, "labels")
        .join(table(s, d, "documents").select("doc_id", "n_chars"), "doc_id")
        .select(
            F.col("quality").cast("double").alias("label"),
            F.col("n_chars").cast("double").alias("score"),
        )
    )
    return _rounded(metrics.area_by_group(scored, [], "label", "score"), ["auc"])


def _auc_by_group(s, d):
    """The same for every language and source of documents, and for both labels."""
    documents = table(s, d, "documents").select("doc_id", "n_chars", "lang", "source")
    judged = [F.struct(F.lit(c).alias("judged"), F.col(c).alias("label")) for c in ("quality", "toxic")]
    scored = (
        table(s, d, "labels")
        .join(documents, "doc_id")
        .select("lang", "source", "n_chars", F.inline(F.array(*judged)))
    )
    found = metrics.area_by_group(scored, ["judged", "lang", "source"], "label", "n_chars")
    return _rounded(found, ["auc"])


def _event_models(s, d):
    return table(s, d, "events").select(F.col("event_type").alias("model")).distinct()


def _settings(s, d):
    subjects = _orders(s, d).select(F.col("o_orderpriority").alias("subject")).distinct()
    return experiments.every_setting(
        subjects,
        {
            "regparam": [float(v) for v in tabular.REG_PARAMS],
            "elasticnetparam": [float(v) for v in tabular.ELASTIC_NET_PARAMS],
        },
    )


def _upsert(s, d):
    return sets.latest_per_key(
        table(s, d, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["value"]
    )


def _update(s, d):
    """A log of initial values for every (user, event type), updated from dear events."""
    events = table(s, d, "events")
    log = (
        events.select("user_id", "event_type")
        .distinct()
        .select("*", F.lit(experiments.INITIAL_RUNTIME).alias("value"))
    )
    dear = events.filter(F.col("value") >= 100)
    return sets.update_log(log, dear, ["user_id", "event_type"], ["ts", "event_id"], ["value"])


def _results_log(s, d):
    """Fold errors logged by two runs, the first of them retried, compacted to a row per fold.

    The first attempt of the first run fails with wrong values of half of the folds; its
    second attempt, written twice, is right but for the even folds, which a later run corrects.
    """
    errors = _rounded(_fold_metrics(s, d), METRIC_COLUMNS)
    path = shared_path(s, "results-log")
    even = F.col("fold") % 2 == 0
    wrong = [F.lit(-1.0).alias(c) for c in METRIC_COLUMNS]
    broken = [F.when(even, -1.0).otherwise(F.col(c)).alias(c) for c in METRIC_COLUMNS]
    sinks.log_run(errors.filter(even).select("fold", *wrong, F.lit(1).alias("at")), path, "first")
    for _ in range(2):
        sinks.log_run(errors.select("fold", *broken, F.lit(2).alias("at")), path, "first", 1)
    sinks.log_run(errors.filter(even).withColumn("at", F.lit(3)), path, "second")
    kept = sinks.compact_runs(s, path, shared_path(s, "results"), ["fold"], ["at"])
    return kept.select("fold", "run", F.col("attempt").cast("int").alias("attempt"), *METRIC_COLUMNS)


QUERIES = {
    "flags_encode": _encoded,
    "label_binary": _labelled_orders,
    "label_balance": lambda s, d: count_rows(_labelled_orders(s, d), ["label"], "n_rows"),
    "label_remap": lambda s, d: classify.typed_vectors(
        standins.bit_vectors(s, d).select("vec_id", "lbl"), "lbl"
    ),
    "bulk_cast": lambda s, d: (
        lambda rows: rows.select(*strings_to_double(rows))
    )(standins.bit_vectors(s, d)),
    "assemble_features": _feature_cells,
    "ratings_typed": lambda s, d: recommend.typed_ratings(_raw_ratings(s, d)),
    "sample_hash": lambda s, d: sampling.sample_rows(
        _orders(s, d), ["o_orderkey"], SAMPLE, SEED
    ).select("o_orderkey", "o_totalprice"),
    "sample_stratified": lambda s, d: sampling.sample_strata(
        _orders(s, d), "o_orderstatus", ["o_orderkey"], STRATA, SEED
    ).select("o_orderkey", "o_orderstatus"),
    "split_train_test": lambda s, d: sampling.split_strata(
        _orders(s, d).select("o_orderkey", "o_orderstatus"),
        "o_orderstatus", ["o_orderkey"], STRATA, SEED,
    ),
    "kfold_assign": lambda s, d: sampling.assign_folds(
        _orders(s, d).select("o_orderkey"), ["o_orderkey"], FOLDS, SEED
    ),
    "except_distinct": _except,
    "union_by_name": _customer_and_supplier,
    "metric_summary": _metric_summary,
    "metric_row_mean": _metric_row_mean,
    "metric_table": lambda s, d: _rounded(
        metrics.with_summary_rows(_fold_metrics(s, d), "fold", METRIC_COLUMNS), METRIC_COLUMNS
    ),
    "eval_rmse_mae": _rmse_mae,
    "eval_accuracy": _accuracy,
    "eval_auc": _auc,
    "eval_auc_by_group": _auc_by_group,
    "experiment_grid": lambda s, d: experiments.experiment_grid(_event_models(s, d)),
    "param_grid": _settings,
    "results_upsert": _upsert,
    "results_update": _update,
    "results_log": _results_log,
}


def bucket_sql(key: str, buckets: int, seed: int = SEED) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT % {buckets})"


def share_sql(key: str, fraction: str | float, seed: int = SEED) -> str:
    """Whether a key lies in a fraction, by the first 60 bits of its hash."""
    place = f"('0x' || substr(md5('{seed}:' || {key}), 1, {FRACTION_BITS // 4}))::BIGINT"
    return f"({place} < floor({fraction}::DOUBLE * {2**FRACTION_BITS}::DOUBLE)::BIGINT)"


_BITS = ", ".join(
    f"CASE WHEN embedding[{i + 1}] > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {name}"
    for i, name in enumerate(standins.BIT_COLUMNS)
)

ENCOUNTERS_SQL = """
encounters AS (
  SELECT o_orderkey AS encounter_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS priority,
         CASE WHEN max(l_returnflag) = 'N' THEN 0 ELSE 1 END AS returned,
         CASE WHEN min(l_linestatus) = 'O' THEN 0 ELSE 1 END AS linestatus,
         CASE WHEN min(l_discount) > 0.02 THEN 1 ELSE 0 END AS discounted,
         CASE WHEN contains(o_orderstatus, 'O') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label,
         count(*) AS stay
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY o_orderkey, o_orderpriority, o_orderstatus)"""

RATINGS_SQL = """
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         sum(l_quantity) / count(*) / 10 AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

_STRATUM_SQL = "CASE o_orderstatus " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in STRATA.items()
) + " ELSE 0 END"
_CHOSEN_SQL = share_sql("o_orderkey", f"({_STRATUM_SQL})")

_FOLD_METRICS_SQL = f"""
fold_metrics AS (
  SELECT {bucket_sql('l_orderkey', FOLDS)} AS fold,
  {", ".join(
      f"sqrt(avg(({f} - l_quantity) * ({f} - l_quantity))) AS rmse_{p}, "
      f"avg(abs({f} - l_quantity)) AS mae_{p}" for p, f in PREDICTORS.items())}
  FROM lineitem GROUP BY 1)"""


def _each(form: str, columns=METRIC_COLUMNS) -> str:
    return ", ".join(form.format(c=c) for c in columns)


_EVENT_KEYS = "user_id, event_type"
_NEWEST = "row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC)"

ORACLES = {
    "flags_encode": f"WITH {ENCOUNTERS_SQL} SELECT * FROM encounters",
    "label_binary": """SELECT o_orderkey, o_orderstatus,
        CASE WHEN contains(o_orderstatus, 'O') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label
        FROM orders""",
    "label_balance": """SELECT
        CASE WHEN contains(o_orderstatus, 'O') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label,
        count(*) AS n_rows FROM orders GROUP BY 1""",
    "label_remap": """SELECT vec_id,
        CASE WHEN label % 2 = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS labels
        FROM embeddings""",
    "bulk_cast": f"""SELECT vec_id, {_BITS},
        CASE WHEN label % 2 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS lbl
        FROM embeddings""",
    "assemble_features": """SELECT vec_id,
        CASE WHEN label % 2 = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS labels,
        CAST(i AS INTEGER) AS pos,
        CASE WHEN embedding[i + 1] > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
        FROM embeddings, range(64) AS positions(i)""",
    "ratings_typed": f"WITH {RATINGS_SQL} SELECT user_id, item_id, rating FROM ratings",
    "sample_hash": f"""SELECT o_orderkey, o_totalprice FROM orders
        WHERE {share_sql('o_orderkey', SAMPLE)}""",
    "sample_stratified": f"SELECT o_orderkey, o_orderstatus FROM orders WHERE {_CHOSEN_SQL}",
    "split_train_test": f"""SELECT o_orderkey, o_orderstatus,
        CASE WHEN {_CHOSEN_SQL} THEN 'train' ELSE 'test' END AS split FROM orders""",
    "kfold_assign": f"""SELECT o_orderkey,
        CAST({bucket_sql('o_orderkey', FOLDS)} AS INTEGER) AS fold FROM orders""",
    "except_distinct": """SELECT o_custkey, o_orderstatus FROM orders EXCEPT
        SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 150000""",
    "union_by_name": """
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
        FROM customer UNION ALL
        SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
    "metric_summary": "SELECT "
    + _each("round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std", SUMMARISED)
    + " FROM lineitem",
    "metric_row_mean": f"""WITH {_FOLD_METRICS_SQL},
        means AS (SELECT (rmse_1 + rmse_2 + rmse_3) / 3 AS rmse,
                         (mae_1 + mae_2 + mae_3) / 3 AS mae FROM fold_metrics)
        SELECT round(avg(rmse), 6) AS rmse_mean, round(stddev_samp(rmse), 6) AS rmse_std,
               round(avg(mae), 6) AS mae_mean, round(stddev_samp(mae), 6) AS mae_std
        FROM means""",
    "metric_table": f"""WITH {_FOLD_METRICS_SQL}
        SELECT CAST(fold AS VARCHAR) AS fold, {_each("round({c}, 6) AS {c}")} FROM fold_metrics
        UNION ALL SELECT 'mean', {_each("round(avg({c}), 6)")} FROM fold_metrics
        UNION ALL SELECT 'std', {_each("round(stddev_samp({c}), 6)")} FROM fold_metrics""",
    "eval_rmse_mae": """SELECT count(*) AS n_rows,
        round(sqrt(avg((l_extendedprice / 2000 - l_quantity)
                     * (l_extendedprice / 2000 - l_quantity))), 6) AS rmse,
        round(avg(abs(l_extendedprice / 2000 - l_quantity)), 6) AS mae FROM lineitem""",
    "eval_accuracy": """SELECT count(*) AS n_rows,
        round(avg(CASE WHEN contains(o_orderstatus, 'O') = (o_totalprice <= 150000)
                  THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM orders""",
    "eval_auc": """WITH scored AS (
          SELECT quality, n_chars FROM labels JOIN documents USING (doc_id)),
        levels AS (SELECT n_chars, count(*) FILTER (WHERE quality = 1) AS pos,
                          count(*) FILTER (WHERE quality = 0) AS neg
                   FROM scored GROUP BY n_chars),
        summed AS (SELECT *, sum(neg) OVER (ORDER BY n_chars) - neg AS below FROM levels)
        SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
               round(sum(pos * (below + neg / 2.0)) / CAST(sum(pos) * sum(neg) AS DOUBLE), 6)
                 AS auc
        FROM summed""",
    "eval_auc_by_group": """WITH scored AS (
          SELECT lang, source, n_chars, unnest(['quality', 'toxic']) AS judged,
                 unnest([quality, toxic]) AS label
          FROM labels JOIN documents USING (doc_id)),
        ranked AS (
          SELECT *, rank() OVER (PARTITION BY judged, lang, source ORDER BY n_chars)
                 + (count(*) OVER (PARTITION BY judged, lang, source, n_chars) - 1) / 2.0 AS place
          FROM scored),
        sums AS (
          SELECT judged, lang, source, count(*) FILTER (WHERE label = 1) AS n_pos,
                 count(*) FILTER (WHERE label <> 1) AS n_neg,
                 sum(place) FILTER (WHERE label = 1) AS places
          FROM ranked GROUP BY judged, lang, source)
        SELECT judged, lang, source, n_pos, n_neg,
               CASE WHEN n_pos > 0 AND n_neg > 0 THEN
                 round((places - n_pos * (n_pos + 1) / 2.0)::DOUBLE / (n_pos * n_neg), 6) END AS auc
        FROM sums""",
    "experiment_grid": f"""SELECT DISTINCT event_type AS model, datasize,
        {experiments.INITIAL_RUNTIME}::DOUBLE AS runtime, 0.0::DOUBLE AS accuracy,
        0.0::DOUBLE AS auc
        FROM events, unnest({experiments.SIZES}::DOUBLE[]) AS sizes(datasize)""",
    "param_grid": f"""SELECT DISTINCT o_orderpriority AS subject, regparam, elasticnetparam
        FROM orders, unnest({tabular.REG_PARAMS}::DOUBLE[]) AS r(regparam),
             unnest({tabular.ELASTIC_NET_PARAMS}::DOUBLE[]) AS e(elasticnetparam)""",
    "results_upsert": f"""SELECT {_EVENT_KEYS}, value FROM (
        SELECT *, {_NEWEST} AS place FROM events) WHERE place = 1""",
    "results_log": f"""WITH {_FOLD_METRICS_SQL}
        SELECT fold, CASE WHEN fold % 2 = 0 THEN 'second' ELSE 'first' END AS run,
               CAST(fold % 2 AS INTEGER) AS attempt, {_each("round({c}, 6) AS {c}")}
        FROM fold_metrics""",
    "results_update": f"""WITH latest AS (
          SELECT {_EVENT_KEYS}, value FROM (
            SELECT *, {_NEWEST} AS place FROM events WHERE value >= 100) WHERE place = 1)
        SELECT k.user_id, k.event_type,
               coalesce(l.value, {experiments.INITIAL_RUNTIME}::DOUBLE) AS value
        FROM (SELECT DISTINCT {_EVENT_KEYS} FROM events) k
        LEFT JOIN latest l ON k.user_id = l.user_id AND k.event_type = l.event_type""",
}
