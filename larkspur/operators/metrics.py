"""Model metrics as plain aggregates, and tables of metrics."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges of scores that the distinct scores of a group are dealt into.
SCORE_RANGES = 64


def _weighted_mean(value: Column, weight: str | None) -> Column:
    if weight is None:
        return F.avg(value)
    return F.sum(value * F.col(weight)) / F.sum(weight)


def rmse(label: str, prediction: str, weight: str | None = None) -> Column:
    error = F.col(prediction) - F.col(label)
    return F.sqrt(_weighted_mean(error * error, weight))


def mae(label: str, prediction: str, weight: str | None = None) -> Column:
    return _weighted_mean(F.abs(F.col(prediction) - F.col(label)), weight)


def accuracy(label: str, prediction: str, weight: str | None = None) -> Column:
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return _weighted_mean(hit, weight)


def collapsed(rows: DataFrame, names: Sequence[str], count: str = "n") -> DataFrame:
    """Counts of equal rows, collapsed batch by batch where the rows are: nothing moves.

    A row may come once per batch, so whoever adds up the counts meets few copies of a hot one.
    """
    own = list(names)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = pa.Table.from_batches([batch]).group_by(own, use_threads=False).aggregate([([], "count_all")])
                yield from found.select([*own, "count_all"]).rename_columns([*own, count]).to_batches()

    kept = rows.select(*own)
    return kept.mapInArrow(work, T.StructType([*kept.schema.fields, T.StructField(count, T.LongType())]))


def area_under_roc(
    scored: DataFrame,
    label: str,
    score: str = "rawPrediction",
    weight: str | None = None,
    ranges: int = SCORE_RANGES,
) -> float:
    """Exact area under the ROC curve, ties counted half.

    The built-in evaluator keeps every distinct score as well if told so (``numBins=0``), but sorts them in
    several passes of many small tasks.  Here scores are dealt into ranges once, each range gives its sums,
    and the driver adds up these few rows.  Rows without a weight are ``collapsed`` before; rows with one
    should be.  As with the evaluator, the area is 0 without positives and 1 without negatives.
    """
    is_vector = not isinstance(scored.schema[score].dataType, T.NumericType)
    value = vector_to_array(score)[1] if is_vector else F.col(score).cast("double")
    rows = scored.select(
        value.alias("score"), (F.col(label) > 0.5).alias("positive"), *([] if weight is None else [weight])
    )
    rows = collapsed(rows, ["score", "positive"]) if weight is None else rows

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if found := [b for b in batches if b.num_rows]:
            values, positive, amounts = (
                np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in found]) for i in range(3)
            )
            levels, at = np.unique(values, return_inverse=True)
            pos = np.bincount(at, np.where(positive, amounts, 0.0), len(levels))
            neg = np.bincount(at, np.where(positive, 0.0, amounts), len(levels))
            won = (neg * (pos.sum() - pos.cumsum() + pos / 2)).sum()
            cells = {"score": levels[0], "pos": pos.sum(), "neg": neg.sum(), "won": won}
            yield pa.RecordBatch.from_pydict({name: [cell] for name, cell in cells.items()})

    dealt = rows.repartitionByRange(ranges, "score")
    parts = dealt.mapInArrow(summed, "score double, pos double, neg double, won double").collect()
    above, below, won = 0.0, 0.0, 0.0
    for part in sorted(parts, key=lambda p: -p.score):
        won += part.won + part.neg * above
        above, below = above + part.pos, below + part.neg
    if above and below:
        return won / (above * below)
    return 0.5 if not above and not below else float(above > 0)


def area_by_group(
    scored: DataFrame,
    groups: Sequence[str],
    label: str,
    score: str,
    weight: str | None = None,
    ranges: int = SCORE_RANGES,
) -> DataFrame:
    """Exact area under the ROC curve of every group, as a plan: groups, n_pos, n_neg, auc.

    Rows collapse to one per distinct score before anything else.  A group's distinct
    scores are dealt into ranges at their quantiles; running sums are taken inside a
    range and then over the few ranges, so no task meets all scores of a group.  Where
    the range borders lie changes nothing in the result.  Ties count half; a null score
    takes no part; a group with one class only has a null area.  With no ``groups`` the
    result is one row.
    """
    amount = F.lit(1).cast("long") if weight is None else F.col(weight)
    positive = F.col(label) == 1
    levels = (
        scored.where(F.col(score).isNotNull())
        .groupBy(*groups, F.col(score).alias("_score"))
        .agg(
            F.sum(F.when(positive, amount).otherwise(0)).alias("_pos"),
            F.sum(F.when(positive, 0).otherwise(amount)).alias("_neg"),
        )
    )
    shares = [k / ranges for k in range(1, ranges)]
    borders = F.percentile_approx("_score", shares, 10 * ranges)
    if groups:
        limits = levels.groupBy(*groups).agg(borders.alias("_borders"))
        limits = limits.toDF(*[f"_{c}" for c in groups], "_borders")
        met = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in groups]
        ranged = levels.join(limits, reduce(Column.__and__, met))
    else:
        ranged = levels.withColumn("_borders", levels.agg(borders).scalar())
    below = F.size(F.filter("_borders", lambda b: b < F.col("_score")))
    ranged = ranged.select(*groups, "_score", "_pos", "_neg", below.alias("_range"))
    higher = Window.partitionBy(*groups, "_range").orderBy(F.desc("_score"))
    above = F.sum("_pos").over(higher.rowsBetween(Window.unboundedPreceding, -1))
    inside = (
        ranged.withColumn("_won", F.col("_neg") * (F.coalesce(above, F.lit(0)) + F.col("_pos") / 2))
        .groupBy(*groups, "_range")
        .agg(*[F.sum(c).alias(c) for c in ("_pos", "_neg", "_won")])
    )
    later = Window.partitionBy(*groups).orderBy(F.desc("_range"))
    above = F.sum("_pos").over(later.rowsBetween(Window.unboundedPreceding, -1))
    won = inside.withColumn("_won", F.col("_won") + F.col("_neg") * F.coalesce(above, F.lit(0)))
    product = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return won.groupBy(*groups).agg(
        F.sum("_pos").alias("n_pos"),
        F.sum("_neg").alias("n_neg"),
        F.when(product > 0, F.sum("_won") / product).alias("auc"),
    )


def row_mean(columns: list[str]) -> Column:
    """Mean over several columns of the same row."""
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return total / len(columns)


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and sample standard deviation of every column, in one pass."""
    means = [F.avg(c).alias(f"{c}_mean") for c in columns]
    spreads = [F.stddev_samp(c).alias(f"{c}_std") for c in columns]
    return df.agg(*means, *spreads)


def with_summary_rows(metrics: DataFrame, row: str, columns: list[str]) -> DataFrame:
    """Metric rows followed by a ``mean`` and a ``std`` row over them.

    ``row`` names the text column that labels rows.  Both summaries are taken
    over the metric rows only.
    """
    detail = metrics.select(F.col(row).cast("string").alias(row), *columns)
    mean = metrics.agg(*[F.avg(c).alias(c) for c in columns])
    std = metrics.agg(*[F.stddev_samp(c).alias(c) for c in columns])
    return detail.union(mean.select(F.lit("mean").alias(row), *columns)).union(
        std.select(F.lit("std").alias(row), *columns)
    )
