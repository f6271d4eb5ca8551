"""Set operations and keyed updates, each as one pre-aggregated shuffle."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SHORT = (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType, T.DateType, T.TimestampType)
_WHOLE = (*_SHORT, T.LongType)
#: Types a hash aggregate can keep in place.
_FIXED = (*_WHOLE, T.FloatType, T.DoubleType, T.TimestampNTZType, T.DecimalType)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that do not occur in ``right``; nulls are equal.

    Rows of both sides are tagged and grouped together: copies collapse before
    the shuffle, so a row that fills a third of a table costs one row per task,
    and there is no join.  Columns are taken by position.
    """
    names = left.columns
    tagged = left.select("*", F.lit(0).alias("_right")).union(
        right.toDF(*names).select("*", F.lit(1).alias("_right"))
    )
    return (
        tagged.groupBy(*names)
        .agg(F.max("_right").alias("_right"))
        .filter(F.col("_right") == 0)
        .select(*names)
    )


def union_by_name(upper: DataFrame, lower: DataFrame) -> DataFrame:
    """All rows of both; a column one side lacks is null there."""
    return upper.unionByName(lower, allowMissingColumns=True)


def latest_per_key(
    rows: DataFrame, keys: list[str], order: list[str], values: list[str]
) -> DataFrame:
    """The values of the last row per key; nulls in ``order`` come first.

    ``order`` must be unique per key.  A whole number or time, or two of them of which the
    first is not a long, are written as one number.  If the values are of fixed width too, each task
    keeps the greatest number and its values per key in a hash map: nothing is sorted, and
    one row per key and task travels.  Other values are fetched in a second step, from the
    row of the key that holds the greatest number.  Any other order is narrowed column by
    column: the greatest value per key, then the rows that tie on it.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    if len(order) <= 2 and all(isinstance(kinds[c], _SHORT) for c in order[:-1]) and isinstance(kinds[order[-1]], _WHOLE):
        place = reduce(
            lambda high, low: high * F.lit(Decimal(2**64)) + low,
            [*(_whole(c, kinds[c], -(10**18)) for c in order[:-1]), _whole(order[-1], kinds[order[-1]], -(2**63) - 1)],
        )
        placed = rows.select(*keys, *values, place.cast("decimal(38,0)").alias("_place"))
        if all(isinstance(kinds[v], _FIXED) for v in values):
            return placed.groupBy(*keys).agg(*[F.max_by(v, "_place").alias(v) for v in values])
        return _narrowed(placed, keys, "_place").select(*keys, *values)
    left = rows.select(*dict.fromkeys([*keys, *order, *values]))
    for column in order:
        left = _narrowed(left, keys, column)
    return left.select(*keys, *values)


def _whole(name: str, kind: T.DataType, lowest: int) -> Column:
    """A column as a number in its own order; a null is ``lowest``, below everything else."""
    value = F.col(name)
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, T.DateType):
        value = F.unix_date(value)
    return F.coalesce(value.cast("decimal(20,0)"), F.lit(Decimal(lowest)))


def _narrowed(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The rows that hold the greatest value of a column for their key; keys may be null."""
    tops = rows.groupBy(*keys).agg(F.max(column)).toDF(*[f"_key_{k}" for k in keys], "_top")
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    met = reduce(Column.__and__, [*same, F.col(column).eqNullSafe(F.col("_top"))])
    return rows.join(tops, met).select(*rows.columns)


def update_log(
    log: DataFrame, results: DataFrame, keys: list[str], order: list[str], values: list[str]
) -> DataFrame:
    """``log`` with the latest result of each key written over its values.

    Keys without a result keep what the log holds; results without a log row
    are left out.  Results are appended by many jobs and never rewritten, so
    concurrent jobs cannot undo each other.
    """
    latest = latest_per_key(results, keys, order, values)
    fresh = latest.select(*keys, *[F.col(v).alias(f"_new_{v}") for v in values])
    updated = [F.coalesce(F.col(f"_new_{v}"), F.col(v)).alias(v) for v in values]
    kept = [c for c in log.columns if c not in values]
    return log.join(fresh, keys, "left").select(*kept, *updated)
