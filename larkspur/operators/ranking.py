"""Ranks and top-k of counted items, without a window over the items.

A window partitioned by group would pull every item of a group into one task,
and one group may hold most items.  The values ranked here are row counts, and
counts repeat: a group with N rows behind it has at most sqrt(2 N) different
counts (1 + 2 + 3 + ... <= N).  So the rank is worked out on the *levels*
(group, count, number of items with it), which stay small at any size, and
joined back to the items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def count_rows(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Rows per key; partial counts are taken before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rank_levels(counted: DataFrame, group: str, value: str = "n") -> DataFrame:
    """Rank of every (group, value) level, largest value first.

    Ties share a rank and leave a gap, as with SQL ``rank()``.
    """
    levels = counted.groupBy(group, value).agg(F.count(F.lit(1)).alias("items"))
    above = (
        Window.partitionBy(group)
        .orderBy(F.col(value).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rank = F.lit(1) + F.coalesce(F.sum("items").over(above), F.lit(0))
    return levels.select(group, value, rank.cast("long").alias("rnk"))


def _with_level(
    counted: DataFrame, levels: DataFrame, group: str, value: str, how: str
) -> DataFrame:
    item, level = counted.alias("item"), levels.alias("level")
    same_group = F.col(f"item.{group}").eqNullSafe(F.col(f"level.{group}"))
    same_value = F.col(f"item.{value}") == F.col(f"level.{value}")
    return item.join(level, same_group & same_value, how).select("item.*", "level.rnk")


def rank_in_group(
    counted: DataFrame, group: str, value: str = "n", only: DataFrame | None = None
) -> DataFrame:
    """``counted`` plus ``rnk``, the rank of its value within its group.

    ``only`` limits the rows returned, not the rows ranked against.  The join has no hint on purpose: the adaptive planner broadcasts the levels
    when they measure small and splits a hot level (many items with count 1)
    when they do not.
    """
    items = counted if only is None else only
    return _with_level(items, rank_levels(counted, group, value), group, value, "inner")


def _top_levels(counted: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """Levels ranked up to ``k``: at most ``k`` rows per group, whatever the ties.

    Nothing bounds the number of groups, so the adaptive planner decides on a broadcast.
    """
    return rank_levels(counted, group, value).filter(F.col("rnk") <= k)


def top_k(counted: DataFrame, group: str, k: int, value: str = "n") -> DataFrame:
    """Items ranked up to ``k`` in their group; ties may make it more than ``k``."""
    return _with_level(counted, _top_levels(counted, group, value, k), group, value, "inner")


def top_k_with_rest(
    counted: DataFrame, group: str, item: str, k: int, rest: str, value: str = "n"
) -> DataFrame:
    """Top ``k`` per group plus one row with the sum of all other items, rank 0.

    One pass over the counted items: each either keeps its name or falls into
    the rest, so the totals are conserved.
    """
    ranked = _with_level(counted, _top_levels(counted, group, value, k), group, value, "left")
    name = F.when(F.col("rnk").isNull(), F.lit(rest)).otherwise(F.col(item))
    return (
        ranked.groupBy(
            F.col(group), name.alias(item), F.coalesce(F.col("rnk"), F.lit(0)).alias("rnk")
        )
        .agg(F.sum(value).alias(value))
    )
