"""Samples, splits and folds by row key.

Nothing here shuffles or joins: a row's side follows from its key alone, so the
complement of a sample is a filter and not a difference of two tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.hashing import hash_bucket, in_fraction


def sample_rows(df: DataFrame, keys: list[str], fraction: float, seed: int) -> DataFrame:
    """A ``fraction`` of the rows; samples of one seed are nested."""
    return df.filter(in_fraction(keys, seed, fraction))


def _stratum_fraction(stratum: str, fractions: Mapping[object, float]) -> Column:
    share = F.lit(0.0)
    for value, fraction in fractions.items():
        share = F.when(F.col(stratum) == value, fraction).otherwise(share)
    return share


def split_strata(
    df: DataFrame, stratum: str, keys: list[str], fractions: Mapping[object, float], seed: int
) -> DataFrame:
    """Adds ``split``: ``train`` for the given fraction of each stratum, else ``test``.

    A stratum without a fraction is all test.
    """
    chosen = in_fraction(keys, seed, _stratum_fraction(stratum, fractions))
    return df.select("*", F.when(chosen, "train").otherwise("test").alias("split"))


def sample_strata(
    df: DataFrame, stratum: str, keys: list[str], fractions: Mapping[object, float], seed: int
) -> DataFrame:
    """Per-stratum sample: the train side of ``split_strata``."""
    return df.filter(in_fraction(keys, seed, _stratum_fraction(stratum, fractions)))


def assign_folds(df: DataFrame, keys: list[str], folds: int, seed: int) -> DataFrame:
    """Adds ``fold`` in ``[0, folds)``, about equal in size."""
    return df.select("*", hash_bucket(keys, seed, folds).cast("int").alias("fold"))


def fold_pair(folded: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Train and test side for one fold."""
    return folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
