"""Generated select lists: bulk casts, flags and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strings_to_double(df: DataFrame) -> list[Column]:
    """Select list that turns every string column into a double and keeps the rest.

    Text that is no number becomes null instead of ending the job.
    """
    return [
        F.col(f.name).try_cast("double").alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in df.schema.fields
    ]


def flag(name: str, off_value: str) -> Column:
    """0 where the column holds ``off_value``, else 1 (nulls count as set)."""
    return F.when(F.col(name) == off_value, 0).otherwise(1)


def flags(off_values: Mapping[str, str]) -> list[Column]:
    """One 0/1 column per entry, under the original name."""
    return [flag(name, off).alias(name) for name, off in off_values.items()]


def flag_mask(names: Sequence[str]) -> Column:
    """Up to 63 0/1 columns as the bits of one long, the first column lowest."""
    if len(names) > 63:
        raise ValueError("a long holds 63 flags")
    mask = F.lit(0).cast("long")
    for place, name in enumerate(names):
        mask = mask.bitwiseOR(F.shiftleft(F.col(name).cast("long"), place))
    return mask


def unmasked(mask: Column, names: Sequence[str]) -> list[Column]:
    """The 0/1 columns behind ``flag_mask``."""
    return [
        F.shiftright(mask, place).bitwiseAND(F.lit(1).cast("long")).cast("int").alias(name)
        for place, name in enumerate(names)
    ]


def binary_label(text: Column, negative: str) -> Column:
    """0.0 where the text contains ``negative``, else 1.0."""
    return F.when(text.contains(negative), 0.0).otherwise(1.0)


def signed_label(value: Column) -> Column:
    """-1 / 1 (number or text) to 0.0 / 1.0; anything but -1 is positive."""
    return F.when(value.try_cast("int") == -1, 0.0).otherwise(1.0)
