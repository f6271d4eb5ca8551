"""Reproducible row buckets and shares.

Both depend on the row's key and a seed only, so a row keeps its place whatever the
file layout, the number of partitions or a retried task, and the same number can be
worked out by any engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of the hash that a fraction is compared with: shares down to 1e-18 are told apart.
FRACTION_BITS = 60


def _leading(keys: list[str], seed: int, digits: int) -> Column:
    """The first hexadecimal digits of md5(seed:key[:key...]) as a number."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def hash_bucket(keys: list[str], seed: int, buckets: int) -> Column:
    """Bucket in ``[0, buckets)`` from the first 32 bits of the key's hash."""
    return F.pmod(_leading(keys, seed, 8), F.lit(buckets))


def hash_share(keys: list[str], seed: int) -> Column:
    """A row's place in ``[0, 2^60)``: the first 60 bits of the key's hash."""
    return _leading(keys, seed, FRACTION_BITS // 4)


def threshold(fraction: float | Column) -> Column:
    """The place below which a ``fraction`` of all keys lies."""
    if isinstance(fraction, (int, float)):
        return F.lit(int(fraction * 2**FRACTION_BITS)).cast("long")
    return F.floor(fraction * F.lit(float(2**FRACTION_BITS))).cast("long")


def in_fraction(keys: list[str], seed: int, fraction: float | Column) -> Column:
    """True for a ``fraction`` of the keys; a larger fraction keeps all of a smaller one."""
    return hash_share(keys, seed) < threshold(fraction)
