"""Number columns (MTH1-MTH3, NUL5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """MTH1: quotient, NULL where the divisor is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percentage(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def clamp_upper(value: Column, bound: float = 1.0) -> Column:
    """NUL5: no more than ``bound``; NULL stays NULL (``least`` would skip it)."""
    return F.when(value > bound, F.lit(bound)).otherwise(value)


def exact(value: Column, scale: int = 2) -> Column:
    """Decimal form of a double, so that a distributed sum does not depend on the row order."""
    return value.cast(f"decimal(18,{scale})")


def exact_sum(value: Column, scale: int = 2) -> Column:
    return F.sum(exact(value, scale)).cast("double")


def exact_mean(value: Column, scale: int = 2) -> Column:
    """Mean of the non-NULL values from an exact sum; NULL for none."""
    return F.try_divide(exact_sum(value, scale), F.count(value).cast("double"))


def hash_share(*keys: Column, seed: int = 0) -> Column:
    """A repeatable pseudo-random share in [0, 1) of the keys: 32 bits of an MD5 digest."""
    text = F.concat_ws("|", F.lit(str(seed)), *[key.cast("string") for key in keys])
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return head / F.lit(float(2**32))
