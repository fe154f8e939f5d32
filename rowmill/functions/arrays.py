"""Array columns through higher-order functions (ARR1-ARR5); no UDF leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_length(items: Column) -> Column:
    """ARR2: characters over all elements; 0 for an empty array."""
    return F.aggregate(items, F.lit(0), lambda total, item: total + F.length(item))


def upper_all(items: Column) -> Column:
    """ARR3."""
    return F.transform(items, lambda item: F.upper(item))


def containing(items: Column, text: str) -> Column:
    """ARR4: the elements that contain ``text``."""
    return F.filter(items, lambda item: F.instr(item, text) > 0)


def any_longer(items: Column, length: int) -> Column:
    """ARR5: whether an element has more than ``length`` characters."""
    return F.exists(items, lambda item: F.length(item) > length)


def explode_rows(df: DataFrame, array: str, name: str, keep_empty: bool = False) -> DataFrame:
    """ARR1: one row per element; rows without elements survive only with ``keep_empty``."""
    unfold = F.explode_outer if keep_empty else F.explode
    return df.withColumn(name, unfold(array))
