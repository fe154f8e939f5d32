"""Group values on every row, and latest rows per key, without gathering a group in one task.

A window over ``partitionBy(key)`` sorts all rows of a key in a single task.  Where the value is
an aggregate, these operators aggregate first (partial sums before the shuffle), store the one row
per key, and join it back.  Stored, its size is known: a small one is broadcast and the table is
never shuffled; a large one is a sort-merge join in which AQE splits a hot key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from rowmill.session import settle

# Types that the buffer of a hash aggregate holds.
_FIXED = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)


def _beside(df: DataFrame, per_key: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``df`` joined with one stored row per key, NULL keys matching NULL; the keys come from ``df``."""
    right = per_key.withColumnsRenamed({key: f"__key_{i}" for i, key in enumerate(keys)})
    same = reduce(and_, (df[key].eqNullSafe(right[f"__key_{i}"]) for i, key in enumerate(keys)))
    return df.join(right, same, how).drop(*[f"__key_{i}" for i in range(len(keys))])


def with_group_values(df: DataFrame, keys: list[str], **values: Column) -> DataFrame:
    """WIN1, WIN5: add aggregates of each row's group to the row; NULL keys form a group."""
    per_key = df.groupBy(*keys).agg(*[value.alias(name) for name, value in values.items()])
    return _beside(df, settle(per_key, "group-values"), keys, "left").select(*df.columns, *values.keys())


def fill_with_group_mean(
    df: DataFrame, keys: list[str], column: str, mean: Column | None = None
) -> DataFrame:
    """NUL3: NULL becomes the group's mean of the same column, or of ``mean`` if given."""
    filled = with_group_values(df, keys, __mean=F.avg(column) if mean is None else mean)
    return filled.withColumn(column, F.coalesce(column, "__mean")).drop("__mean")


def latest_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """WIN4, AGG8: the row with the greatest ``order`` per key; NULL is less than any value.

    The greatest value per key is a hash aggregate of narrow rows, merged in each task, and only then the rows
    that have it are fetched: no task sorts whole rows, and no other row is carried through a shuffle where
    the keys are few enough to be broadcast.  Further order columns, and last a hash of the remaining columns
    for rows that tie on all of them, decide among the rows fetched, so the result does not depend on their
    order.  Order columns are numbers, dates or times; for others whole rows are compared.
    """
    if not all(isinstance(df.schema[c].dataType, _FIXED) for c in order):
        return _latest_whole(df, keys, order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    found, tie = df, F.xxhash64(*rest) if rest else F.lit(0)
    for column in [*order, "__tie"]:
        if column == "__tie":
            found = found.withColumn("__tie", tie)
        best = settle(found.groupBy(*keys).agg(F.max(column).alias("__best")), "latest-values")
        chosen = _beside(found, best, keys, "inner").where(F.col(column).eqNullSafe(F.col("__best"))).drop("__best")
        found = settle(chosen, "latest-rows")
        if found.count() == best.count():
            return found.select(*df.columns)
    # Copies of a row are left, and rows whose hashes agree: few, of which the greatest counts.
    one = found.groupBy(*keys, *order).agg(F.array_max(F.collect_set(F.struct(*rest, "__tie"))).alias("__one"))
    return one.select(*keys, *order, "__one.*").select(*df.columns)


def _latest_whole(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """By a maximum of whole rows, for order columns that no hash aggregate can hold."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*").select(*df.columns)


def nth_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """WIN2: the n-th row per key.

    The equality on ``row_number`` lets Spark keep at most ``n`` rows per key in every map task
    before the shuffle (WindowGroupLimit), so a hot key ships ``n`` rows per task, not all.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("row_number", number).where(F.col("row_number") == n)


def running_ratios(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """WIN6: ratio of each value to the running mean and running maximum up to its row.

    Meant for pre-aggregated rows (one per key and day): a key's rows are then as many as the
    calendar has days, whatever the size of the raw table.
    """
    upto = (
        Window.partitionBy(*keys).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumns({
        f"{value}_to_mean": F.try_divide(F.col(value), F.avg(value).over(upto)),
        f"{value}_to_max": F.try_divide(F.col(value), F.max(value).over(upto)),
    })
