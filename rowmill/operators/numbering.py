"""Row numbers over a whole table (WIN7, WIN8) and repeatable sampling (SMP1, SMP2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rowmill.functions.numbers import hash_share
from rowmill.session import settle

_ROW_BITS = 33  # fixed value: monotonically_increasing_id keeps the row's place in its low 33 bits


def unique_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """WIN8: unique, not consecutive, and no shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def global_row_numbers(df: DataFrame, order: list[Column], name: str = "row_number") -> DataFrame:
    """WIN7: consecutive numbers in a total order, without a one-task window.

    Rows are range-partitioned and sorted, each learns its place in its partition, and a running
    sum over one count per partition turns places into numbers.  The order must be unique per row
    (add tie-breaking columns): then equal keys also spread over partitions.  Range boundaries
    come from a sample, so the sorted rows are stored once before they are counted.  The offsets,
    one row per partition, are broadcast: the table is shuffled for the sort only.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ranged.withColumn("__id", F.monotonically_increasing_id()), "sorted").withColumns({
        "__part": F.shiftright("__id", _ROW_BITS),
        "__place": F.col("__id").bitwiseAND((1 << _ROW_BITS) - 1),
    })
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__place") + 1)
        .select(*df.columns, name)
    )


def bernoulli(df: DataFrame, fraction: float, keys: list[str], seed: int = 0) -> DataFrame:
    """SMP1: keep each row with the given probability, decided by its keys alone.

    Unlike ``DataFrame.sample`` the choice survives re-partitioning and retried tasks.
    """
    return df.where(hash_share(*[F.col(k) for k in keys], seed=seed) < fraction)


def split(df: DataFrame, weights: dict[str, float], keys: list[str], seed: int = 0) -> DataFrame:
    """SMP2: label every row with one of the weighted splits; a key always gets the same one."""
    total = sum(weights.values())
    share = hash_share(*[F.col(k) for k in keys], seed=seed)
    label, upto = None, 0.0
    for name, weight in weights.items():
        upto += weight / total
        label = F.when(share < upto, name) if label is None else label.when(share < upto, name)
    return df.withColumn("split", label.otherwise(list(weights)[-1]))
