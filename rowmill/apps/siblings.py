"""Likely siblings by title pair (PIP8), without joining the table to itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.operators.pairs import banded_label_pair_counts, years_position


def sibling_title_pairs(
    people: DataFrame,
    family: str = "last_name",
    person: str = "email",
    title: str = "job_title",
    born: str = "dob",
    years: int = 10,
    mirrored: bool = True,
) -> DataFrame:
    """Ordered pairs of different people of one family born under ``years`` years apart.

    Without ``mirrored`` each pair of people counts once, which is half, as (a, b) comes with (b, a).
    """
    position, width = years_position(F.to_date(born), years)
    pairs = banded_label_pair_counts(people, [family], title, position, width, apart=person)
    return (
        pairs.withColumnRenamed("pairs", "count")
        .withColumn("count", F.col("count") if mirrored else F.expr("count div 2"))
        .where(F.col("count") > 0)
        .withColumnsRenamed({"label_1": "pair_title_1", "label_2": "pair_title_2"})
    )


def title_summaries(pairs: DataFrame, titles: list[str], initial: str) -> DataFrame:
    """AGG12: the four totals of the analysis in one pass over the title pairs."""
    first, second, count = F.col("pair_title_1"), F.col("pair_title_2"), F.col("count")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, count)), F.lit(0))

    return pairs.agg(
        F.count(F.lit(1)).alias("title_pairs"),
        total(first.isin(titles) & second.isin(titles)).alias("among_titles"),
        total(first == second).alias("same_title"),
        total(F.substring(first, 1, len(initial)) == initial).alias("with_initial"),
    )
