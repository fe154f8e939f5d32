"""Bus trips: cleansed table, two-way lines, daily ratios (PIP1-PIP3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.dates import date_from_parts
from rowmill.functions.numbers import percentage, ratio
from rowmill.functions.text import pair_key
from rowmill.operators.groups import running_ratios, with_group_values
from rowmill.session import settle
from rowmill.sinks.files import write_partitioned, write_table

MEASURES = ["trip_duration_hours", "delay_start_minutes", "delay_end_minutes", "travelled_distance_km"]


def regular(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("trip_type") == "regular")


def clean_trips(raw: DataFrame, distance_fill: str = "travelled_distance_km") -> DataFrame:
    """PIP1: typed, imputed and derived columns of the regular trips.

    A missing duration or distance takes its line's mean; both means come from one aggregate.
    ``distance_fill="trip_duration_hours"`` fills distances from the mean duration instead.
    """
    # Text is parsed once: the means and the rows that they fill are read from typed columns.
    typed = settle(regular(raw).withColumns({c: F.col(c).try_cast("double") for c in MEASURES}), "typed-trips")
    filled = with_group_values(
        typed, ["line_number"],
        __duration=F.avg("trip_duration_hours"), __distance=F.avg(distance_fill),
    ).withColumns({
        "trip_duration_hours": F.coalesce("trip_duration_hours", "__duration"),
        "travelled_distance_km": F.coalesce("travelled_distance_km", "__distance"),
        "delay_start_minutes": F.coalesce("delay_start_minutes", F.lit(0.0)),
        "delay_end_minutes": F.coalesce("delay_end_minutes", F.lit(0.0)),
    })
    total = F.col("delay_start_minutes") + F.col("delay_end_minutes")
    month = F.when(F.col("year").try_cast("int") == 2019, 7).otherwise(8)
    return filled.withColumns({
        "total_delay_minutes": total,
        "delay_percentage": percentage(total, F.col("trip_duration_hours") * 60),
        "speed_kmh": F.round(ratio(F.col("travelled_distance_km"), F.col("trip_duration_hours")), 2),
        "month": month,
        "date": date_from_parts(F.lit(2024), month, F.col("day").try_cast("int")),
    }).drop("trip_type", "year", "day", "__duration", "__distance")


def save_trips(trips: DataFrame, name: str, path: str, buckets: int = 4) -> None:
    write_table(trips, name, path, buckets, ["line_number"], ["date"])


def two_way_lines(raw: DataFrame, regular_only: bool = True) -> DataFrame:
    """PIP2: one row per company, line and unordered pair of ends."""
    trips = regular(raw) if regular_only else raw
    key = pair_key(F.col("origin"), F.col("destination")).alias("line_key")
    return trips.select("company", "line_number", key).distinct()


def daily_ratios(trips: DataFrame) -> DataFrame:
    """PIP3: each day's mean delay and duration per line against the line's days so far."""
    daily = trips.groupBy("date", "line_number").agg(
        F.avg("delay_percentage").alias("delay_percentage"),
        F.avg("trip_duration_hours").alias("trip_duration_hours"),
    )
    return ratios_of_days(daily)


def ratios_of_days(daily: DataFrame) -> DataFrame:
    delays = running_ratios(daily, ["line_number"], ["date"], "delay_percentage")
    both = running_ratios(delays, ["line_number"], ["date"], "trip_duration_hours")
    return both.select(
        "date", "line_number",
        F.col("delay_percentage_to_mean").alias("avg_delay_ratio"),
        F.col("delay_percentage_to_max").alias("max_delay_ratio"),
        F.col("trip_duration_hours_to_mean").alias("avg_trip_duration_hours"),
        F.col("trip_duration_hours_to_max").alias("max_trip_duration_hours"),
    )


def save_ratios(ratios: DataFrame, path: str) -> None:
    write_partitioned(ratios, path, ["date"])
