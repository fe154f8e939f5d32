"""City-mobility enrichment and fusion (ST20-ST24); every function takes tables or streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.dates import hours_apart
from rowmill.functions.numbers import clamp_upper, ratio
from rowmill.operators.radius import radius_join

OCCUPANCY = ["id", "occupancy", "longitude", "latitude"]


def bike_occupancy(bikes: DataFrame) -> DataFrame:
    """ST21: active stations; the share of bases without a bike to take."""
    active = bikes.where(F.col("active") == 1)
    share = ratio(F.col("free_bases") + F.col("reservations"), F.col("total_bases"))
    return active.withColumn("occupancy", share)


def parking_occupancy(readings: DataFrame, registry: DataFrame) -> DataFrame:
    """ST22: 1 - free / total; negative where a site reports more free slots than it has."""
    known = readings.where(F.col("free_slots").isNotNull()).withColumn("id", F.col("id").try_cast("int"))
    sites = registry.select("id", "longitude", "latitude", "total_slots")
    return known.join(sites, "id").withColumn(
        "occupancy", 1 - ratio(F.col("free_slots"), F.col("total_slots"))
    )


def hourly_maxima(history: DataFrame) -> DataFrame:
    """Highest intensity per sensor, month and hour of the day.

    At most 288 rows per sensor however long the history: stored once, it spares every batch of a
    stream the history itself.
    """
    return history.groupBy("id", "month", F.hour("datetime").alias("hour")).agg(
        F.max(F.col("intensity").try_cast("double")).alias("intensity_max")
    )


def usual_maximum(hourly: DataFrame, now: Column | None = None, wrap: bool = True) -> DataFrame:
    """Highest intensity per sensor in this month of any year, within an hour of the time of day.

    ``now`` defaults to the current time, which is a constant of each batch: a month directory is
    pruned by it, and a long-running stream moves on with the clock.
    """
    now = F.current_timestamp() if now is None else now
    near = hourly.where(F.col("month") == F.month(now)).where(hours_apart(F.col("hour"), F.hour(now), wrap) <= 1)
    return near.groupBy("id").agg(F.max("intensity_max").alias("intensity_max"))


def traffic_occupancy(readings: DataFrame, locations: DataFrame, maxima: DataFrame) -> DataFrame:
    """ST23: intensity against the usual maximum, at most 1."""
    typed = readings.withColumn("id", F.col("id").try_cast("int")).withColumn(
        "intensity", F.col("intensity").try_cast("double")
    )
    places = locations.select("id", "longitude", "latitude")
    usual = maxima.select(F.col("id").try_cast("int").alias("id"), "intensity_max")
    joined = typed.join(places, "id").join(usual, "id")
    return joined.withColumn("occupancy", clamp_upper(ratio(F.col("intensity"), F.col("intensity_max"))))


def nearby(points: DataFrame, streams: list[DataFrame], carried: list[str] | None = None, salts: int = 1) -> DataFrame:
    """Known readings of all streams beside each point they are near.

    The streams are united before the radius join, so the points are gridded and joined once.
    """
    columns = [*(carried or []), "occupancy", "longitude", "latitude"]
    readings = streams[0].select(*columns)
    for stream in streams[1:]:
        readings = readings.unionByName(stream.select(*columns))
    return radius_join(points, readings.where(F.col("occupancy").isNotNull()), salts=salts)


_POINT = ["point_id", "point_name", "point_longitude", "point_latitude"]


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: c.removeprefix("point_") for c in df.columns})


def fuse(points: DataFrame, streams: list[DataFrame], salts: int = 1) -> DataFrame:
    """ST20, ST24: mean occupancy near each point over all readings since the start.

    On a stream the state is one row per point and never expires.
    """
    mean = nearby(points, streams, salts=salts).groupBy(*_POINT).agg(F.avg("occupancy").alias("occupancy"))
    return _plain(mean)


def fuse_windowed(
    points: DataFrame, streams: list[DataFrame], event_time: str, window: str, lateness: str, salts: int = 1
) -> DataFrame:
    """ST24 over event-time windows: recent means, and state that expires."""
    timed = [s.withWatermark(event_time, lateness) for s in streams]
    near = nearby(points, timed, [event_time], salts=salts)
    mean = near.groupBy(F.window(event_time, window), *_POINT).agg(F.avg("occupancy").alias("occupancy"))
    ends = mean.select(F.col("window.start").alias("start_time"), F.col("window.end").alias("end_time"), *_POINT, "occupancy")
    return _plain(ends)


def fuse_table(points: DataFrame, readings: DataFrame) -> DataFrame:
    """The fusion of a finished table: readings are summed per place before they meet the points.

    A place that reports a third of all readings then joins as one row.
    """
    known = readings.where(F.col("occupancy").isNotNull())
    places = known.groupBy("longitude", "latitude").agg(
        F.sum("occupancy").alias("total"), F.count(F.lit(1)).alias("n")
    )
    mean = radius_join(points, places).groupBy(*_POINT).agg(
        (F.sum("total") / F.sum("n")).alias("occupancy")
    )
    return _plain(mean)


def city_rollup(latest: DataFrame) -> DataFrame:
    """AGG15: city mean, worst value and its place, in one row, from one value per place."""
    return latest.agg(
        F.avg("value").alias("mean_value"),
        F.max("value").alias("max_value"),
        F.max_by("name", F.struct("value", "name")).alias("max_name"),
        F.min("value").alias("min_value"),
    )


def heat_weights(latest: DataFrame) -> DataFrame:
    """AGG15: each value above the lowest one, which is a one-value subquery."""
    lowest = latest.agg(F.min("value")).scalar()
    return latest.withColumn("weight", F.col("value") - lowest)
