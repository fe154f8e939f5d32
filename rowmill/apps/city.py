"""City mobility: the four batch ingests behind the enrichment streams (PIP4-PIP7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill import schemas
from rowmill.functions.dates import parse_timestamp
from rowmill.functions.text import repair_coordinate
from rowmill.operators.groups import latest_rows
from rowmill.sinks.files import write_partitioned
from rowmill.sinks.unseen import append_unseen, without_key
from rowmill.sources.files import fold_files
from rowmill.sources.nested import envelope_rows, named_value, source_rows
from rowmill.streaming.mobility import hourly_maxima


def traffic_history(raw: DataFrame) -> DataFrame:
    """PIP4: error-free readings, typed, with the parts of their time."""
    time = F.col("datetime")
    return (
        raw.where(F.col("error") == "N")
        .withColumn("datetime", parse_timestamp(F.col("fecha")))
        .select(
            "id", "datetime", F.dayofmonth(time).alias("day"),
            F.col("intensidad").try_cast("double").alias("intensity"),
            F.col("ocupacion").try_cast("double").alias("occupancy"),
            F.col("carga").try_cast("double").alias("load"),
            F.year(time).alias("year"), F.month(time).alias("month"),
        )
    )


def save_traffic_history(history: DataFrame, path: str) -> None:
    write_partitioned(history, path, ["year", "month"])


def save_hourly_maxima(history: DataFrame, path: str) -> None:
    """What the traffic stream needs of the history, by month."""
    write_partitioned(hourly_maxima(history), path, ["month"])


def sensor_locations(rows: DataFrame) -> DataFrame:
    """PIP5: usable coordinates, and per sensor the row of the newest file."""
    repaired = rows.select(
        F.col("id").try_cast("int").alias("id"),
        F.col("nombre").alias("name"),
        repair_coordinate(F.col("longitud")).alias("longitude"),
        repair_coordinate(F.col("latitud"), limit=90.0).alias("latitude"),
        "csv_index",
    )
    return latest_rows(repaired.na.drop("any"), ["id"], ["csv_index"])


def register_locations(spark: SparkSession, paths, version_pattern: str, target: str) -> tuple[bool, DataFrame]:
    """PIP5: append the sensors the registry lacks; also return the lines that did not parse."""
    sound, rejected = fold_files(spark, paths, schemas.TRAFFIC_LOCATIONS_RAW, ";", version_pattern)
    added = append_unseen(sensor_locations(sound), target, schemas.TRAFFIC_LOCATIONS, ["id"], ["csv_index"])
    return added, rejected


def parking_sites(replies: DataFrame, details: DataFrame) -> DataFrame:
    """PIP6: sites whose detail names a total above zero, typed by the registry's schema."""
    sites = envelope_rows(replies).select(
        F.col("id").try_cast("int").alias("id"),
        F.get("geometry.coordinates", F.lit(1)).try_cast("double").alias("latitude"),
        F.get("geometry.coordinates", F.lit(0)).try_cast("double").alias("longitude"),
        "name",
    )
    features = F.get(F.col("data"), F.lit(0))["features"]
    totals = details.select("id", named_value(features, "Total").alias("total_slots"))
    return sites.join(totals.where(F.col("total_slots") != 0), "id")


def points_of_interest(replies: DataFrame, source_name: str) -> DataFrame:
    """PIP7: the points of one source's list."""
    return source_rows(replies, source_name).select(
        "category",
        F.col("longitude").try_cast("double").alias("longitude"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("idPoi").try_cast("int").alias("id"),
        "name",
    )


def register_parkings(sites: DataFrame, target: str) -> bool:
    return append_unseen(sites, target, schemas.PARKING_REGISTRY, ["id"], ["total_slots"])


def register_points(points: DataFrame, target: str) -> tuple[bool, DataFrame]:
    """PIP7: append the points the registry lacks; also return those whose id is no number."""
    return append_unseen(points, target, schemas.POI_REGISTRY, ["id"], ["category"]), without_key(points, ["id"])


def bike_messages(replies: DataFrame) -> DataFrame:
    """SRC18: station rows of the bike feed, with the reply's time on each."""
    return envelope_rows(replies, "datetime").select(
        "id", "name",
        F.get("geometry.coordinates", F.lit(0)).alias("longitude"),
        F.get("geometry.coordinates", F.lit(1)).alias("latitude"),
        "free_bases", "total_bases",
        F.col("reservations_count").alias("reservations"),
        F.col("activate").alias("active"),
        F.col("datetime").try_cast("timestamp").alias("datetime"),
    )


def parking_messages(replies: DataFrame) -> DataFrame:
    return envelope_rows(replies, "datetime").select(
        F.col("datetime").try_cast("timestamp").alias("datetime"),
        F.col("id").cast("string").alias("id"),
        F.col("freeParking").alias("free_slots"),
    )


def traffic_messages(records: DataFrame) -> DataFrame:
    """SRC17: the sensor feed's fields under the names the streams use."""
    return records.select(
        F.col("idelem").alias("id"), F.col("intensidad").alias("intensity"),
        F.col("ocupacion").alias("occupancy"), F.col("carga").alias("load"),
    )
