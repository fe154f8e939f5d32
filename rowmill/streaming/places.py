"""Fusion with state per place (ST20, ST24): readings are summed before they meet any point.

The stream keeps one running (sum, count) per place, merged map-side, so a place that sends a third of
all readings is one state row.  Each batch hands on only the places that changed; these are stored
below the shared folder, joined with the points once, and the points near them get a new mean.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rowmill.operators.radius import radius_join
from rowmill.sources.files import list_numbered, remove_folder

PLACE = ["longitude", "latitude"]
POINT = ["point_id", "point_name", "point_longitude", "point_latitude"]
# Batches between two summaries of the stored places.
SUMMARY_EVERY = 16

Sink = Callable[[DataFrame, int], None]


def _known(streams: list[DataFrame], columns: list[str]) -> DataFrame:
    readings = streams[0].select(*columns)
    for stream in streams[1:]:
        readings = readings.unionByName(stream.select(*columns))
    return readings.where(F.col("occupancy").isNotNull())


def place_totals(streams: list[DataFrame]) -> DataFrame:
    """Running sum and count of the known readings per place, for ever: a row per place, not per reading."""
    return _known(streams, ["occupancy", *PLACE]).groupBy(*PLACE).agg(
        F.sum("occupancy").alias("total"), F.count(F.lit(1)).alias("n")
    )


def windowed_place_totals(streams: list[DataFrame], event_time: str, window: str, lateness: str) -> DataFrame:
    """The same per event-time window; a window's state goes once all streams' watermarks have passed it."""
    timed = [stream.withWatermark(event_time, lateness) for stream in streams]
    known = _known(timed, [event_time, "occupancy", *PLACE])
    return known.groupBy(F.window(event_time, window), *PLACE).agg(
        F.sum("occupancy").alias("total"), F.count(F.lit(1)).alias("n")
    )


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({name: name.removeprefix("point_") for name in df.columns})


def point_means(points: DataFrame, totals: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean occupancy near each point from totals per place."""
    mean = radius_join(points, totals).groupBy(*(by or []), *POINT).agg((F.sum("total") / F.sum("n")).alias("occupancy"))
    return _plain(mean)


class PlaceState:
    """The places' newest totals as files: what each batch changed, and from time to time a summary.

    A batch that is replayed overwrites what it wrote and reads only what came before it, so it gives
    the same rows again.  With ``silent`` a place that has sent nothing in so many batches is forgotten:
    it counts for no mean until it sends again, and then with all it has sent.
    """

    def __init__(self, spark: SparkSession, path: str, silent: int | None = None):
        self.spark, self.path, self.silent = spark, path.rstrip("/"), silent

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("longitude double, latitude double, total double, n long, heard long").parquet(*paths)

    def add(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """Store a batch's changed places; return them and the newest totals of all places so far."""
        own = f"{self.path}/changed={batch_id}"
        batch.select(*PLACE, "total", "n", F.lit(batch_id).cast("long").alias("heard")).write.mode("overwrite").parquet(own)
        changed = self._read([own])
        bases = [n for n in list_numbered(self.spark, self.path, "summary") if n < batch_id]
        base = max(bases, default=-1)
        deltas = [n for n in list_numbered(self.spark, self.path, "changed") if base < n < batch_id]
        paths = [f"{self.path}/summary={base}"] * (base >= 0) + [f"{self.path}/changed={n}" for n in deltas]
        if not paths:
            return changed, changed
        newest = self._read([*paths, own]).groupBy(*PLACE).agg(
            F.max_by("total", "heard").alias("total"), F.max_by("n", "heard").alias("n"), F.max("heard").alias("heard")
        )
        if self.silent is not None:
            newest = newest.where(F.col("heard") > batch_id - self.silent)
        if len(deltas) + 1 >= SUMMARY_EVERY:
            newest.write.mode("overwrite").parquet(f"{self.path}/summary={batch_id}")
            newest = self._read([f"{self.path}/summary={batch_id}"])
            # The batch before may be replayed, which reads the summary that this one was made from.
            for n in list_numbered(self.spark, self.path, "changed"):
                if n <= base:
                    remove_folder(self.spark, f"{self.path}/changed={n}")
            for n in bases:
                if n < base:
                    remove_folder(self.spark, f"{self.path}/summary={n}")
        return changed, newest


def fuse_by_place(
    points: DataFrame, streams: list[DataFrame], state: str, sinks: list[Sink], silent: int | None = None
) -> DataStreamWriter:
    """ST20, ST24: the writer of a fusion; every batch gives the sinks the points whose mean has changed.

    Sinks are called with (rows, batch id) and must make a replay of the same id harmless.  Changed places
    are few beside the readings; only the points near them meet the stored places again.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        changed, newest = PlaceState(batch.sparkSession, state, silent).add(batch, batch_id)
        near = points
        if newest is not changed:
            touched = radius_join(points, changed).select(F.col("point_id").alias("id")).distinct()
            near = points.join(touched, "id", "left_semi")
        means = point_means(near, newest).persist()
        try:
            for sink in sinks:
                sink(means, batch_id)
        finally:
            means.unpersist()

    return place_totals(streams).writeStream.outputMode("update").foreachBatch(merge)


def fuse_windows_by_place(
    points: DataFrame, streams: list[DataFrame], event_time: str, window: str, lateness: str, sinks: list[Sink]
) -> DataStreamWriter:
    """ST24 over event-time windows: a window's places come in one batch, once no stream can add to it."""

    def close(batch: DataFrame, batch_id: int) -> None:
        means = point_means(points, batch, ["window"])
        rows = means.select(
            F.col("window.start").alias("start_time"), F.col("window.end").alias("end_time"),
            *[name.removeprefix("point_") for name in POINT], "occupancy",
        ).persist()
        try:
            for sink in sinks:
                sink(rows, batch_id)
        finally:
            rows.unpersist()

    totals = windowed_place_totals(streams, event_time, window, lateness)
    return totals.writeStream.outputMode("append").foreachBatch(close)
