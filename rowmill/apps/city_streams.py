"""City mobility: the four streaming jobs (ST21-ST24) from messages to messages.

Each stage takes message streams (or tables) and returns the rows of its output topic; where those
come from and go to is bound by ``start`` or by a test.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rowmill import schemas
from rowmill.sinks.topics import topic_rows
from rowmill.streaming import mobility, places, run
from rowmill.streaming.events import decode

# fixed values: how often each stage looks for new messages
TRIGGERS = {"bikes": "10 seconds", "parking": "10 seconds", "traffic": "20 seconds", "fusion": "5 seconds"}


def _occupancy_rows(df: DataFrame) -> DataFrame:
    return topic_rows(df, F.col("id"), mobility.OCCUPANCY)


def bikes_stage(messages: DataFrame) -> DataFrame:
    return _occupancy_rows(mobility.bike_occupancy(decode(messages, schemas.BIKES_MESSAGE)))


def parking_stage(messages: DataFrame, registry: DataFrame) -> DataFrame:
    return _occupancy_rows(mobility.parking_occupancy(decode(messages, schemas.PARKING_MESSAGE), registry))


def traffic_stage(
    messages: DataFrame, locations: DataFrame, hourly: DataFrame, now: Column | None = None
) -> DataFrame:
    """``hourly`` is the stored ``hourly_maxima`` of the traffic history."""
    readings = decode(messages, schemas.TRAFFIC_MESSAGE)
    return _occupancy_rows(mobility.traffic_occupancy(readings, locations, mobility.usual_maximum(hourly, now)))


def readings_of(topic: DataFrame) -> DataFrame:
    """The occupancies of an output topic, each with the time at which its message was sent, if there is one."""
    timed = [F.col("timestamp").alias("sent")] if "timestamp" in topic.columns else []
    fields = F.inline(F.array(F.from_json(F.col("value").cast("string"), schemas.OCCUPANCY_MESSAGE)))
    return topic.select(*timed, fields)


def fusion_rows(fused: DataFrame) -> DataFrame:
    """Points with a new mean, as the messages that the dashboard's topic takes."""
    times = [name for name in ("start_time", "end_time") if name in fused.columns]
    return topic_rows(fused, columns=[*times, "id", "name", "longitude", "latitude", "occupancy"])


def start(rows: DataFrame, stage: str, sink: dict[str, str], checkpoint: str) -> StreamingQuery:
    """Run an enrichment on its clock into a topic."""
    return run.every(run.to_topic(rows, sink), checkpoint, TRIGGERS[stage]).start()


def start_refreshed(
    messages: DataFrame, stage: str, enrich: Callable[[DataFrame, DataFrame], DataFrame], registry: str, ddl: str,
    sink: dict[str, str], checkpoint: str,
) -> StreamingQuery:
    """Run an enrichment whose registry is a folder of versions: each batch meets the newest one, so what is
    registered after the start is seen.  Which version a batch has used is noted beside the checkpoint."""

    def send(rows: DataFrame, batch_id: int) -> None:
        rows.write.format("kafka").options(**sink).save()

    writer = run.with_registry(messages, registry, ddl, f"{checkpoint}-registry", enrich, [send])
    return run.every(writer, checkpoint, TRIGGERS[stage]).start()


def fusion_writer(
    points: DataFrame, topics: list[DataFrame], state: str, sinks: list[places.Sink],
    window: str | None = None, lateness: str = "10 minutes", silent: int | None = None,
) -> DataStreamWriter:
    """The fusion of the three stages' output topics: means since the start, of which each batch sends those
    that changed, or with ``window`` the means of each window once it is over."""
    readings = [readings_of(topic) for topic in topics]
    if window is None:
        return places.fuse_by_place(points, readings, state, sinks, silent)
    return places.fuse_windows_by_place(points, readings, "sent", window, lateness, sinks)


def start_fusion(
    points: DataFrame, topics: list[DataFrame], sink: dict[str, str], checkpoint: str,
    window: str | None = None, lateness: str = "10 minutes", silent: int | None = None,
) -> StreamingQuery:
    """Run the fusion on its clock into a topic; places are stored beside the checkpoint."""

    def send(fused: DataFrame, batch_id: int) -> None:
        # A replayed batch sends its means again, which are the same ones.
        fusion_rows(fused).write.format("kafka").options(**sink).save()

    writer = fusion_writer(points, topics, f"{checkpoint}-places", [send], window, lateness, silent)
    return run.every(writer, checkpoint, TRIGGERS["fusion"]).start()
