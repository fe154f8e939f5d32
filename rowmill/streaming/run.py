"""Starting and finishing streaming queries (ST8-ST19, ST25)."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from rowmill.operators.groups import latest_rows
from rowmill.session import session_settings
from rowmill.sources.files import list_numbered, make_folder

STATE_PARTITIONS = "rowmill.state.partitions"


def state_partitions(spark: SparkSession) -> int:
    """Shuffle partitions of a stateful query, which AQE does not merge: what the session sets as
    ``rowmill.state.partitions``, else one per core.

    The number is written into the checkpoint and stays for the life of the query, so set it where
    executors come and go: the cores of the first moment may be few.
    """
    return int(spark.conf.get(STATE_PARTITIONS, str(max(spark.sparkContext.defaultParallelism, 1))))


def stateful_settings(spark: SparkSession, partitions: int | None = None) -> dict[str, str]:
    """State on executor disks with changelog checkpoints, so that it may outgrow the heap."""
    return {
        "spark__sql__shuffle__partitions": str(partitions or state_partitions(spark)),
        "spark__sql__streaming__stateStore__providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "true",
    }


def available_now(writer: DataStreamWriter, checkpoint: str) -> DataStreamWriter:
    """ST13, ST19: process what is there, then stop; the checkpoint is always named."""
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)


def every(writer: DataStreamWriter, checkpoint: str, interval: str) -> DataStreamWriter:
    """ST12, ST19."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval)


def finish(query: StreamingQuery) -> None:
    """ST25: wait for the end; a failed query raises here."""
    query.awaitTermination()


def stop(query: StreamingQuery, poll_seconds: float = 0.2) -> None:
    """ST25: let the batch in progress end, then stop; a restart goes on from the checkpoint."""
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(poll_seconds)
    query.stop()


def complete(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> None:
    """ST13: run a stateful query to the end of what is there."""
    with session_settings(spark, **stateful_settings(spark)):
        finish(available_now(writer, checkpoint).start())


def on_clock(writer: DataStreamWriter, checkpoint: str, interval: str, rows: int, patience: float = 300) -> list[dict]:
    """ST12: run a query on its clock until its progress events say that it has read ``rows`` rows, then stop it
    between two batches; those events, one for each batch with rows, come back.

    A query that fails raises; one that has not read them within ``patience`` seconds is stopped and raises.
    """
    query = every(writer, checkpoint, interval).start()
    events: dict[int, dict] = {}
    until = time.monotonic() + patience
    try:
        while sum(event["numInputRows"] for event in events.values()) < rows:
            if query.exception() is not None:
                raise query.exception()
            if time.monotonic() > until:
                raise TimeoutError(f"{checkpoint}: {sum(e['numInputRows'] for e in events.values())} of {rows} rows")
            events |= {event["batchId"]: event for event in query.recentProgress if event["numInputRows"]}
            time.sleep(0.05)
    finally:
        stop(query)
    return [events[batch] for batch in sorted(events)]


def publish_snapshot(df: DataFrame, path: str) -> int:
    """J12: a new version of a registry, beside the earlier ones; readers see it once it is complete."""
    version = max(list_numbered(df.sparkSession, path, "version"), default=-1) + 1
    df.write.parquet(f"{path.rstrip('/')}/version={version}")
    return version


def batch_snapshot(spark: SparkSession, path: str, used: str, batch_id: int, ddl: str) -> DataFrame:
    """J12: the newest version of a registry, as a batch meets it.

    Which one is noted below ``used`` before it is read: a batch that is replayed meets the same version,
    however many have come since.  Without any version the registry is empty.
    """
    noted = f"{used.rstrip('/')}/batch={batch_id}"
    if batch_id not in list_numbered(spark, used, "batch"):
        newest = max(list_numbered(spark, path, "version"), default=-1)
        spark.range(1).select(F.lit(newest).cast("long").alias("version")).write.mode("overwrite").parquet(noted)
    version = spark.read.schema("version long").parquet(noted).first()["version"]
    if version < 0:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(f"{path.rstrip('/')}/version={version}")


def with_registry(
    stream: DataFrame, path: str, ddl: str, used: str, enrich: Callable[[DataFrame, DataFrame], DataFrame], sinks: list
) -> DataStreamWriter:
    """J12, ST22, ST23: the writer of an enrichment whose static side may change while it runs.

    Every batch is enriched with the registry's newest version at that time and handed to the sinks, called
    with (rows, batch id).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        registry = batch_snapshot(batch.sparkSession, path, used, batch_id, ddl)
        rows = enrich(batch, registry).persist()
        try:
            for sink in sinks:
                sink(rows, batch_id)
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(write)


def to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", **options) -> None:
    """ST10, ST16: append to files whose log makes committed batches exactly once."""
    with session_settings(stream.sparkSession, **stateful_settings(stream.sparkSession)):
        writer = stream.writeStream.outputMode("append").format(fmt).options(path=path, **options)
        finish(available_now(writer, checkpoint).start())


def to_batch_dirs(stream: DataFrame, path: str, checkpoint: str, mode: str) -> DataFrame:
    """ST8, ST9: each batch's rows under ``batch_id=N``, overwritten when a batch is replayed.

    A stream without input leaves an empty folder and gives no rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    spark = stream.sparkSession
    with session_settings(spark, **stateful_settings(spark)):
        writer = stream.writeStream.outputMode(mode).foreachBatch(write)
        finish(available_now(writer, checkpoint).start())
    make_folder(spark, path)
    written = StructType([*stream.schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(written).parquet(path)


def newest_batch(written: DataFrame) -> DataFrame:
    """Complete mode: the last batch holds the whole result."""
    last = written.agg(F.max("batch_id")).scalar()
    return written.where(F.col("batch_id") == last).drop("batch_id")


def newest_version(written: DataFrame, keys: list[str]) -> DataFrame:
    """Update mode: the last row written per key."""
    return latest_rows(written, keys, ["batch_id"]).drop("batch_id")


def to_memory(stream: DataFrame, name: str, checkpoint: str, mode: str) -> DataFrame:
    """ST15: a driver-held table for results known to be small; read it with SQL by its name."""
    spark = stream.sparkSession
    with session_settings(spark, **stateful_settings(spark)):
        writer = stream.writeStream.outputMode(mode).format("memory").queryName(name)
        finish(available_now(writer, checkpoint).start())
    return spark.table(name)


def to_console(stream: DataFrame, mode: str = "append") -> DataStreamWriter:
    """ST14."""
    return stream.writeStream.outputMode(mode).format("console").option("truncate", False)


def to_topic(rows: DataFrame, options: dict[str, str], mode: str = "append") -> DataStreamWriter:
    """ST17: a (key, value) stream bound to a topic."""
    return rows.writeStream.outputMode(mode).format("kafka").options(**options)


def to_many(stream: DataFrame, sinks, checkpoint: str) -> None:
    """ST18: hand every batch to several sinks, computing it once.

    Each sink is called with (batch, batch_id) and must make a replay of the same id harmless.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for sink in sinks:
                sink(kept, batch_id)
        finally:
            kept.unpersist()

    with session_settings(stream.sparkSession, **stateful_settings(stream.sparkSession)):
        finish(available_now(stream.writeStream.foreachBatch(write), checkpoint).start())


def batch_files(path: str, fmt: str = "parquet", **options):
    """A replay-safe file sink for ``to_many``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).options(**options).save(f"{path}/batch_id={batch_id}")

    return write
