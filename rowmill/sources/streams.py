"""Stream sources (ST1-ST4): bindings only, so that transforms never know the format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(servers: str, topic: str, per_trigger: int | None = None) -> dict[str, str]:
    """ST3: the options of a topic read from its beginning."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None) -> DataFrame:
    """ST3: needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, per_trigger)).load()


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """ST1: lines from a socket, for demonstrations; it cannot replay after a failure."""
    return spark.readStream.format("socket").options(host=host, port=port).load()


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    ddl: str | None,
    files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    **options,
) -> DataFrame:
    """ST2: new files of a directory or glob; processed files can be moved to an archive.

    Without a DDL the schema is inferred, which the session must allow
    (``spark.sql.streaming.schemaInference``).
    """
    reader = spark.readStream.format(fmt).options(**options)
    if ddl is not None:
        reader = reader.schema(ddl)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if archive_dir is not None:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive_dir)
    return reader.load(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given Parquet table as a stream; the glob matches a single file and a directory alike."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")


def rate_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """ST4: synthetic rows by wall clock."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def rate_batch_stream(spark: SparkSession, rows_per_batch: int, partitions: int, start_ms: int = 0) -> DataFrame:
    """ST4: synthetic rows by batch, the same in every run."""
    return (
        spark.readStream.format("rate-micro-batch")
        .options(rowsPerBatch=rows_per_batch, numPartitions=partitions, startTimestamp=start_ms)
        .load()
    )
