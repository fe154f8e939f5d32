"""File and table sinks (SNK1-SNK10)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.session import fresh_path, session_settings
from rowmill.sources.files import remove_folder


def write_files(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists", **options) -> None:
    """SNK1, SNK2, SNK3."""
    df.write.format(fmt.lower()).mode(mode.lower()).options(**options).save(path)


@contextmanager
def _task_bytes(spark: SparkSession, size: str | None):
    """Let AQE size the tasks of a write, and with them its files."""
    if size is None:
        yield
    else:
        with session_settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=size):
            yield


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    mode: str = "overwrite",
    dynamic: bool = False,
    task_bytes: str | None = None,
) -> None:
    """SNK4, SNK5, SNK6: Parquet under ``col=value`` directories.

    REBALANCE gathers each partition value in few tasks, so that no task writes a file into every
    directory, and AQE splits a value that holds too many bytes for one task.  ``dynamic``
    replaces only the directories the frame has rows for; otherwise the whole target goes.
    ``task_bytes`` (say ``512m``) sets how much one task, and so one file, takes.
    """
    with _task_bytes(df.sparkSession, task_bytes):
        (
            df.hint("rebalance", *partition_by)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
            .partitionBy(*partition_by)
            .parquet(path)
        )


def write_table(
    df: DataFrame,
    name: str,
    path: str,
    buckets: int,
    bucket_by: list[str],
    partition_by: list[str] | None = None,
    task_bytes: str | None = None,
) -> None:
    """SNK7, SNK8: external Parquet table, hashed into sorted buckets, optionally partitioned.

    Rows are first gathered by directory and bucket, so the table has few files per bucket and
    not one per task and bucket; AQE splits a bucket that a hot key makes too large for one task.
    """
    bucket = F.pmod(F.hash(*bucket_by), F.lit(buckets))
    gathered = df.withColumn("__bucket", bucket).hint("rebalance", *(partition_by or []), "__bucket")
    spread = gathered.drop("__bucket")
    writer = spread.write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _task_bytes(df.sparkSession, task_bytes):
        writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by).saveAsTable(name)


def write_single_file(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK9: one file, written by one task as the caller asks, whatever its size.

    The rows are computed and stored in parallel first, so that the one task only copies them; this
    write's stored copy, and no other's, is removed.
    """
    spark = df.sparkSession
    staged = fresh_path(spark, "staged")
    try:
        df.write.parquet(staged)
        spark.read.schema(df.schema).parquet(staged).coalesce(1).write.mode("overwrite").format(fmt).save(path)
    finally:
        remove_folder(spark, staged)


def write_noop(df: DataFrame) -> None:
    """SNK10: compute every row and keep none."""
    df.write.format("noop").mode("overwrite").save()
