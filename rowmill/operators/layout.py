"""Physical layout a user steers: profiles, sizes, partition counts (PHY1-PHY13)."""

from __future__ import annotations

import math
import re
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def partition_profile(df: DataFrame) -> DataFrame:
    """PHY3: rows per partition, counted where the rows lie."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def key_spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """PHY3: in how many partitions each key's rows lie."""
    located = df.select(*keys, F.spark_partition_id().alias("__part"))
    return located.groupBy(*keys).agg(
        F.count_distinct("__part").alias("partitions"), F.count(F.lit(1)).alias("row_count")
    )


def plan_bytes(df: DataFrame) -> int:
    """PHY4: Catalyst's size estimate of the optimised plan.

    Nothing is computed for it.  The estimate of an aggregate is that of its input, so it errs on
    the large side.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _kept_bytes(df: DataFrame) -> int:
    """Size of a persisted frame's stored rows, which its relation knows once all of them are stored."""
    # A plan made after persisting reads the stored rows; the frame's own may have been made before.
    return plan_bytes(df.alias("kept"))


def cached_bytes(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> int:
    """PHY4: what the frame's rows take in memory: they are all stored, measured and dropped again.

    A frame that is already persisted is filled and stays as it is.
    """
    held = df.storageLevel != StorageLevel.NONE
    kept = df if held else df.persist(level)
    try:
        kept.count()
        return _kept_bytes(kept)
    finally:
        if not held:
            kept.unpersist(blocking=True)


def sampled_bytes(df: DataFrame, share: float = 0.01, keys: list[str] | None = None) -> int:
    """PHY4: the same from a sample: the rows whose hash falls in a ``share`` are stored and scaled up.

    The choice depends on the rows (or on ``keys``), not on chance, so a repeated call gives the same
    figure.  The share that was drawn is taken from counts, not from ``share``: copies of a row are drawn
    together.  0 for a frame without rows; a sample without any is drawn again ten times as large.
    """
    if not 0 < share <= 1:
        raise ValueError("a sample is a share of the rows above 0, up to 1")
    steps = 1 << 30
    spot = F.pmod(F.xxhash64(*[F.col(k) for k in keys or df.columns]), F.lit(steps))
    sample = df.where(spot < math.ceil(share * steps)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        drawn = sample.count()
        size = _kept_bytes(sample)
    finally:
        sample.unpersist(blocking=True)
    if drawn:
        return round(size * df.count() / drawn)
    return 0 if share == 1 else sampled_bytes(df, min(1.0, share * 10), keys)


def broadcast_bytes(spark: SparkSession) -> int:
    """Up to which size Catalyst broadcasts a side of a join; 0 where it never does."""
    return max(0, parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").replace("-1", "0")))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """PHY4: what a written path takes on storage, from file metadata."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(file_system.getContentSummary(jvm_path).getLength())


def parse_bytes(text: str) -> int:
    """A Spark size setting (``134217728b``, ``128m``, ``64KB``) in bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def advised_partitions(df: DataFrame, target_bytes: int | None = None, size_bytes: int | None = None) -> int:
    """PHY5: partitions that keep each within the scan split size.

    ``size_bytes`` is a better figure than the plan's, such as ``cached_bytes`` or ``sampled_bytes`` give.
    """
    if target_bytes is None:
        target_bytes = parse_bytes(df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    return max(1, math.ceil((plan_bytes(df) if size_bytes is None else size_bytes) / target_bytes))


def small_pandas(df: DataFrame, most: int):
    """PHY12, SRC4: a frame of at most ``most`` rows as a pandas frame; one row more raises, and no more are sent."""
    rows = df.limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return rows


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """PHY10: the plan as text, for assertions about pushed filters, exchanges and join kinds."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def release_all(spark: SparkSession) -> None:
    """PHY7: drop every cached frame of the session."""
    spark.catalog.clearCache()


@contextmanager
def job_label(spark: SparkSession, description: str):
    """PHY13: actions inside the block carry this description in the job list."""
    spark.sparkContext.setJobDescription(description)
    try:
        yield
    finally:
        spark.sparkContext.setJobDescription(None)
