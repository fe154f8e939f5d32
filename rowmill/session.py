"""Sessions, and the shared folder in which a job may leave intermediate data."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: list[tempfile.TemporaryDirectory] = []
_SHIPPED: dict = {}
_STORED: list[tuple[SparkSession, str]] = []


def build_session(app: str = "rowmill", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the defaults every operator here is written for.

    ANSI stays on (dirty values go through the ``try_*`` functions), time zone is UTC, and AQE
    with its skew-join handling is on so that shuffled joins split hot partitions at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local-mode session may go without the setting; it then gets a temporary folder that
    is removed when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if not _LOCAL_ROOTS:
        _LOCAL_ROOTS.append(tempfile.TemporaryDirectory(prefix="rowmill-"))
    return _LOCAL_ROOTS[0].name


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark)}/rowmill/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled", compression: str = "snappy") -> DataFrame:
    """Compute a frame once into the shared folder and go on from the stored rows.

    Lineage ends there, every later use reads files instead of recomputing, and Catalyst plans
    with the stored size: a small result is broadcast because it is known to be small.  What is
    stored lasts until ``release`` or the end of the process.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    _STORED.append((spark, path))
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *labels: str) -> None:
    """Remove what ``settle`` has stored, all of it or only what was stored under the labels."""
    for held in list(_STORED):
        label = held[1].rpartition("/")[2].rpartition("-")[0]
        if held[0].sparkContext is spark.sparkContext and (not labels or label in labels):
            _STORED.remove(held)
            _remove(spark, held[1])


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _release_all() -> None:
    """At the end of the process nothing that only this process knew of stays behind."""
    for spark in {id(held[0]): held[0] for held in _STORED}.values():
        if spark.sparkContext._jsc is not None:
            release(spark)


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package, once for each Spark application.

    Spark sends the archive to every executor, so nothing needs to be installed there, and what a
    module caches lasts as long as the Python worker.
    """
    context = spark.sparkContext
    if _SHIPPED.get("application") == context.applicationId:
        return
    folder = tempfile.TemporaryDirectory(prefix="rowmill-package-")
    _SHIPPED.update(application=context.applicationId, folder=folder)
    root = Path(__file__).resolve().parent
    archive = os.path.join(os.path.realpath(folder.name), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as held:
        for source in sorted(root.rglob("*.py")):
            held.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a shared folder where the session has none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/checkpoints")


@contextmanager
def current_database(spark: SparkSession, database: str):
    """SQL1: ``USE`` a database for a block; tables named inside need no prefix."""
    before = spark.catalog.currentDatabase()
    spark.sql(f"USE {database}")
    try:
        yield spark
    finally:
        spark.sql(f"USE {before}")


@contextmanager
def session_settings(spark: SparkSession, **settings: str):
    """Set runtime configuration for a block; ``__`` in a keyword stands for a dot."""
    names = {key.replace("__", "."): str(value) for key, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
