"""File and table scans (SRC5-SRC16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(
    spark: SparkSession, path: str | list[str], fmt: str, ddl: str | None = None, **options
) -> DataFrame:
    """Any file format, with the schema declared where it is known.

    A JSON source is read as lines, each a record, and its files are split; ``multiLine=True`` reads
    a file as one document (an array or object) in one task.
    """
    reader = spark.read.format(fmt.lower()).options(**options)
    return (reader.schema(ddl) if ddl else reader).load(path)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    ddl: str | None = None,
    sep: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    infer: bool = False,
) -> DataFrame:
    """SRC5, SRC6, SRC7: delimited text; ``infer`` costs one more pass over the files."""
    reader = spark.read.options(sep=sep, header=header, encoding=encoding, inferSchema=infer)
    return (reader.schema(ddl) if ddl else reader).csv(path)


def read_json_lines(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """SRC8, SRC10: one object per line; a schema with fewer fields reads only those."""
    return (spark.read.schema(ddl) if ddl else spark.read).json(path)


def read_json_documents(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """SRC9: one document per file, spread over lines."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(ddl) if ddl else reader).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC12: one ``value`` per newline-ended line."""
    return spark.read.option("lineSep", "\n").text(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def make_folder(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jvm_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def list_numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the finished ``name=number`` folders of a path; a folder is finished once its writer
    has committed it."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or []
    return sorted(int(mark.getPath().getParent().getName().partition("=")[2]) for mark in found)


def read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """SRC16: the target's rows, or none on a first run.

    Only a missing path means "first run"; a path that cannot be read raises.
    """
    if path_exists(spark, path):
        return spark.read.schema(ddl).parquet(path)
    return spark.createDataFrame([], ddl)


def first_part_file(df: DataFrame) -> str:
    """SRC15: the first file behind a scanned directory, from its listing; no row is read."""
    return min(df.inputFiles())


def fold_files(
    spark: SparkSession, paths: str | list[str], ddl: str, sep: str, version_pattern: str
) -> tuple[DataFrame, DataFrame]:
    """SET4: many same-shaped files as one table with the version taken from each file name.

    One scan covers them all.  Lines that do not fit the schema come back in the second frame
    instead of being lost.
    """
    bad = "_corrupt_record"
    rows = (
        spark.read.options(sep=sep, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=bad)
        .schema(f"{ddl}, {bad} string").csv(paths)
        .withColumn("csv_index", F.regexp_extract("_metadata.file_path", version_pattern, 1).try_cast("int"))
    )
    # A data column takes part in the test: the scan cannot serve the bad-line column alone.
    first = F.coalesce(F.col(rows.columns[0]).cast("string"), F.lit(""))
    line = F.concat(F.col(bad), F.substring(first, 1, 0))
    sound = rows.where(line.isNull()).drop(bad)
    rejected = rows.where(line.isNotNull()).select("csv_index", line.alias("line"))
    return sound, rejected
