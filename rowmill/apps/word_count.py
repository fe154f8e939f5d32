"""Word counts and their delimited table (AGG16, AGG17, SQL1-SQL4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.text import space_tokens, words

_DELIMITED = {"sep": "\t", "quote": "\u0000", "escape": "\u0000"}  # tokens hold no tab or line end


def count_tokens(tokens: DataFrame, column: Column) -> DataFrame:
    return tokens.select(F.explode(column).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("counter")
    )


def count_words(lines: DataFrame, column: str = "value") -> DataFrame:
    """AGG16: whitespace tokens."""
    return count_tokens(lines, words(F.col(column)))


def count_space_tokens(lines: DataFrame, column: str = "value") -> DataFrame:
    """AGG17: tokens between single spaces, empty ones included."""
    return count_tokens(lines, space_tokens(F.col(column)))


def save_counts(counts: DataFrame, path: str) -> None:
    counts.select("word", "counter").write.mode("overwrite").options(**_DELIMITED).csv(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string, counter bigint").options(**_DELIMITED).csv(path)


def create_external_table(spark: SparkSession, database: str, name: str, path: str, home: str) -> str:
    """SQL1-SQL3: declare a directory tree of delimited text as a table."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{home}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{name} (word STRING, counter BIGINT) USING csv "
        "OPTIONS (sep '\\t', quote '\\u0000', escape '\\u0000', recursiveFileLookup 'true') "
        f"LOCATION '{path}'"
    )
    return f"{database}.{name}"


def top_words(spark: SparkSession, table: str, k: int) -> DataFrame:
    """SQL4, ORD3: the most frequent words; ties in word order."""
    return spark.sql(f"SELECT word, counter FROM {table} ORDER BY counter DESC, word LIMIT {int(k)}")
