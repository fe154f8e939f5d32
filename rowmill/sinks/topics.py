"""Topic and database sinks (SNK11, SNK12, ST17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def topic_rows(df: DataFrame, key: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """The (key, value) frame a topic takes: value is the row as JSON, key a string."""
    value = F.to_json(F.struct(*(columns or df.columns))).alias("value")
    return df.select(value) if key is None else df.select(key.cast("string").alias("key"), value)


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_topic(rows: DataFrame, topic: str, options: dict) -> None:
    """SNK11: batch write; needs the Kafka connector on the class path."""
    rows.write.format("kafka").options(**options).option("topic", topic).save()


def jdbc_options(url: str, table: str, driver: str, user: str, password: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "driver": driver, "user": user, "password": password}


def append_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    """SNK12: one connection per partition; the driver class must be on the class path."""
    df.write.format("jdbc").mode("append").options(**options).save()
