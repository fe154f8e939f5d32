"""Queries over window functions (WIN1-WIN8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.numbers import exact_mean
from rowmill.operators.groups import latest_rows, nth_rows, running_ratios, with_group_values
from rowmill.operators.numbering import global_row_numbers, unique_ids
from rowmill.registry import query, table


@query("WIN1", """
    SELECT o_orderkey, o_custkey, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS top FROM orders
""")
def win_running_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximum up to the row in descending order, which is the group's maximum."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return with_group_values(orders, ["o_custkey"], top=F.max("o_totalprice")).drop("o_totalprice")


_SECOND_SQL = """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 2
"""


@query("WIN2", _SECOND_SQL)
def win_nth(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return nth_rows(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 2).drop("row_number")


@query("WIN3", _SECOND_SQL)
def win_nth_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL form; the filter on the number limits each map task's rows just the same."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    number = F.expr("row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)")
    return orders.withColumn("n", number).where("n = 2").drop("n")


@query("WIN4", """
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def win_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return latest_rows(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("WIN5", """
    WITH m AS (SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean FROM events GROUP BY 1)
    SELECT event_id, e.event_type AS event_type, value - mean AS above FROM events e JOIN m ON e.event_type = m.event_type
""")
def win_group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five event types hold all rows: the means are merged map-side and joined back."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    with_mean = with_group_values(events, ["event_type"], mean=exact_mean(F.col("value")))
    return with_mean.select("event_id", "event_type", (F.col("value") - F.col("mean")).alias("above"))


@query("WIN6 AGG3", """
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day,
                      CAST(floor(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 1000000 + 0.5) AS BIGINT) AS mean
               FROM events GROUP BY 1, 2)
    SELECT user_id, day, mean / avg(mean) OVER w AS to_mean, mean / max(mean) OVER w AS to_max
    FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def win_cumulative_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means per user against the running mean and maximum of the user's days.

    Means are held in whole millionths, so the running sums are exact in any order.
    """
    daily = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.floor(exact_mean(F.col("value")) * 1000000 + 0.5).alias("mean")
    )
    ratios = running_ratios(daily, ["user_id"], ["day"], "mean")
    return ratios.select("user_id", "day", F.col("mean_to_mean").alias("to_mean"), F.col("mean_to_max").alias("to_max"))


@query("WIN7", "SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS place FROM events")
def win_global_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive numbers over the whole table; sorted ranges, no one-task window."""
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return global_row_numbers(events, [F.col("value"), F.col("event_id")], "place").drop("value")


@query("WIN8", "SELECT count(*) AS rows_seen, count(*) AS ids FROM lineitem")
def win_unique_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are places within a partition's own range; a range as long as its rows has no repeats."""
    numbered = unique_ids(table(spark, sf_dir, "lineitem").select("l_orderkey"))
    ranges = numbered.groupBy(F.shiftright("row_id", 33).alias("range")).agg(
        F.count(F.lit(1)).alias("n"), (F.max("row_id") - F.min("row_id") + 1).alias("ids")
    )
    return ranges.agg(F.sum("n").alias("rows_seen"), F.sum("ids").alias("ids"))
