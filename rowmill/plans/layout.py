"""Queries over physical layout (PHY1-PHY13)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.operators import layout
from rowmill.operators.joins import join_small
from rowmill.registry import query, table
from rowmill.session import ensure_checkpoint_dir, fresh_path, session_settings
from rowmill.sinks.files import write_noop

_STATUS_SQL = "SELECT o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY 1"


def _per_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("orders"))


@query("PHY1 PHY3", "SELECT o_custkey, 1 AS partitions, count(*) AS row_count FROM orders GROUP BY 1")
def phy_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After hashing by a key, each key lies in one partition."""
    return layout.key_spread(table(spark, sf_dir, "orders").select("o_custkey").repartition(16, "o_custkey"), ["o_custkey"])


@query("PHY1 PHY2", """
    SELECT 'round robin' AS layout, 6 AS partitions, count(*) AS row_count FROM orders
    UNION ALL SELECT 'coalesced', 2, count(*) FROM orders
""")
def phy_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even spreading to six partitions, and merging those to two without a shuffle."""
    six = table(spark, sf_dir, "orders").select("o_orderkey").repartition(6)

    def summary(df: DataFrame, name: str) -> DataFrame:
        profile = layout.partition_profile(df)
        return profile.agg(
            F.lit(name).alias("layout"), F.count(F.lit(1)).alias("partitions"), F.sum("row_count").alias("row_count")
        )

    return summary(six, "round robin").unionByName(summary(six.coalesce(2), "coalesced"))


@query("PHY3", "SELECT count(*) AS row_count, true AS even FROM lineitem")
def phy_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition of an evenly spread table add up, and no partition stands out."""
    profile = layout.partition_profile(table(spark, sf_dir, "lineitem").select("l_orderkey").repartition(8))
    return profile.agg(
        F.sum("row_count").alias("row_count"), (F.max("row_count") <= F.avg("row_count") * 2).alias("even")
    )


@query("PHY4 PHY5 PHY6", "SELECT count(*) AS row_count, true AS fewer_for_larger_splits, true AS stored FROM lineitem")
def phy_size_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned size, stored size, and the partition count they advise for two split sizes."""
    lines = table(spark, sf_dir, "lineitem")
    planned = layout.plan_bytes(lines)
    few, many = layout.advised_partitions(lines, planned), layout.advised_partitions(lines, max(planned // 10, 1))
    path = fresh_path(spark, "lineitem-size")
    lines.select("l_orderkey").write.parquet(path)
    stored = layout.stored_bytes(spark, path) > 0
    return lines.agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(few < many).alias("fewer_for_larger_splits"), F.lit(stored).alias("stored")
    )


@query("PHY4 PHY5", """
    SELECT count(*) AS row_count, true AS sampled_is_near, true AS planned_is_apart, count(*) AS joined FROM lineitem
""")
def phy_measured_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sizes of the same rows: planned, filled into the cache, and a hash sample's scaled up.  The
    sample's lies within a tenth of the cache's; the plan's is that of the compressed file and does not.  The
    measured size of the parts decides how they are joined."""
    lines = table(spark, sf_dir, "lineitem")
    cached, sampled, planned = layout.cached_bytes(lines), layout.sampled_bytes(lines, 0.2), layout.plan_bytes(lines)
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"))
    joined = join_small(lines, parts, "l_partkey", size_bytes=layout.sampled_bytes(parts, 0.2))
    return lines.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(abs(sampled - cached) <= 0.1 * cached).alias("sampled_is_near"),
        F.lit(abs(planned - cached) > 0.1 * cached).alias("planned_is_apart"),
        joined.agg(F.count(F.lit(1))).scalar().alias("joined"),
    )


@query("PHY6", "SELECT count(*) AS row_count, true AS more_splits FROM documents")
def phy_scan_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smaller scan splits give more tasks over the same rows."""
    def tasks(split: str) -> int:
        with session_settings(
            spark, spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="0",
            spark__sql__files__minPartitionNum="1",
        ):
            return table(spark, sf_dir, "documents").rdd.getNumPartitions()

    size = layout.plan_bytes(table(spark, sf_dir, "documents"))
    more = tasks(f"{max(size // 4, 1)}b") > tasks(f"{size * 4}b")
    return table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("row_count"), F.lit(more).alias("more_splits"))


@query("PHY7", _STATUS_SQL)
def phy_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two answers from rows kept once on two executors, then released."""
    kept = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").persist(StorageLevel.MEMORY_AND_DISK_2)
    try:
        path = fresh_path(spark, "statuses")
        kept.agg(F.max("o_orderkey")).collect()
        _per_status(kept).write.parquet(path)
    finally:
        kept.unpersist()
    return spark.read.parquet(path)


@query("PHY8", _STATUS_SQL)
def phy_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage cut by a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(spark)
    return _per_status(table(spark, sf_dir, "orders")).checkpoint()


@query("PHY9", """
    SELECT 'fixed' AS plan, o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY 2
    UNION ALL SELECT 'adaptive', o_orderstatus, count(*) FROM orders GROUP BY 2
""")
def phy_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffle partitions and AQE set per run: other plans, same answer."""
    path = fresh_path(spark, "settings")
    for plan, partitions, adaptive in (("fixed", "16", "false"), ("adaptive", "64", "true")):
        with session_settings(spark, spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__enabled=adaptive):
            _per_status(table(spark, sf_dir, "orders")).write.parquet(f"{path}/plan={plan}")
    return spark.read.parquet(path)


@query("PHY10 SRC13", """
    SELECT count(*) AS orders, true AS pushed, true AS pruned FROM orders WHERE o_totalprice > 300000
""")
def phy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the plan says about the scan, beside the answer."""
    dear = table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 300000).agg(F.count(F.lit(1)).alias("orders"))
    text = layout.plan_text(dear)
    return dear.withColumns({
        "pushed": F.lit("GreaterThan(o_totalprice,300000.0)" in text),
        "pruned": F.lit("ReadSchema: struct<o_totalprice:double>" in text),
    })


@query("PHY11", "SELECT count(*) AS customers, true AS listed FROM customer")
def phy_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    name = fresh_path(spark, "customers").rsplit("/", 1)[1].replace("-", "_")
    customers.createOrReplaceTempView(name)
    listed = any(row["tableName"] == name for row in spark.sql(f"SHOW TABLES LIKE '{name}'").collect())
    spark.catalog.dropTempView(name)
    return customers.agg(F.count(F.lit(1)).alias("customers"), F.lit(listed).alias("listed"))


@query("PHY12 PHY13", """
    SELECT count(*) AS counted, max(o_totalprice) AS dearest, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest FROM orders
""")
def phy_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded results brought to the driver under a job label."""
    orders = table(spark, sf_dir, "orders")
    with layout.job_label(spark, "bounded actions"):
        counted = orders.count()
        dearest = orders.select("o_totalprice").orderBy(F.desc("o_totalprice")).take(1)[0][0]
        cheapest = orders.agg(F.min_by("o_orderkey", F.struct("o_totalprice", "o_orderkey"))).collect()[0][0]
    return spark.createDataFrame([(counted, dearest, cheapest)], "counted bigint, dearest double, cheapest bigint")


@query("SNK10 PHY13", "SELECT count(*) AS lines FROM lineitem")
def phy_timed_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled run that computes every column and keeps none, as timing runs do."""
    lines = table(spark, sf_dir, "lineitem")
    with layout.job_label(spark, "noop over lineitem"):
        write_noop(lines)
    return lines.agg(F.count(F.lit(1)).alias("lines"))
