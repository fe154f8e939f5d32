"""Queries over sinks (SNK1-SNK14): each writes, reads back, and answers from what was stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.numbers import exact_sum
from rowmill.registry import query, table
from rowmill.session import fresh_path
from rowmill.sinks import files as sinks
from rowmill.sinks.topics import topic_rows
from rowmill.sinks.unseen import append_unseen, without_key


@query("SNK1", "SELECT n_nationkey AS a, n_name AS b, count(*) AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2")
def snk_csv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwritten twice, without a header: the second write is what remains."""
    path = fresh_path(spark, "nations-csv")
    named = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("n_nationkey", "n_name")
    sinks.write_files(named.select("n_name"), path, "csv", "overwrite")
    sinks.write_files(named, path, "csv", "overwrite")
    stored = spark.read.schema("a int, b string").csv(path)
    return stored.groupBy("a", "b").agg(F.count(F.lit(1)).alias("customers"))


@query("SNK2", """
    SELECT o_orderstatus AS status, count(*) * 2 AS written, true AS refused FROM orders GROUP BY 1
""")
def snk_parquet_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, append, and a refused second first write."""
    path = fresh_path(spark, "orders-parquet")
    statuses = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    sinks.write_files(statuses, path, "parquet")
    sinks.write_files(statuses, path, "parquet", "append")
    try:
        sinks.write_files(statuses, path, "parquet")
        refused = False
    except Exception as error:  # the analysis error of an existing path
        refused = "PATH_ALREADY_EXISTS" in str(error)
    return spark.read.parquet(path).groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("written")
    ).withColumn("refused", F.lit(refused))


@query("SNK4", """
    SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS orders
    FROM orders GROUP BY 1, 2
""")
def snk_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "orders-by-month")
    sinks.write_partitioned(_by_month(spark, sf_dir), path, ["year", "month"])
    return spark.read.parquet(path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders"))


def _by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )


def _overwritten(spark: SparkSession, sf_dir: str, dynamic: bool) -> DataFrame:
    """All years written, then 1997 again at twice the price."""
    path = fresh_path(spark, "orders-overwritten")
    orders = _by_month(spark, sf_dir)
    sinks.write_partitioned(orders, path, ["year"])
    delta = orders.where(F.col("year") == 1997).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    sinks.write_partitioned(delta, path, ["year"], dynamic=dynamic)
    return spark.read.parquet(path).groupBy("year").agg(
        F.count(F.lit(1)).alias("orders"), exact_sum(F.col("o_totalprice")).alias("total")
    )


@query("SNK5", """
    SELECT year(o_orderdate) AS year, count(*) AS orders,
           CAST(sum(CAST(o_totalprice * 2 AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1
""")
def snk_overwrite_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overwritten(spark, sf_dir, dynamic=False)


@query("SNK6", """
    SELECT year(o_orderdate) AS year, count(*) AS orders,
           CAST(sum(CAST(CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice * 2 ELSE o_totalprice END
                         AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1
""")
def snk_overwrite_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overwritten(spark, sf_dir, dynamic=True)


@query("SNK7", "SELECT l_suppkey AS supplier, count(*) AS lines FROM lineitem GROUP BY 1")
def snk_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregating by the bucket key of a bucketed table needs no shuffle."""
    path = fresh_path(spark, "lineitem-buckets")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    sinks.write_table(lines, name, path, 4, ["l_suppkey"])
    return spark.table(name).groupBy(F.col("l_suppkey").alias("supplier")).agg(F.count(F.lit(1)).alias("lines"))


@query("SNK8", """
    SELECT l_returnflag AS flag, l_suppkey AS supplier, count(*) AS lines FROM lineitem GROUP BY 1, 2
""")
def snk_partition_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "lineitem-parts-buckets")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    sinks.write_table(lines, name, path, 4, ["l_suppkey"], ["l_returnflag"])
    return spark.table(name).groupBy(
        F.col("l_returnflag").alias("flag"), F.col("l_suppkey").alias("supplier")
    ).agg(F.count(F.lit(1)).alias("lines"))


@query("SNK9", """
    SELECT o_orderpriority AS priority, count(*) AS orders, 1 AS files FROM orders GROUP BY 1
""")
def snk_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of a few rows as a single file; its stored size is checked first."""
    path = fresh_path(spark, "priorities")
    summary = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    sinks.write_single_file(summary, path)
    stored = spark.read.parquet(path)
    files = stored.select("_metadata.file_path").distinct().count()
    return stored.withColumn("files", F.lit(files))


@query("SNK10", """
    SELECT l_returnflag AS flag, count(*) AS computed FROM lineitem WHERE l_discount > 0.05 GROUP BY 1
""")
def snk_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row computed and dropped, then counted."""
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_discount") > 0.05)
    sinks.write_noop(lines)
    return lines.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("computed"))


@query("SNK11 ST17 JSN2", """
    SELECT CAST(o_orderkey AS VARCHAR) AS key,
           CASE WHEN o_orderkey % 9 = 0 THEN '{"id":' || o_orderkey || ',"status":"' || o_orderstatus || '"}'
                ELSE '{"id":' || o_orderkey || ',"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}'
           END AS value
    FROM orders
""")
def snk_topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (key, value) rows a topic takes; NULL fields are left out of the JSON."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("priority"),
    )
    return topic_rows(rows, key=F.col("id"))


@query("SNK13 J5 SRC16", """
    SELECT o_custkey AS id, min(CAST(o_orderdate AS DATE)) AS first_seen, true AS first_run, false AS second_run
    FROM orders GROUP BY 1
""")
def snk_append_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers seen up to 1997, then all of them twice: each is stored once.

    The order column is the negated day, so the row kept is the customer's earliest order.
    """
    path, ddl = fresh_path(spark, "seen-customers"), "id bigint, back int"
    seen = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), (-F.unix_date(F.to_date("o_orderdate"))).alias("back")
    )
    cut = F.unix_date(F.lit("1998-01-01").cast("date"))
    append_unseen(seen.where(-F.col("back") < cut), path, ddl, ["id"], ["back"])
    append_unseen(seen, path, ddl, ["id"], ["back"])
    again = append_unseen(seen, path, ddl, ["id"], ["back"])
    return spark.read.parquet(path).select(
        "id", F.date_from_unix_date(-F.col("back")).alias("first_seen"),
        F.lit(True).alias("first_run"), F.lit(again).alias("second_run"),
    )


@query("SNK13 J5", """
    SELECT o_orderpriority AS priority, count(o_key) AS stored, count(*) - count(o_key) AS rejected
    FROM (SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS o_key FROM orders) GROUP BY 1
""")
def snk_append_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders a third of which have lost their key, appended three times: those are returned, not stored."""
    path, ddl = fresh_path(spark, "keyed-orders"), "id bigint, priority string"
    rows = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("id"), F.col("o_orderpriority").alias("priority")
    )
    for _ in range(3):
        append_unseen(rows, path, ddl, ["id"], ["priority"])
    kept = spark.read.schema(ddl).parquet(path).unionByName(without_key(rows, ["id"]))
    return kept.groupBy("priority").agg(
        F.count("id").alias("stored"), (F.count(F.lit(1)) - F.count("id")).alias("rejected")
    )
