"""Queries over user-defined functions (UDF1-UDF8), each against its native twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions import arrays, udfs
from rowmill.operators.models import assemble
from rowmill.plans.scalars import named_words
from rowmill.registry import query, table

_STEP_SQL = "SELECT p_partkey, CAST(floor(sqrt(p_size)) AS BIGINT) + 1 AS step FROM part"


@query("UDF1", _STEP_SQL)
def udf_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", udfs.root_step_python("p_size").alias("step"))


@query("UDF2", _STEP_SQL)
def udf_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"root_step_{uuid.uuid4().hex}"
    udfs.register_root_step(spark, name)
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"{name}(p_size) AS step")


@query("UDF3", _STEP_SQL)
def udf_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", udfs.root_step(F.col("p_size")).alias("step"))


@query("UDF4", _STEP_SQL)
def udf_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", udfs.root_step_pandas("p_size").alias("step"))


@query("UDF5", """
    SELECT l_orderkey, l_linenumber, l_partkey, 0e0 + 1.5e0 * l_quantity + -20e0 * l_discount + 3e0 AS score FROM lineitem
""")
def udf_model_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A broadcast linear model applied batch by batch."""
    score = udfs.linear_scorer(spark, [1.5, -20.0], 3.0)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", score("l_quantity", "l_discount").alias("score")
    )


@query("UDF6", "SELECT count(*) AS documents, count(*) AS folds, count(*) AS maps, count(*) AS filters, count(*) AS tests FROM documents")
def udf_array_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Python functions over arrays agree with the four higher-order functions on every row."""
    words = F.col("words")
    return named_words(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(udfs.total_length_udf(words) == arrays.total_length(words)).alias("folds"),
        F.count_if(udfs.upper_all_udf(words) == arrays.upper_all(words)).alias("maps"),
        F.count_if(udfs.containing_udf("th")(words) == arrays.containing(words, "th")).alias("filters"),
        F.count_if(udfs.any_longer_udf(12)(words) == arrays.any_longer(words, 12)).alias("tests"),
    )


@query("UDF7", "SELECT count(*) AS rows_seen, true AS agree FROM orders")
def udf_partition_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index a Python task sees is the partition Spark names."""
    spread = table(spark, sf_dir, "orders").select("o_orderkey").repartition(8, "o_orderkey")
    tagged = udfs.tag_partitions(spread.withColumn("spark_id", F.spark_partition_id()))
    return tagged.agg(
        F.count(F.lit(1)).alias("rows_seen"), F.bool_and(F.col("partition_id") == F.col("spark_id")).alias("agree")
    )


@query("UDF8 AGG11", """
    SELECT o_orderpriority AS priority, count(*) AS orders, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS counted
    FROM orders GROUP BY 1
""")
def udf_foreach_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter moved by a side effect, beside the counts of an aggregate."""
    orders = table(spark, sf_dir, "orders")
    counted = udfs.count_rows_by_side_effect(orders.select("o_orderstatus"), lambda row: row[0] == "F")
    return orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("orders"), F.lit(counted).alias("counted")
    )


@query("UDF5 ML1", """
    SELECT l_orderkey, l_linenumber, l_partkey, 0e0 + 1.5e0 * l_quantity + -20e0 * l_discount + 3e0 AS score, 2 AS features FROM lineitem
""")
def udf_vector_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same score from assembled feature vectors, in native expressions."""
    from pyspark.ml.functions import vector_to_array

    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax")
    vectors = assemble(lines, ["l_quantity", "l_discount"], "l_tax").withColumn("f", vector_to_array("features"))
    weighted = F.zip_with("f", F.array(F.lit(1.5), F.lit(-20.0)), lambda x, w: x * w)
    score = F.aggregate(weighted, F.lit(0.0), lambda total, x: total + x) + 3.0
    return vectors.select("l_orderkey", "l_linenumber", "l_partkey", score.alias("score"), F.size("f").alias("features"))
