"""Queries over joins (J1-J14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.numbers import exact_sum
from rowmill.operators import joins, pairs, radius
from rowmill.registry import query, table
from rowmill.session import fresh_path, session_settings
from rowmill.sinks.files import write_table


@query("J1", """
    SELECT o_orderkey, c_name, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
""")
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").alias("o")
    customers = table(spark, sf_dir, "customer").alias("c")
    return orders.join(customers, F.col("o.o_custkey") == F.col("c.c_custkey"), "inner").select(
        "o.o_orderkey", "c.c_name", "c.c_mktsegment", "o.o_totalprice"
    )


@query("J2", """
    SELECT c_custkey, c_name, o_orderkey
    FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') ON o_custkey = c_custkey
""")
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return table(spark, sf_dir, "customer").join(
        urgent, F.col("c_custkey") == F.col("o_custkey"), "left"
    ).select("c_custkey", "c_name", "o_orderkey")


@query("J3", """
    SELECT o_orderkey, c_name
    FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders)
    LEFT JOIN customer ON o_custkey = c_custkey
         AND (o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH') AND status IS NULL
""")
def join_left_compound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicates inside ON decide what matches, not which left rows remain."""
    orders = table(spark, sf_dir, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    customers = table(spark, sf_dir, "customer")
    on = joins.all_of(
        orders.o_custkey == customers.c_custkey,
        (orders.o_orderpriority == "1-URGENT") | (orders.o_orderpriority == "2-HIGH"),
        orders.status.isNull(),
    )
    return orders.join(customers, on, "left").select("o_orderkey", "c_name")


_BRAND_SQL = """
    SELECT p_brand AS brand, count(*) AS lines,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
"""


def _per_brand(joined: DataFrame) -> DataFrame:
    return joined.groupBy(F.col("p_brand").alias("brand")).agg(
        F.count(F.lit(1)).alias("lines"), exact_sum(F.col("l_quantity")).alias("quantity")
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber", "l_quantity"
    )


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand")


@query("J4", _BRAND_SQL)
def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part side is broadcast while its planned size stays within the bound."""
    return _per_brand(joins.join_small(_lines(spark, sf_dir), _parts(spark, sf_dir), "p_partkey"))


@query("J8", _BRAND_SQL)
def join_sort_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_brand(_lines(spark, sf_dir).join(_parts(spark, sf_dir).hint("merge"), "p_partkey"))


@query("J9 SNK7 SRC14", _BRAND_SQL)
def join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables hashed into the same buckets meet bucket by bucket, without a shuffle."""
    names = []
    for label, frame in (("lines", _lines(spark, sf_dir)), ("parts", _parts(spark, sf_dir))):
        path = fresh_path(spark, f"bucketed-{label}")
        names.append(path.rsplit("/", 1)[1].replace("-", "_"))
        write_table(frame, names[-1], path, 8, ["p_partkey"])
    lines, parts = (spark.table(name) for name in names)
    return _per_brand(lines.join(parts.hint("merge"), "p_partkey"))


@query("J10", _BRAND_SQL)
def join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part key spread over eight tasks."""
    return _per_brand(joins.salted_join(
        _lines(spark, sf_dir), _parts(spark, sf_dir), "p_partkey", 8, ["l_orderkey", "l_linenumber", "l_quantity"]
    ))


@query("J10 J8", """
    SELECT l_suppkey AS supplier, s_nationkey AS nation, l_returnflag AS flag, count(*) AS lines
    FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 7 ELSE l_suppkey END AS l_suppkey, l_returnflag FROM lineitem)
    JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3
""")
def join_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One supplier given a third of all lines: only such keys are salted."""
    skewed = F.when(F.col("l_returnflag") == "R", F.lit(7)).otherwise(F.col("l_suppkey")).cast("bigint")
    lines = table(spark, sf_dir, "lineitem").select(
        skewed.alias("supplier"), F.col("l_returnflag").alias("flag"), "l_orderkey", "l_linenumber", "l_partkey"
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier"), F.col("s_nationkey").alias("nation")
    )
    joined = joins.skew_join(lines, suppliers, "supplier", ["l_orderkey", "l_linenumber", "l_partkey"], parts=16)
    return joined.groupBy("supplier", "nation", "flag").agg(F.count(F.lit(1)).alias("lines"))


@query("J5", """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey")
    )
    return joins.unseen(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), urgent, ["c_custkey"])


@query("J6 AGG13", """
    SELECT least(a.c_mktsegment, b.c_mktsegment) AS label_1, greatest(a.c_mktsegment, b.c_mktsegment) AS label_2,
           count(*) AS pairs
    FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey GROUP BY 1, 2
""")
def join_self_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment pairs among the customers of one nation, counted without making the pairs."""
    return pairs.label_pair_counts(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_mktsegment")


@query("J6 DAT7", """
    SELECT least(a.o_orderpriority, b.o_orderpriority) AS label_1,
           greatest(a.o_orderpriority, b.o_orderpriority) AS label_2, count(*) AS pairs
    FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey
     AND greatest(CAST(a.o_orderdate AS DATE), CAST(b.o_orderdate AS DATE))
         < least(CAST(a.o_orderdate AS DATE), CAST(b.o_orderdate AS DATE)) + INTERVAL 1 YEAR
    GROUP BY 1, 2
""")
def join_banded_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority pairs among a customer's orders placed less than a year apart."""
    position, width = pairs.years_position(F.to_date("o_orderdate"), 1)
    return pairs.banded_label_pair_counts(
        table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", position, width
    )


def strip_sql(key: str) -> str:
    return f"-3.7e0 + ({key} % 16) * 0.0013e0 AS longitude, 40.4e0 + floor({key} / 16) * 0.0011e0 AS latitude"


def strip_place(key: str) -> dict[str, Column]:
    """Coordinates laid out from a key along a strip: more keys make it longer, not denser."""
    return {
        "longitude": F.lit(-3.7) + (F.col(key) % 16) * 0.0013,
        "latitude": F.lit(40.4) + F.floor(F.col(key) / 16) * 0.0011,
    }


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of interest laid out from the suppliers' keys."""
    named = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return named.withColumns(strip_place("id"))


PLACES_SQL = f"p AS (SELECT s_suppkey AS id, s_name AS name, {strip_sql('s_suppkey')} FROM supplier)"

NEAR_SQL = (
    "sqrt(0.58e0 * (p.longitude - r.longitude) * (p.longitude - r.longitude)"
    " + (p.latitude - r.latitude) * (p.latitude - r.latitude)) < 0.0045e0"
)

_RADIUS_SQL = f"""
    WITH {PLACES_SQL}, r AS (SELECT c_custkey AS reading, {strip_sql('c_custkey')} FROM customer)
    SELECT p.id AS point_id, r.reading AS reading FROM p JOIN r ON {NEAR_SQL}
"""


def _radius_pairs(spark: SparkSession, sf_dir: str, salts: int) -> DataFrame:
    readings = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("reading"))
    near = radius.radius_join(
        places(spark, sf_dir), readings.withColumns(strip_place("reading")), salts=salts
    )
    return near.select("point_id", "reading")


@query("J7", _RADIUS_SQL)
def join_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading beside the points within about 500 m, by grid cells."""
    return _radius_pairs(spark, sf_dir, salts=1)


@query("J7 J10", _RADIUS_SQL)
def join_radius_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with each cell's readings spread over four tasks."""
    return _radius_pairs(spark, sf_dir, salts=4)


@query("J11", """
    SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey * 2 = n_nationkey
""")
def join_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name per key from a small dimension that lacks half of the keys asked for."""
    asked = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") * 2).alias("asked"))
    nations = table(spark, sf_dir, "nation")
    return joins.lookup(asked, "asked", nations, "n_nationkey", "n_name", "nation").select("c_custkey", "nation")


@query("J14", """
    SELECT p_partkey AS id, count(*) AS lines, true AS same FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1
""")
def join_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text keys against double keys, both brought to one declared type."""
    text = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"))
    real = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("double").alias("id"))
    return joins.join_as(real, text, "id", "bigint").groupBy("id").agg(
        F.count(F.lit(1)).alias("lines"), F.lit(True).alias("same")
    )


@query("J8 PHY9", _BRAND_SQL)
def join_without_aqe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join planned with AQE and automatic broadcast off; the answer may not change."""
    with session_settings(
        spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"
    ):
        joined = _per_brand(_lines(spark, sf_dir).join(_parts(spark, sf_dir), "p_partkey"))
        path = fresh_path(spark, "brands")
        joined.write.parquet(path)
    return spark.read.parquet(path)
