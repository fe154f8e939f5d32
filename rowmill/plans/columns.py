"""Queries over projection, filters, NULL handling and validation (PRJ, FLT, NUL, DQ)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions import json as json_columns
from rowmill.functions.numbers import clamp_upper, exact_mean, ratio
from rowmill.operators import quality
from rowmill.operators.columns import flatten, suffixed
from rowmill.operators.groups import fill_with_group_mean
from rowmill.registry import query, table
from rowmill.session import fresh_path


@query("PRJ1 PRJ3", "SELECT c_custkey, c_name, c_acctbal * 2 AS doubled, c_nationkey + 1 AS next_nation FROM customer")
def prj_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by name, by attribute, as expressions and as SQL text."""
    customer = table(spark, sf_dir, "customer")
    chosen = customer.select(
        "c_custkey", customer.c_name, F.col("c_acctbal"), F.expr("c_nationkey + 1").alias("next_nation")
    )
    return chosen.selectExpr("c_custkey", "c_name", "c_acctbal * 2 AS doubled", "next_nation")


@query("PRJ2", """
    SELECT CAST(c_custkey AS VARCHAR) AS key_text, CAST(c_acctbal AS DOUBLE) AS balance,
           TRY_CAST(CASE WHEN c_nationkey % 2 = 0 THEN 'n' || c_nationkey ELSE CAST(c_nationkey AS VARCHAR) END AS INT) AS nation
    FROM customer
""")
def prj_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts with new names; text that is no number becomes NULL."""
    text = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("n"), "c_nationkey")).otherwise(
        F.col("c_nationkey").cast("string")
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("key_text"), F.col("c_acctbal").cast("double").alias("balance"),
        text.try_cast("int").alias("nation"),
    )


@query("PRJ4 PRJ5 PRJ6", """
    SELECT c_custkey, c_acctbal * 0.2e0 AS tax, 1 + c_nationkey AS shifted, 'ES' AS country, 1 AS one, true AS active
    FROM customer
""")
def prj_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
        .withColumn("tax", F.col("c_acctbal") * 0.2)
        .withColumn("shifted", 1 + F.col("c_nationkey"))
        .withColumns({"country": F.lit("ES"), "one": F.lit(1), "active": F.lit(True)})
        .drop("c_acctbal", "c_nationkey")
    )


@query("PRJ7 PRJ8 PRJ10", 'SELECT s_acctbal AS "account balance", s_suppkey AS id FROM supplier')
def prj_rename_drop_reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    renamed = supplier.withColumnsRenamed({"s_suppkey": "id", "s_acctbal": "account balance"})
    return renamed.drop("s_name").drop(renamed["s_nationkey"]).select("account balance", "id")


@query("PRJ9 PRJ8", """
    SELECT a.s_suppkey AS s_suppkey_1, a.s_acctbal AS s_acctbal_1, b.s_name AS s_name_2
    FROM supplier a JOIN supplier b ON a.s_suppkey = b.s_suppkey
""")
def prj_suffix_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of a self-join on its unique key renamed by suffix."""
    supplier = table(spark, sf_dir, "supplier")
    one, two = suffixed(supplier, "_1"), suffixed(supplier, "_2")
    joined = one.join(two, one.s_suppkey_1 == two.s_suppkey_2)
    return joined.select("s_suppkey_1", "s_acctbal_1", "s_name_2")


def _event_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    body = F.struct(
        F.col("event_type").alias("kind"),
        F.struct(json_columns.parse(F.col("props"), "k bigint").alias("props"), "value").alias("detail"),
    )
    return events.select(F.col("event_id").alias("id"), body.alias("body"))


@query("PRJ11 JSN1", """
    SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value FROM events
""")
def prj_expand_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``a.b.*`` one level at a time."""
    return _event_structs(spark, sf_dir).select("id", "body.detail.*").select("id", "props.*", "value")


@query("PRJ12 JSN1", """
    SELECT event_id AS id, event_type AS body_kind, CAST(json_extract(props, '$.k') AS BIGINT) AS body_detail_props_k,
           value AS body_detail_value
    FROM events
""")
def prj_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(_event_structs(spark, sf_dir))


@query("FLT1", "SELECT o_orderkey, 3 AS forms FROM orders WHERE o_totalprice > 400000")
def flt_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One predicate as SQL text, as a column and through ``where``: Catalyst makes one plan."""
    orders = table(spark, sf_dir, "orders")
    forms = [
        orders.filter("o_totalprice > 400000"),
        orders.filter(F.col("o_totalprice") > 400000),
        orders.where(orders.o_totalprice > F.lit(400000)),
    ]
    united = forms[0].unionByName(forms[1]).unionByName(forms[2])
    return united.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("forms"))


@query("FLT2", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'")
def flt_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase").select("event_id", "user_id")


@query("FLT3", """
    SELECT 'known' AS part, count(*) AS parts FROM part WHERE nullif(p_size, 7) IS NOT NULL
    UNION ALL SELECT 'unknown', count(*) FROM part WHERE nullif(p_size, 7) IS NULL
""")
def flt_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.nullif("p_size", F.lit(7)).alias("size"))
    known = parts.where(F.col("size").isNotNull()).agg(F.lit("known").alias("part"), F.count(F.lit(1)).alias("parts"))
    unknown = parts.where(F.col("size").isNull()).agg(F.lit("unknown").alias("part"), F.count(F.lit(1)).alias("parts"))
    return known.unionByName(unknown)


@query("FLT4", """
    SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')
""")
def flt_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_orderstatus").isin("F", "O")
    ).select("o_orderkey")


@query("FLT5", """
    SELECT o_orderkey FROM orders WHERE month(o_orderdate) = 11 AND substr(o_orderpriority, 1, 1) = '1'
""")
def flt_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(
        (F.month("o_orderdate") == 11) & (F.substring("o_orderpriority", 1, 1) == "1")
    ).select("o_orderkey")


@query("NUL1", "SELECT p_partkey, p_size FROM part WHERE nullif(p_size, 7) IS NOT NULL AND nullif(p_type, 'SMALL') IS NOT NULL")
def nul_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = table(spark, sf_dir, "part").select(
        "p_partkey", F.nullif("p_size", F.lit(7)).alias("p_size"), F.nullif("p_type", F.lit("SMALL")).alias("p_type")
    )
    return holes.na.drop("any").drop("p_type")


@query("NUL2", "SELECT p_partkey, coalesce(nullif(p_type, 'SMALL'), 'O') AS p_type FROM part")
def nul_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = table(spark, sf_dir, "part").select("p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("p_type"))
    return holes.withColumn("p_type", F.coalesce("p_type", F.lit("O")))


@query("NUL3 WIN5", """
    WITH h AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS size FROM part),
    m AS (SELECT p_brand, CAST(sum(CAST(size AS DECIMAL(18,2))) AS DOUBLE) / count(size) AS mean FROM h GROUP BY 1)
    SELECT p_partkey, h.p_brand AS p_brand, coalesce(size, mean) AS size FROM h JOIN m ON h.p_brand = m.p_brand
""")
def nul_group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown sizes take the mean of their brand; no brand is gathered in one task."""
    holes = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", F.when(F.col("p_partkey") % 7 != 0, F.col("p_size").cast("double")).alias("size")
    )
    return fill_with_group_mean(holes, ["p_brand"], "size", exact_mean(F.col("size")))


@query("NUL4", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE 'none' END AS flag,
           CASE WHEN l_quantity > 25 THEN 'bulk' ELSE 'single' END AS size
    FROM lineitem
""")
def nul_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CASE as a column and as SQL text."""
    flag = F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_returnflag") == "A", "accepted").otherwise("none")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", flag.alias("flag"),
        F.expr("CASE WHEN l_quantity > 25 THEN 'bulk' ELSE 'single' END").alias("size"),
    )


@query("NUL5 MTH1", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_quantity / nullif(l_discount * 1000, 0) > 1 THEN 1.0e0
                ELSE l_quantity / nullif(l_discount * 1000, 0) END AS load
    FROM lineitem
""")
def nul_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ratio of at most 1; NULL where its divisor is zero."""
    load = clamp_upper(ratio(F.col("l_quantity"), F.col("l_discount") * 1000))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", load.alias("load"))


RULES = [
    {"field": "segment", "validations": ["notEmpty"]},
    {"field": "balance", "validations": ["notNull"]},
]

_DIRTY_SQL = """
    d AS (SELECT c_custkey AS id,
                 CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment,
                 CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS balance
          FROM customer),
    v AS (SELECT *, concat_ws(',',
              CASE WHEN coalesce(segment, '') = '' THEN 'notEmpty validation failed for segment' END,
              CASE WHEN balance IS NULL THEN 'notNull validation failed for balance' END) AS failed_validations
          FROM d)
"""


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.when(key % 5 == 0, "").when(key % 7 == 0, None).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(key % 3 != 0, F.col("c_acctbal")).alias("balance"),
    )


@query("DQ1", f"WITH {_DIRTY_SQL} SELECT id, segment, balance, failed_validations FROM v")
def dq_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound and rejected rows together again, the latter with their reasons."""
    ok, ko = quality.validate_fields(_dirty(spark, sf_dir), RULES)
    return ok.withColumn("failed_validations", F.lit("")).unionByName(ko)


@query("DQ2", f"WITH {_DIRTY_SQL} SELECT id, true AS stamped FROM v WHERE failed_validations = ''")
def dq_add_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = quality.validate_fields(_dirty(spark, sf_dir), RULES)
    stamped = quality.add_fields(ok, [{"name": "dt", "function": "current_timestamp"}])
    return stamped.select("id", F.col("dt").isNotNull().alias("stamped"))


@query("DQ3 SNK3 SRC8", f"""
    WITH {_DIRTY_SQL}
    SELECT id, segment, balance, failed_validations, failed_validations = '' AS stamped FROM v
""")
def dq_dataflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source, validation, stamping and two sinks from one metadata entry; the sinks read back."""
    inbox, accepted, rejected = (fresh_path(spark, n) for n in ("inbox", "accepted", "rejected"))
    _dirty(spark, sf_dir).write.json(inbox)
    quality.run_dataflow(spark, {
        "name": "customers",
        "sources": [{
            "name": "inputs", "path": f"{inbox}/*", "format": "JSON",
            "schema": "id bigint, segment string, balance double",
        }],
        "transformations": [
            {"name": "checked", "type": "validate_fields", "params": {"input": "inputs", "validations": RULES}},
            {"name": "stamped", "type": "add_fields",
             "params": {"input": "checked_ok", "addFields": [{"name": "dt", "function": "current_timestamp"}]}},
        ],
        "sinks": [
            {"input": "stamped", "format": "JSON", "saveMode": "OVERWRITE", "paths": [accepted]},
            {"input": "checked_ko", "format": "JSON", "saveMode": "OVERWRITE", "paths": [rejected]},
        ],
    })
    fields = "id bigint, segment string, balance double, failed_validations string, dt timestamp"
    stored = spark.read.schema(fields).json([accepted, rejected])
    return stored.select(
        "id", "segment", "balance", F.coalesce("failed_validations", F.lit("")).alias("failed_validations"),
        F.col("dt").isNotNull().alias("stamped"),
    )
