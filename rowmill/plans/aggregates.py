"""Queries over aggregation, word counts, sorts, sets and samples (AGG, ORD, SET, SMP)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.apps import word_count
from rowmill.functions.numbers import exact_mean, exact_sum
from rowmill.operators.groups import latest_rows
from rowmill.operators.numbering import bernoulli, global_row_numbers, split
from rowmill.registry import query, table
from rowmill.session import current_database, fresh_path
from rowmill.sources.files import fold_files
from rowmill.streaming.mobility import city_rollup, heat_weights


@query("AGG1", """
    SELECT user_id, count(1) AS ones, count(CASE WHEN event_type <> 'error' THEN value END) AS known,
           count(*) AS all_rows, count(*) AS plain
    FROM events GROUP BY 1
""")
def agg_count_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four ways to count; only the count of a column skips its NULLs."""
    events = table(spark, sf_dir, "events").withColumn(
        "known_value", F.when(F.col("event_type") != "error", F.col("value"))
    )
    return events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("ones"), F.count("known_value").alias("known"),
        F.count("*").alias("all_rows"), F.expr("count(1)").alias("plain"),
    )


@query("AGG2", """
    SELECT l_returnflag AS flag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem GROUP BY 1
    UNION ALL
    SELECT 'all', CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT)
    FROM lineitem
""")
def agg_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per group, with a cast, and over everything; the total reuses the group sums."""
    groups = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
    )
    total = groups.agg(F.lit("all").alias("flag"), F.sum("price").alias("price"), F.sum("quantity").alias("quantity"))
    return groups.unionByName(total).withColumn("price", F.col("price").cast("double"))


@query("AGG3", """
    SELECT l_shipdate AS day, CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_discount
    FROM lineitem GROUP BY 1
""")
def agg_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").alias("day")).agg(
        exact_mean(F.col("l_discount")).alias("mean_discount")
    )


@query("AGG4", """
    SELECT CAST(o_custkey AS VARCHAR) AS scope, max(o_totalprice) AS top FROM orders GROUP BY 1
    UNION ALL SELECT 'all', max(o_totalprice) FROM orders
""")
def agg_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maxima of a text column, compared as numbers."""
    text = table(spark, sf_dir, "orders").withColumn("price", F.col("o_totalprice").cast("string"))
    top = F.max(F.col("price").try_cast("double")).alias("top")
    groups = text.groupBy(F.col("o_custkey").cast("string").alias("scope")).agg(top)
    return groups.unionByName(text.agg(top).withColumn("scope", F.lit("all")))


@query("AGG5 AGG2 AGG3", """
    SELECT o_custkey AS customer, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price
    FROM orders GROUP BY 1
    HAVING CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) > 250000
""")
def agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("customer")).agg(
        F.count(F.lit(1)).alias("orders"), exact_mean(F.col("o_totalprice")).alias("mean_price")
    ).where(F.col("mean_price") > 250000)


@query("AGG6", """
    SELECT o_orderpriority AS priority, count(DISTINCT o_custkey) AS customers, true AS estimate_close
    FROM orders GROUP BY 1
""")
def agg_distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts, and whether the one-pass sketch is within 15 % of them.

    The two are aggregated apart: together, Spark would ship a sketch per distinct pair.
    """
    by_priority = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority"))
    exact = by_priority.agg(F.count_distinct("o_custkey").alias("customers"))
    counted = exact.join(by_priority.agg(F.approx_count_distinct("o_custkey", 0.03).alias("about")), "priority")
    close = F.abs(F.col("about") - F.col("customers")) <= F.col("customers") * 0.15
    return counted.select("priority", "customers", close.alias("estimate_close"))


@query("AGG7", """
    SELECT DISTINCT l_returnflag AS flag, l_linestatus AS status, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem
""")
def agg_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    return lines.distinct().dropDuplicates(["flag", "status", "quantity"])


@query("AGG8", """
    SELECT user_id, arg_max(event_type, event_id) AS last_type, arg_max(value, event_id) AS last_value FROM events GROUP BY 1
""")
def agg_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value by an explicit order: the greatest order per key first, then the rows that have it."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return latest_rows(events, ["user_id"], ["event_id"]).select(
        "user_id", F.col("event_type").alias("last_type"), F.col("value").alias("last_value")
    )


_PIVOT_SQL = """
    SELECT user_id, nullif(count(*) FILTER (event_type = 'click'), 0) AS click,
           nullif(count(*) FILTER (event_type = 'error'), 0) AS error,
           nullif(count(*) FILTER (event_type = 'purchase'), 0) AS purchase,
           nullif(count(*) FILTER (event_type = 'signup'), 0) AS signup,
           nullif(count(*) FILTER (event_type = 'view'), 0) AS view
    FROM events GROUP BY 1
"""


@query("AGG9", _PIVOT_SQL)
def agg_pivot_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivot values found by a first job (bounded by spark.sql.pivotMaxValues)."""
    return table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type").agg(F.count(F.lit(1)))


@query("AGG10", _PIVOT_SQL)
def agg_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivot values given: one job."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    return table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", kinds).agg(F.count(F.lit(1)))


@query("AGG11", """
    SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) AS urgent_total,
           count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent_orders
    FROM orders
""")
def agg_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A total under a condition as an aggregate, not as a side effect."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf_dir, "orders").agg(
        exact_sum(F.when(urgent, F.col("o_totalprice"))).alias("urgent_total"), F.count_if(urgent).alias("urgent_orders")
    )


@query("AGG12", """
    WITH g AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT count(*) AS groups, CAST(sum(n) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS BIGINT) AS pressing,
           CAST(sum(n) FILTER (o_orderstatus = 'F') AS BIGINT) AS finished FROM g
""")
def agg_of_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over counts, several conditions in one pass over the small grouped table."""
    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").count()
    pressing = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return counts.agg(
        F.count(F.lit(1)).alias("groups"), F.sum(F.when(pressing, F.col("count"))).alias("pressing"),
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("count"))).alias("finished"),
    )


@query("AGG13 MTH3", """
    SELECT least(l_returnflag, l_linestatus) AS first, greatest(l_returnflag, l_linestatus) AS second, count(*) AS lines
    FROM lineitem GROUP BY 1, 2
""")
def agg_unordered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, sf_dir, "lineitem").groupBy(
        F.least(flag, status).alias("first"), F.greatest(flag, status).alias("second")
    ).agg(F.count(F.lit(1)).alias("lines"))


@query("AGG14", """
    SELECT l_orderkey, l_linenumber, count(*) AS rows_of_key FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def agg_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("rows_of_key")
    ).where(F.col("rows_of_key") > 1)


def _latest_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.concat(F.lit("user "), "user_id").alias("name"), "event_id", "value"
    )
    return latest_rows(events, ["id"], ["event_id"])


_LATEST_SQL = """
    l AS (SELECT user_id AS id, 'user ' || user_id AS name, arg_max(value, event_id) AS value FROM events GROUP BY 1)
"""


@query("AGG15 AGG8", f"""
    WITH {_LATEST_SQL}
    SELECT CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_value, max(value) AS max_value,
           arg_max(name, (value, name)) AS max_name, min(value) AS min_value FROM l
""")
def agg_city_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for a dashboard from the latest value per key."""
    latest = _latest_values(spark, sf_dir)
    exact = latest.agg(exact_mean(F.col("value"))).scalar()
    return city_rollup(latest).withColumn("mean_value", exact)


@query("AGG15", f"WITH {_LATEST_SQL} SELECT id, value - (SELECT min(value) FROM l) AS weight FROM l")
def agg_heat_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heat_weights(_latest_values(spark, sf_dir)).select("id", "weight")


_WORDS_SQL = r"""
    w AS (SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents),
    c AS (SELECT word, count(*) AS counter FROM w WHERE word <> '' GROUP BY 1)
"""


@query("AGG16", f"WITH {_WORDS_SQL} SELECT word, counter FROM c")
def wc_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count.count_words(table(spark, sf_dir, "documents"), "text")


@query("AGG17 STR6 ARR1", """
    SELECT word, count(*) AS counter FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1
""")
def wc_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count.count_space_tokens(table(spark, sf_dir, "documents"), "text")


@query("SQL1 SQL2 SQL3 SQL4 ORD3 AGG16", f"WITH {_WORDS_SQL} SELECT word, counter FROM c ORDER BY counter DESC, word LIMIT 5")
def sql_external_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts stored as delimited text below a directory, declared as a table, queried by SQL."""
    path = fresh_path(spark, "word-counts")
    word_count.save_counts(word_count.count_words(table(spark, sf_dir, "documents"), "text"), f"{path}/run")
    database = path.rsplit("/", 1)[1].replace("-", "_")
    word_count.create_external_table(spark, database, "word_count", path, f"{path}-home")
    with current_database(spark, database):
        return word_count.top_words(spark, "word_count", 5)


@query("SQL1 SQL2 SQL3", f"WITH {_WORDS_SQL} SELECT word, counter FROM c")
def sql_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token survives the delimited table, whatever characters it holds."""
    path = fresh_path(spark, "word-table")
    word_count.save_counts(word_count.count_words(table(spark, sf_dir, "documents"), "text"), f"{path}/run")
    database = path.rsplit("/", 1)[1].replace("-", "_")
    return spark.table(word_count.create_external_table(spark, database, "word_count", path, f"{path}-home"))


@query("ORD1 WIN7", "SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS place FROM supplier")
def ord_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A global sort, with each row's place in it so that the order itself is checked."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    placed = global_row_numbers(supplier, [F.col("s_acctbal").desc(), F.col("s_suppkey").asc()], "place")
    return placed.orderBy("place").select("s_suppkey", "place")


@query("ORD1 ORD2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def ord_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    ).limit(10)


@query("ORD3", """
    SELECT l_partkey AS part, count(*) AS lines FROM lineitem GROUP BY 1 ORDER BY lines DESC, part LIMIT 20
""")
def ord_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 by count: each task keeps twenty rows, only those meet."""
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(F.count(F.lit(1)).alias("lines"))
    return counts.orderBy(F.desc("lines"), "part").limit(20)


@query("SET1", "SELECT o_orderstatus AS code, count(*) * 2 AS rows_seen FROM orders GROUP BY 1")
def set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional union keeps duplicates; names come from the left."""
    status = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("code"))
    other = status.withColumnRenamed("code", "status")
    return status.union(other).groupBy("code").agg(F.count(F.lit(1)).alias("rows_seen"))


@query("SET2", """
    SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier
""")
def set_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return customers.unionByName(suppliers)


@query("SET3", """
    SELECT c_custkey AS id, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier
""")
def set_union_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that one side lacks are NULL of the other side's type."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("SET4", """
    SELECT year(o_orderdate) AS csv_index, count(*) AS rows_read FROM orders GROUP BY 1
""")
def set_fold_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file set per year, folded in one scan; the year comes from the file's path."""
    path = fresh_path(spark, "versions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("version"))
    orders.write.partitionBy("version").options(sep=";", header=True).csv(path)
    sound, rejected = fold_files(spark, f"{path}/version=*", "id bigint, price double", ";", r"version=(\d+)")
    return sound.unionByName(rejected, allowMissingColumns=True).groupBy(F.col("csv_index").cast("bigint").alias("csv_index")).agg(
        F.count(F.lit(1)).alias("rows_read")
    )


_SHARE_SQL = "CAST(('0x' || substr(md5('{seed}|' || {key}), 1, 8)) AS BIGINT) / 4294967296e0"


@query("SMP1", f"SELECT c_custkey FROM customer WHERE {_SHARE_SQL.format(seed=7, key='c_custkey')} < 0.1")
def smp_bernoulli(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the customers, the same tenth in every run and layout."""
    return bernoulli(table(spark, sf_dir, "customer"), 0.1, ["c_custkey"], seed=7).select("c_custkey")


@query("SMP2", f"""
    WITH s AS (SELECT {_SHARE_SQL.format(seed=0, key='c_custkey')} AS share FROM customer)
    SELECT CASE WHEN share < 0.55 THEN 'train' ELSE 'test' END AS split, count(*) AS customers FROM s GROUP BY 1
""")
def smp_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = split(table(spark, sf_dir, "customer"), {"train": 0.55, "test": 0.45}, ["c_custkey"])
    return labelled.groupBy("split").agg(F.count(F.lit(1)).alias("customers"))
