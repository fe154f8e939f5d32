"""Queries over sources (SRC1-SRC21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill import schemas
from rowmill.apps import city
from rowmill.functions import json as json_columns
from rowmill.operators.layout import small_pandas
from rowmill.registry import query, table
from rowmill.session import fresh_path
from rowmill.sinks.files import write_files, write_partitioned
from rowmill.sources import files, nested


@query("SRC1", """
    WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) lo, max(CAST(o_orderdate AS DATE)) hi FROM orders),
    d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
    SELECT d.day AS day, count(o_orderkey) AS orders
    FROM d LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d.day GROUP BY d.day
""")
def src_range_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated range of days, so that days without orders show up too."""
    days = table(spark, sf_dir, "orders").select(F.unix_date(F.to_date("o_orderdate")).alias("d"))
    low, high = days.agg(F.min("d"), F.max("d")).first()
    per_day = days.groupBy("d").agg(F.count(F.lit(1)).alias("orders"))
    calendar = spark.range(low, high + 1).select(F.col("id").cast("int").alias("d"))
    return calendar.join(per_day, "d", "left").select(
        F.date_from_unix_date("d").alias("day"), F.coalesce("orders", F.lit(0)).alias("orders")
    )


@query("SRC2", """
    SELECT coalesce(w.weight, -1) AS weight, count(*) AS orders
    FROM orders LEFT JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3)) w(priority, weight)
      ON o_orderpriority = w.priority
    GROUP BY coalesce(w.weight, -1)
""")
def src_literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written in the program, and an empty table of the same schema, against the orders."""
    ddl = "priority string, weight bigint"
    rows = spark.createDataFrame([("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3)], ddl)
    weights = rows.unionByName(spark.createDataFrame([], ddl))
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(weights, F.col("o_orderpriority") == F.col("priority"), "left")
    return joined.groupBy(F.coalesce("weight", F.lit(-1)).alias("weight")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@query("SRC3", "SELECT c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY 1")
def src_rows_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An RDD of tuples turned into a table by column names, for callers that hold an RDD: one row per group, since
    every row of an RDD goes through Python."""
    counted = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)))
    return counted.rdd.map(tuple).toDF("segment string, customers bigint")


@query("SRC4", """
    WITH p AS (SELECT o_orderpriority, count(*) AS orders_of_priority FROM orders GROUP BY 1)
    SELECT o_orderstatus AS status, sum(orders_of_priority) AS weight
    FROM orders JOIN p USING (o_orderpriority) GROUP BY 1
""")
def src_pandas_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pandas frame of one row per priority, joined back to the table it describes."""
    orders = table(spark, sf_dir, "orders")
    per_priority = small_pandas(orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")), 1000)
    weights = spark.createDataFrame(per_priority, "o_orderpriority string, orders_of_priority bigint")
    return orders.join(weights, "o_orderpriority").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.sum("orders_of_priority").alias("weight")
    )


@query("SRC5 SNK1", """
    SELECT c_custkey AS id, c_name AS name,
           CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS balance
    FROM customer
""")
def src_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semicolon text with dirty numbers, read as text and cast without failing the job."""
    path = fresh_path(spark, "customer-csv")
    dirty = F.when(F.col("c_custkey") % 11 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    write_files(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", dirty.alias("balance")),
        path, "csv", "overwrite", header=True, sep=";",
    )
    raw = files.read_delimited(spark, path, "id bigint, name string, balance string", sep=";")
    return raw.withColumn("balance", F.col("balance").try_cast("double"))


@query("SRC6", """
    SELECT p_brand AS brand, CAST(sum(p_size) AS BIGINT) AS total_size, max(p_retailprice) AS top_price
    FROM part GROUP BY 1
""")
def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "part-csv")
    write_files(table(spark, sf_dir, "part"), path, "csv", "overwrite", header=True)
    parts = files.read_delimited(spark, path, infer=True)
    return parts.groupBy(F.col("p_brand").alias("brand")).agg(
        F.sum("p_size").alias("total_size"), F.max("p_retailprice").alias("top_price")
    )


@query("SRC7", "SELECT s_suppkey AS id, 'Señal ' || s_name AS name, s_acctbal AS balance FROM supplier")
def src_csv_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited text in ISO-8859-1, landed as a file and read with its encoding."""
    path = fresh_path(spark, "supplier-latin1")
    named = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit("Señal "), "s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    write_files(named, path, "csv", "overwrite", header=True, sep=";", encoding="ISO-8859-1")
    return files.read_delimited(
        spark, path, "id bigint, name string, balance double", sep=";", encoding="ISO-8859-1"
    )


@query("SRC8 SRC10 SNK3", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def src_json_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines written with all fields and read with a schema of three."""
    path = fresh_path(spark, "orders-json")
    write_files(table(spark, sf_dir, "orders"), path, "json", "errorifexists")
    return files.read_json_lines(
        spark, path, "o_orderkey bigint, o_totalprice double, o_orderpriority string"
    )


@query("SRC10 ARR1 PRJ11", """
    SELECT l_orderkey, l_linenumber, l_partkey, n AS item, l_quantity * n AS amount FROM lineitem, (VALUES (1), (2)) v(n)
""")
def src_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an array of structs, read with some of the nested fields, one row per element."""
    path = fresh_path(spark, "nested-json")
    items = F.array(*[
        F.struct(F.lit(n).alias("item"), F.lit("x").alias("note"), (F.col("l_quantity") * n).alias("amount")) for n in (1, 2)
    ])
    table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", items.alias("items")
    ).write.json(path)
    ddl = "l_orderkey bigint, l_linenumber int, l_partkey bigint, items array<struct<item: int, amount: double>>"
    documents = files.read_json_lines(spark, path, ddl)
    return documents.withColumn("i", F.explode("items")).select("l_orderkey", "l_linenumber", "l_partkey", "i.*")


CHUNK = 1000  # rows of one multi-line document: documents stay this small at any table size


def _documents(rows: DataFrame, key: str, envelope: dict) -> DataFrame:
    """Rows packed as envelope documents of at most CHUNK neighbouring keys each."""
    item = F.struct(*[c for c in rows.columns])
    packed = rows.groupBy(F.floor(F.col(key) / CHUNK).alias("chunk")).agg(F.collect_list(item).alias("data"))
    return packed.select("chunk", F.struct(*[v.alias(n) for n, v in envelope.items()], "data").alias("reply"))


def _write_documents(documents: DataFrame, path: str) -> None:
    """One pretty-printed document per file, as the feeds' replies are stored."""
    pretty = documents.select("chunk", F.to_json("reply", {"pretty": "true"}).alias("value"))
    pretty.write.mode("overwrite").partitionBy("chunk").text(path)


@query("SRC9 SRC18", """
    SELECT s_suppkey AS id, s_name AS name, TIMESTAMP '2024-05-01 10:20:30' AS read_at,
           -3.7e0 + s_nationkey * 1e-3 AS longitude, 40.4e0 + s_nationkey * 1e-3 AS latitude
    FROM supplier
""")
def src_json_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-line replies: the envelope's time on every row, coordinates out of an array."""
    place = F.array(F.lit(-3.7) + F.col("s_nationkey") * 0.001, F.lit(40.4) + F.col("s_nationkey") * 0.001)
    stations = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name"),
        F.struct(place.alias("coordinates")).alias("geometry"),
    )
    path = fresh_path(spark, "stations-json")
    _write_documents(_documents(stations, "id", {"datetime": F.lit("2024-05-01 10:20:30")}), path)
    replies = files.read_json_documents(spark, path, schemas.BIKES_REPLY)
    return city.bike_messages(replies).select(
        F.col("id").cast("bigint").alias("id"), "name",
        F.col("datetime").cast("timestamp_ntz").alias("read_at"), "longitude", "latitude",
    )


@query("SRC11 JSN1", """
    SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total,
           count(*) AS events
    FROM events GROUP BY 1
""")
def src_json_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema of a JSON text column found from all its rows, then applied."""
    events = table(spark, sf_dir, "events")
    ddl = json_columns.discover_ddl(events, "props")
    return events.withColumn("p", json_columns.parse(F.col("props"), ddl)).groupBy("event_type").agg(
        F.sum("p.k").alias("k_total"), F.count(F.lit(1)).alias("events")
    )


@query("SRC12", r"""
    WITH l AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)
    SELECT length(value) AS characters, count(*) AS lines FROM l GROUP BY 1
""")
def src_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts written and read back line by line."""
    path = fresh_path(spark, "documents-text")
    table(spark, sf_dir, "documents").select("text").write.mode("overwrite").text(path)
    return files.read_lines(spark, path).groupBy(F.length("value").cast("bigint").alias("characters")).agg(
        F.count(F.lit(1)).alias("lines")
    )


@query("SRC13", """
    SELECT o_orderpriority AS priority, count(*) AS orders FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1
""")
def src_parquet_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range on the raw column reaches the scan; two of six columns are read."""
    date = F.col("o_orderdate")
    low, high = (F.lit(f"{year}-01-01").cast("timestamp_ntz") for year in (1997, 1998))
    return table(spark, sf_dir, "orders").where((date >= low) & (date < high)).groupBy(
        F.col("o_orderpriority").alias("priority")
    ).agg(F.count(F.lit(1)).alias("orders"))


@query("SRC14 PHY11", "SELECT c_nationkey AS nation, count(*) AS customers, true AS listed FROM customer GROUP BY 1")
def src_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame saved as an external table, listed in the catalog and scanned by its name."""
    path = fresh_path(spark, "customer-table")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    table(spark, sf_dir, "customer").write.format("parquet").option("path", path).saveAsTable(name)
    listed = not spark.sql(f"SHOW TABLES LIKE '{name}'").isEmpty()
    return spark.table(name).groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("customers")
    ).withColumn("listed", F.lit(listed))


@query("SRC15", "SELECT c_custkey AS id, c_acctbal AS balance FROM customer")
def src_part_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One part file opened by its path, united with the rest of its directory."""
    path = fresh_path(spark, "customer-parts")
    ddl = "id bigint, balance double"
    table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").repartition(4).write.csv(path)
    whole = files.read_delimited(spark, path, ddl, header=False)
    first = files.first_part_file(whole)
    rest = whole.where(F.col("_metadata.file_name") != first.rpartition("/")[2])
    return files.read_delimited(spark, first, ddl, header=False).unionByName(rest)


@query("SRC16", "SELECT c_mktsegment AS segment, 0 AS before, count(*) AS after FROM customer GROUP BY 1")
def src_read_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that does not exist yet is empty; after the first write it is read."""
    path, ddl = fresh_path(spark, "customers"), "c_custkey bigint, c_mktsegment string"
    before = files.read_or_empty(spark, path, ddl).count()
    table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").write.parquet(path)
    return files.read_or_empty(spark, path, ddl).groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.lit(before).alias("before"), F.count(F.lit(1)).alias("after")
    )


@query("SRC17", """
    SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS load,
           p_retailprice AS intensity
    FROM part
""")
def src_xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor XML whose records sometimes lack a child element."""
    path = fresh_path(spark, "sensors-xml")
    records = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("idelem"), F.col("p_retailprice").alias("intensidad"),
        F.lit(0).alias("ocupacion"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_size")).alias("carga"),
    )
    write_files(records, path, "xml", "overwrite", rowTag="pm", rootTag="pms")
    readings = city.traffic_messages(nested.read_xml_records(spark, path, "pm", schemas.TRAFFIC_XML))
    return readings.select(
        "id", F.col("load").try_cast("bigint").alias("load"), F.col("intensity").try_cast("double").alias("intensity")
    )


@query("SRC19", r"""
    WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a(\s[^>]*)>', 1)) AS tag FROM pages)
    SELECT page_id, regexp_extract(tag, '(?is)\shref\s*=\s*"([^"]*)"', 1) AS href
    FROM a WHERE regexp_matches(tag, '(?is)\shref\s*=')
""")
def src_html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.html_links(table(spark, sf_dir, "pages"), "page_id")


@query("SRC19", r"""
    WITH a AS (SELECT page_id, unnest(string_split_regex(html, '(?i)<a\s')[2:]) AS rest FROM pages WHERE page_id % 2 = 0)
    SELECT page_id, split_part(split_part(rest, 'href="', 2), '"', 1) AS href FROM a WHERE contains(split_part(rest, '>', 1), 'href="')
""")
def src_html_class_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a class of two words, which the anchors of every second page are given; a comment holds one more."""
    css = F.when(F.col("page_id") % 2 == 0, "big  file-link csv").otherwise("file-link big csv")
    marked = F.regexp_replace("html", F.lit(r"(?i)<a\s"), F.concat(F.lit('<a title="a > b" class="'), css, F.lit('" ')))
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit('<!-- <a class="file-link csv" href="/no">x</a> -->'), marked).alias("html")
    )
    return nested.html_links(pages, "page_id", css_class="file-link csv")


@query("SRC20", """
    SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS total FROM part
""")
def src_attribute_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The integer under "Total" in an array of name/content pairs; "unknown" gives NULL."""
    total = F.when(F.col("p_partkey") % 5 == 0, F.lit("unknown")).otherwise(F.col("p_size").cast("string"))
    pairs = F.array(
        F.struct(F.lit("Type").alias("name"), F.col("p_type").alias("content")),
        F.struct(F.lit("Total").alias("name"), total.alias("content")),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), nested.named_value(pairs, "Total", "bigint").alias("total")
    )


@query("SRC21", """
    SELECT p_type AS category, -3.7e0 + p_size * 1e-3 AS longitude, p_partkey AS id, p_name AS name
    FROM part WHERE p_brand = 'Brand#2'
""")
def src_pick_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with one list per brand; the rows of one brand's lists."""
    point = F.struct(
        F.col("p_type").alias("category"),
        (F.lit(-3.7) + F.col("p_size") * 0.001).cast("string").alias("longitude"),
        F.lit("40.4").alias("latitude"), F.col("p_partkey").cast("string").alias("idPoi"),
        F.col("p_name").alias("name"),
    )
    reply = F.array(F.struct(F.col("p_brand").alias("sourceName"), F.array(point).alias("data")))
    replies = table(spark, sf_dir, "part").select(reply.alias("data"))
    return city.points_of_interest(replies, "Brand#2").select(
        "category", "longitude", F.col("id").cast("bigint").alias("id"), "name"
    )


@query("SRC13 PHY6", """
    SELECT month(o_orderdate) AS month, count(*) AS orders FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1
""")
def src_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicate on a directory column lists only that directory's files."""
    path = fresh_path(spark, "orders-by-year")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    write_partitioned(orders, path, ["year"])
    return spark.read.parquet(path).where(F.col("year") == 1996).groupBy("month").agg(
        F.count(F.lit(1)).alias("orders")
    )
