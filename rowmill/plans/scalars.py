"""Queries over scalar functions, arrays and JSON columns (STR, DAT, MTH, ARR, JSN)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions import arrays, dates, numbers, text
from rowmill.functions import json as json_columns
from rowmill.registry import query, table


@query("STR1", "SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '*', 'g') AS masked FROM part")
def str_regex_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.regexp_replace("p_name", "[aeiou]", "*").alias("masked"))


@query("STR2", """
    SELECT s_suppkey, CAST('-3.7' || CAST(s_suppkey AS VARCHAR) AS DOUBLE) AS longitude,
           CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE CAST('40.' || CAST(s_suppkey AS VARCHAR) AS DOUBLE) END AS latitude
    FROM supplier
""")
def str_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``-3.7.12`` and ``4.0.12`` become -3.712 and 40.12; text without digits becomes NULL."""
    key = F.col("s_suppkey").cast("string")
    longitude = F.concat(F.lit("-3.7."), key)
    latitude = F.when(F.col("s_nationkey") % 4 == 0, F.lit("no.where")).otherwise(F.concat(F.lit("4.0."), key))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", text.repair_coordinate(longitude).alias("longitude"),
        text.repair_coordinate(latitude).alias("latitude"),
    )


@query("STR3", """
    SELECT c_custkey, c_name || '@' || c_mktsegment AS joined, concat_ws('/', nullif(c_mktsegment, 'BUILDING'), c_name) AS path
    FROM customer
""")
def str_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``concat_ws`` skips NULLs where ``concat`` would return one."""
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("@"), "c_mktsegment").alias("joined"),
        F.concat_ws("/", segment, F.col("c_name")).alias("path"),
    )


@query("STR4", """
    WITH e AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_returnflag, 'R') AS a, l_linestatus AS b FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN a < b THEN concat_ws('-', a, b) ELSE concat_ws('-', b, a) END AS pair FROM e
""")
def str_pair_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        text.pair_key(F.nullif("l_returnflag", F.lit("R")), F.col("l_linestatus")).alias("pair"),
    )


@query("STR5", """
    SELECT p_partkey, substr(p_name, 1, 3) AS head, instr(p_name, 'r') AS r_at, length(p_name) AS size, upper(p_name) AS loud FROM part
""")
def str_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.substring("p_name", 1, 3).alias("head"), F.instr("p_name", "r").alias("r_at"),
        F.length("p_name").alias("size"), F.upper("p_name").alias("loud"),
    )


@query("STR6 ARR1", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def str_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return arrays.explode_rows(named, "words", "word").drop("words")


@query("DAT1 DAT3", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders
""")
def dat_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``MM-dd-yyyy`` text to a date; other text to NULL."""
    shown = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.date_format("o_orderdate", "MM-dd-yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_date(shown, "MM-dd-yyyy").alias("day"))


@query("DAT2", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def dat_parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        "event_id", dates.parse_timestamp(shown, "dd/MM/yyyy HH:mm:ss").cast("timestamp_ntz").alias("at")
    )


@query("DAT3", """
    SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour FROM events
""")
def dat_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"),
    )


@query("DAT4", "SELECT o_orderkey, true AS past, true AS stamped FROM orders")
def dat_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Now as a date and as a timestamp, compared with the orders' days."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.to_date("o_orderdate") < F.current_date()).alias("past"),
        (F.col("o_orderdate").cast("timestamp") < F.current_timestamp()).alias("stamped"),
    )


@query("DAT5", """
    SELECT event_id, strftime(ts, '%d/%m/%Y %H:%M') || ' UTC' AS shown FROM events
""")
def dat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted text with the zone's short name."""
    zoned = F.to_timestamp_ltz(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "events").select("event_id", F.date_format(zoned, "dd/MM/yyyy HH:mm z").alias("shown"))


@query("DAT6", """
    SELECT o_orderkey, TRY_CAST(format('2023-{:02d}-{:02d}', 1 + o_orderkey % 13, day(o_orderdate)) AS DATE) AS day FROM orders
""")
def dat_make(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates from parts; a thirteenth month or a 30 February is NULL."""
    made = dates.date_from_parts(F.lit(2023), 1 + F.col("o_orderkey") % 13, F.dayofmonth("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", made.alias("day"))


@query("DAT7", """
    WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, DATE '1998-06-15' AS b FROM orders)
    SELECT o_orderkey, round(abs((year(a) - year(b)) * 12 + month(a) - month(b)
           + CASE WHEN day(a) = day(b) OR (a = last_day(a) AND b = last_day(b)) THEN 0 ELSE (day(a) - day(b)) / 31e0 END), 6) AS months
    FROM d
""")
def dat_months_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = dates.month_gap(F.to_date("o_orderdate"), F.lit("1998-06-15").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(gap, 6).alias("months"))


@query("DAT8", """
    SELECT event_id, abs(hour(ts) - 23) AS straight, least(abs(hour(ts) - 23), 24 - abs(hour(ts) - 23)) AS around FROM events
""")
def dat_hour_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2024-01-15 23:10:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        "event_id", dates.hour_distance(F.col("ts"), now, wrap=False).alias("straight"),
        dates.hour_distance(F.col("ts"), now).alias("around"),
    )


@query("MTH1", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity AS unit,
           l_tax / nullif(l_discount, 0) * 100 AS tax_share, (l_extendedprice + l_quantity) * 2 - 1 AS mixed
    FROM lineitem
""")
def mth_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        numbers.ratio(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit"),
        numbers.percentage(F.col("l_tax"), F.col("l_discount")).alias("tax_share"),
        ((F.col("l_extendedprice") + F.col("l_quantity")) * 2 - 1).alias("mixed"),
    )


@query("MTH2", """
    SELECT p_partkey, sqrt(p_retailprice) AS root, p_size * p_size AS square, abs(p_size - 25) AS off,
           CAST(floor(p_retailprice) AS BIGINT) AS whole, p_partkey % 7 AS remainder, true AS random_in_range
    FROM part
""")
def mth_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    draw = F.rand(seed=1)
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.sqrt("p_retailprice").alias("root"), F.pow("p_size", F.lit(2)).cast("bigint").alias("square"),
        F.abs(F.col("p_size") - 25).alias("off"), F.floor("p_retailprice").alias("whole"),
        (F.col("p_partkey") % 7).alias("remainder"), ((draw >= 0) & (draw < 1)).alias("random_in_range"),
    )


@query("MTH3", """
    SELECT p_partkey, least(p_size, 20) AS low, greatest(p_size, 20) AS high, greatest(nullif(p_size, 7), 3) AS known FROM part
""")
def mth_least_greatest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both skip NULLs."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.least("p_size", F.lit(20)).alias("low"), F.greatest("p_size", F.lit(20)).alias("high"),
        F.greatest(F.nullif("p_size", F.lit(7)), F.lit(3)).alias("known"),
    )


def named_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's whitespace words."""
    return table(spark, sf_dir, "documents").select("doc_id", text.words(F.col("text")).alias("words"))


def words_and_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of each document, and a row -1 that has none."""
    none = spark.range(1).select(F.lit(-1).cast("bigint").alias("doc_id"), F.array().cast("array<string>").alias("words"))
    return named_words(spark, sf_dir).unionByName(none)


_WORDS_SQL = r"""
    d AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \t\n\r\f]+'), lambda x: x <> '') AS words FROM documents)
"""
_ALL_WORDS_SQL = f"{_WORDS_SQL.rstrip()}, a AS (SELECT doc_id, words FROM d UNION ALL SELECT -1, [])"


@query("ARR1", f"WITH {_ALL_WORDS_SQL}, e AS (SELECT doc_id, unnest(words) AS word FROM a) SELECT doc_id, count(*) AS words FROM e GROUP BY 1")
def arr_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without elements disappears."""
    exploded = arrays.explode_rows(words_and_none(spark, sf_dir), "words", "word")
    return exploded.groupBy("doc_id").agg(F.count(F.lit(1)).alias("words"))


@query("ARR1", f"""
    WITH {_ALL_WORDS_SQL}, e AS (SELECT doc_id, unnest(CASE WHEN coalesce(len(words), 0) = 0 THEN [NULL] ELSE words END) AS word FROM a)
    SELECT doc_id, count(word) AS words FROM e GROUP BY 1
""")
def arr_explode_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = arrays.explode_rows(words_and_none(spark, sf_dir), "words", "word", keep_empty=True)
    return exploded.groupBy("doc_id").agg(F.count("word").alias("words"))


@query("ARR2", f"""
    WITH {_WORDS_SQL}
    SELECT doc_id, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS characters FROM d
""")
def arr_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_words(spark, sf_dir).select("doc_id", arrays.total_length(F.col("words")).cast("bigint").alias("characters"))


@query("ARR3", f"WITH {_WORDS_SQL} SELECT doc_id, array_to_string(list_transform(words, lambda x: upper(replace(x, 'ß', 'ss'))), ' ') AS loud FROM d")
def arr_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sharp s has a two-letter upper form."""
    loud = F.array_join(arrays.upper_all(F.col("words")), " ")
    return named_words(spark, sf_dir).select("doc_id", loud.alias("loud"))


@query("ARR4", f"WITH {_WORDS_SQL} SELECT doc_id, len(list_filter(words, lambda x: instr(x, 'th') > 0)) AS with_th FROM d")
def arr_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_words(spark, sf_dir).select("doc_id", F.size(arrays.containing(F.col("words"), "th")).alias("with_th"))


@query("ARR5", f"WITH {_WORDS_SQL} SELECT doc_id, len(list_filter(words, lambda x: length(x) > 12)) > 0 AS has_long FROM d")
def arr_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_words(spark, sf_dir).select("doc_id", arrays.any_longer(F.col("words"), 12).alias("has_long"))


@query("JSN1", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events
""")
def jsn_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut-off JSON gives NULL, not a failure."""
    cut = F.when(F.col("event_type") == "error", F.substring("props", 1, 3)).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", json_columns.parse(cut, "k bigint")["k"].alias("k"))


@query("JSN2", """
    SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}' AS doc FROM events
""")
def jsn_serialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", json_columns.serialise("event_id", "event_type", "user_id").alias("doc")
    )


@query("JSN3 JSN1 JSN2", """
    SELECT CAST(user_id AS VARCHAR) AS "customerId", CAST(event_id AS VARCHAR) AS "eventId", event_id AS "eventOffset",
           'd' || n AS "deviceId", event_type AS status, CAST(json_extract(props, '$.k') AS BIGINT) + n AS temperature
    FROM events, (VALUES (1), (2)) v(n)
""")
def jsn_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested device events built as JSON bytes, then decoded to one row per device."""
    k = json_columns.parse(F.col("props"), "k bigint")["k"]

    def device(n: int):
        return F.struct(
            F.lit(f"d{n}").alias("deviceId"), F.lit("C").alias("measure"),
            F.col("event_type").alias("status"), (k + n).alias("temperature"),
        )

    body = F.struct(
        F.col("user_id").cast("string").alias("customerId"),
        F.struct(F.array(device(1), device(2)).alias("devices")).alias("data"),
        F.col("event_id").cast("string").alias("eventId"), F.col("event_id").alias("eventOffset"),
    )
    messages = table(spark, sf_dir, "events").select(F.to_json(body).cast("binary").alias("value"))
    return json_columns.device_rows(messages).select(
        "customerId", "eventId", "eventOffset", "deviceId", "status", "temperature"
    )
