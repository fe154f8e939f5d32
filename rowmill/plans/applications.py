"""Queries over the worked applications (PIP1-PIP9) on feeds derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill import schemas
from rowmill.apps import bus_trips, city, city_streams, siblings, word_count
from rowmill.operators.groups import latest_rows
from rowmill.plans.joins import NEAR_SQL, PLACES_SQL, places
from rowmill.plans.streams import BIKES_SQL, NOW, PARKINGS_SQL, TRAFFIC_SQL, message_streams, parking_sites
from rowmill.registry import query, table
from rowmill.session import ensure_checkpoint_dir, fresh_path
from rowmill.sources import files, streams
from rowmill.streaming import run
from rowmill.streaming.mobility import city_rollup


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips, all text, laid out from the order lines: suppliers as bus lines, parts as stops."""
    line, part, quantity = F.col("l_suppkey"), F.col("l_partkey"), F.col("l_quantity")
    text = "string"
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", "special").otherwise("regular").alias("trip_type"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("trip_code"),
        F.concat(F.lit("company "), line % 3).alias("company"), line.cast(text).alias("line_number"),
        F.concat(F.lit("stop "), part % 5).alias("origin"), F.concat(F.lit("stop "), line % 4).alias("destination"),
        F.when(F.col("l_linestatus") == "F", "2019").otherwise("2020").alias("year"),
        F.dayofmonth("l_shipdate").cast(text).alias("day"),
        F.when(part % 9 != 0, F.sqrt(quantity).cast(text)).alias("trip_duration_hours"),
        F.when(part % 4 != 0, (quantity % 13).cast(text)).alias("delay_start_minutes"),
        F.when(part % 5 == 0, "n/a").otherwise((part % 17).cast(text)).alias("delay_end_minutes"),
        F.when(part % 7 != 0, (quantity * 10).cast(text)).alias("travelled_distance_km"),
    )


_TRIPS_SQL = """
    raw AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS trip_code, 'company ' || (l_suppkey % 3) AS company,
                   CAST(l_suppkey AS VARCHAR) AS line_number, l_returnflag,
                   'stop ' || (l_partkey % 5) AS origin, 'stop ' || (l_suppkey % 4) AS destination,
                   CASE WHEN l_linestatus = 'F' THEN 7 ELSE 8 END AS month, day(l_shipdate) AS day,
                   CASE WHEN l_partkey % 9 <> 0 THEN sqrt(l_quantity) END AS duration,
                   CASE WHEN l_partkey % 4 <> 0 THEN l_quantity % 13 ELSE 0 END
                   + CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE l_partkey % 17 END AS delay,
                   CASE WHEN l_partkey % 7 <> 0 THEN l_quantity * 10 END AS distance
            FROM lineitem WHERE l_returnflag <> 'A'),
    means AS (SELECT line_number, avg(duration) AS mean_duration, avg(distance) AS mean_distance FROM raw GROUP BY 1),
    trips AS (SELECT raw.*, coalesce(duration, mean_duration) AS hours, coalesce(distance, mean_distance) AS km,
                     make_date(2024, month, day) AS date FROM raw JOIN means USING (line_number))
"""


@query("PIP1 NUL2 NUL3 NUL4 DAT6 MTH1 FLT2 SNK8", f"""
    WITH {_TRIPS_SQL}
    SELECT trip_code, line_number, date, round(hours, 6) AS hours, round(km, 6) AS km, delay AS total_delay,
           round(delay / (hours * 60) * 100, 6) AS delay_percentage, month
    FROM trips
""")
def pip_bus_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleansed trips, stored partitioned by date and bucketed by line, and read back."""
    path = fresh_path(spark, "bus-trips")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    bus_trips.save_trips(bus_trips.clean_trips(_trips(spark, sf_dir)), name, path)
    return spark.table(name).select(
        "trip_code", "line_number", "date", F.round("trip_duration_hours", 6).alias("hours"),
        F.round("travelled_distance_km", 6).alias("km"), F.col("total_delay_minutes").alias("total_delay"),
        F.round("delay_percentage", 6).alias("delay_percentage"), "month",
    )


@query("PIP2 STR4 AGG7", f"""
    WITH {_TRIPS_SQL}
    SELECT DISTINCT company, line_number,
           CASE WHEN origin < destination THEN origin || '-' || destination ELSE destination || '-' || origin END AS line_key
    FROM raw
""")
def pip_bus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bus_trips.two_way_lines(_trips(spark, sf_dir))


@query("PIP3 WIN6 AGG3 SNK4", f"""
    WITH {_TRIPS_SQL},
    daily AS (SELECT date, line_number, avg(delay / (hours * 60) * 100) AS delay, avg(hours) AS hours FROM trips GROUP BY 1, 2)
    SELECT date, CAST(line_number AS INT) AS line_number, round(delay / nullif(avg(delay) OVER w, 0), 5) AS avg_delay_ratio,
           round(delay / nullif(max(delay) OVER w, 0), 5) AS max_delay_ratio, round(hours / avg(hours) OVER w, 5) AS avg_trip_duration_hours,
           round(hours / max(hours) OVER w, 5) AS max_trip_duration_hours
    FROM daily WINDOW w AS (PARTITION BY line_number ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def pip_bus_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ratios per line, stored by date and read back."""
    path = fresh_path(spark, "bus-ratios")
    ratios = bus_trips.daily_ratios(bus_trips.clean_trips(_trips(spark, sf_dir)))
    bus_trips.save_ratios(ratios, path)
    stored = spark.read.schema(ratios.schema).parquet(path)
    return stored.select(
        "date", F.col("line_number").cast("int").alias("line_number"),
        *[F.round(c, 5).alias(c) for c in stored.columns if c.endswith(("_ratio", "_hours"))],
    )


@query("PIP4 SRC5 FLT2 DAT2 DAT3 SNK4", """
    SELECT CAST(user_id AS VARCHAR) AS id, date_trunc('second', ts) AS datetime, day(ts) AS day, value AS intensity,
           CAST(NULL AS DOUBLE) AS load, 2024 AS year, 1 AS month
    FROM events WHERE event_type <> 'error'
""")
def pip_traffic_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text semicolon files to typed rows under year and month directories."""
    raw, target = fresh_path(spark, "history-raw"), fresh_path(spark, "history")
    table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("fecha"),
        F.lit("M30").alias("tipo_elem"), F.col("value").alias("intensidad"), F.lit(1).alias("ocupacion"),
        F.lit("n/a").alias("carga"), F.lit(0).alias("vmed"),
        F.when(F.col("event_type") == "error", "S").otherwise("N").alias("error"), F.lit(5).alias("periodo_integracion"),
    ).write.options(sep=";", header=True).csv(raw)
    history = city.traffic_history(files.read_delimited(spark, raw, schemas.TRAFFIC_HISTORY_RAW, sep=";"))
    city.save_traffic_history(history, target)
    stored = spark.read.schema(history.schema).parquet(target)
    return stored.select(
        "id", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "day", "intensity", "load", "year", "month"
    )


@query("PIP5 SET4 STR2 NUL1 WIN4 SNK13 J5", """
    SELECT c_custkey AS id, c_name || ' v2' AS name, CAST('-3.7' || c_custkey AS DOUBLE) AS longitude, 40.4 ::DOUBLE AS latitude,
           2 AS csv_index
    FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL
    SELECT c_custkey, c_name || ' v1', CAST('-3.7' || c_custkey AS DOUBLE), 40.4, 1 FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def pip_sensor_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a location file; the newer row wins, and a second run adds nothing."""
    path, target = fresh_path(spark, "locations"), fresh_path(spark, "registry")
    customers = table(spark, sf_dir, "customer")
    for version in (1, 2):
        usable = F.col("c_mktsegment") != "BUILDING" if version == 2 else F.lit(True)
        customers.select(
            F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(f" v{version}")).alias("nombre"),
            F.concat(F.lit("-3.7."), F.col("c_custkey").cast("string")).alias("longitud"),
            F.when(usable, "4.0.4").otherwise("sin datos").alias("latitud"),
        ).write.options(sep=";", header=True).csv(f"{path}/locations-{version}-csv")
    for _ in range(2):
        city.register_locations(spark, f"{path}/locations-*-csv", r"locations-(\d+)-csv", target)
    return spark.read.schema(schemas.TRAFFIC_LOCATIONS).parquet(target)


@query("PIP6 SRC18 SRC20 SNK13", """
    SELECT c_custkey AS id, 40.4e0 + c_nationkey AS latitude, -3.7e0 AS longitude, c_name AS name, 100 + c_nationkey AS total_slots
    FROM customer WHERE c_mktsegment <> 'BUILDING'
""")
def pip_parking_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites from the list reply with totals from the detail replies; unknown totals are left out."""
    customers = table(spark, sf_dir, "customer")
    place = F.array(F.lit("-3.7"), (F.lit(40.4) + F.col("c_nationkey")).cast("string"))
    site = F.struct(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"),
        F.struct(place.alias("coordinates")).alias("geometry"),
    )
    total = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise((F.col("c_nationkey") + 100).cast("string"))
    pair = F.struct(F.lit("Total").alias("name"), total.alias("content"))
    replies = customers.select(F.array(site).alias("data"))
    details = customers.select(
        F.col("c_custkey").cast("int").alias("id"), F.array(F.struct(F.array(pair).alias("features"))).alias("data")
    )
    target = fresh_path(spark, "parkings")
    sites = city.parking_sites(replies, details)
    for _ in range(2):
        city.register_parkings(sites, target)
    return spark.read.schema(schemas.PARKING_REGISTRY).parquet(target)


@query("PIP7 SRC21 SNK13", """
    SELECT p_type AS category, -3.7e0 AS longitude, 40.4e0 + p_size AS latitude, p_partkey AS id, p_name AS name
    FROM part WHERE p_brand = 'Brand#3'
""")
def pip_poi_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = F.struct(
        F.col("p_type").alias("category"), F.lit("-3.7").alias("longitude"),
        (F.lit(40.4) + F.col("p_size")).cast("string").alias("latitude"),
        F.col("p_partkey").cast("string").alias("idPoi"), F.col("p_name").alias("name"),
    )
    source = F.struct(F.col("p_brand").alias("sourceName"), F.array(point).alias("data"))
    replies = table(spark, sf_dir, "part").select(F.array(source).alias("data"))
    target = fresh_path(spark, "points")
    for _ in range(2):
        city.register_points(city.points_of_interest(replies, "Brand#3"), target)
    return spark.read.schema(schemas.POI_REGISTRY).parquet(target)


_SIBLINGS_SQL = """
    s AS (SELECT least(a.o_orderpriority, b.o_orderpriority) AS pair_title_1,
                 greatest(a.o_orderpriority, b.o_orderpriority) AS pair_title_2, count(*) AS count
          FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey
           AND greatest(CAST(a.o_orderdate AS DATE), CAST(b.o_orderdate AS DATE))
               < least(CAST(a.o_orderdate AS DATE), CAST(b.o_orderdate AS DATE)) + INTERVAL 2 YEAR
          GROUP BY 1, 2)
"""


def _order_siblings(spark: SparkSession, sf_dir: str, mirrored: bool = True) -> DataFrame:
    return siblings.sibling_title_pairs(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate", 2, mirrored
    )


@query("PIP8 J6 DAT7 AGG13", f"WITH {_SIBLINGS_SQL} SELECT * FROM s")
def pip_sibling_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one customer placed under two years apart, by priority pair."""
    return _order_siblings(spark, sf_dir)


@query("PIP8 J6", f"WITH {_SIBLINGS_SQL.replace('a.o_orderkey <> b.o_orderkey', 'a.o_orderkey < b.o_orderkey')} SELECT * FROM s")
def pip_sibling_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with each pair of orders counted once."""
    return _order_siblings(spark, sf_dir, mirrored=False)


@query("PIP8 AGG12 PHY7 PHY8", f"""
    WITH {_SIBLINGS_SQL}
    SELECT count(*) AS title_pairs,
           CAST(coalesce(sum(count) FILTER (pair_title_1 IN ('1-URGENT', '2-HIGH') AND pair_title_2 IN ('1-URGENT', '2-HIGH')), 0) AS BIGINT) AS among_titles,
           CAST(coalesce(sum(count) FILTER (pair_title_1 = pair_title_2), 0) AS BIGINT) AS same_title,
           CAST(coalesce(sum(count) FILTER (substr(pair_title_1, 1, 1) = '3'), 0) AS BIGINT) AS with_initial
    FROM s
""")
def pip_sibling_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four totals over the pair counts, which are checkpointed once and small."""
    ensure_checkpoint_dir(spark)
    kept = _order_siblings(spark, sf_dir).checkpoint()
    return siblings.title_summaries(kept, ["1-URGENT", "2-HIGH"], "3")


@query("PIP9 PIP4 PIP5 PIP6 PIP7 ST21 ST22 ST23 ST24 AGG15", f"""
    WITH {PLACES_SQL}, {BIKES_SQL}, {PARKINGS_SQL}, {TRAFFIC_SQL},
    r AS (SELECT * FROM bikes UNION ALL SELECT * FROM parkings UNION ALL SELECT * FROM traffic),
    f AS (SELECT p.id AS id, p.name AS name, avg(occupancy) * 100 AS value FROM p JOIN r ON {NEAR_SQL} GROUP BY 1, 2)
    SELECT round(avg(value), 4) AS mean_value, round(max(value), 4) AS max_value, arg_max(name, value) AS max_name,
           round(min(value), 4) AS min_value FROM f
""")
def pip_city_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registries and history are ingested, three stages turn messages into topics (kept as files),
    a fourth fuses the topics, and the newest value per point becomes the dashboard's one row.
    """
    path = fresh_path(spark, "city")
    _ingest_registries(spark, sf_dir, path)
    sites = spark.read.schema(schemas.PARKING_REGISTRY).parquet(f"{path}/parkings")
    sensors = spark.read.schema(schemas.TRAFFIC_LOCATIONS).parquet(f"{path}/sensors")
    hourly = spark.read.parquet(f"{path}/maxima")
    points = spark.read.schema(schemas.POI_REGISTRY).parquet(f"{path}/points")

    bikes, parkings, traffic = message_streams(spark, sf_dir)
    stages = {
        "bikes": city_streams.bikes_stage(bikes),
        "parking": city_streams.parking_stage(parkings, sites),
        "traffic": city_streams.traffic_stage(traffic, sensors, hourly, F.lit(NOW).cast("timestamp_ntz")),
    }
    topics = []
    for stage, rows in stages.items():
        run.to_files(rows, f"{path}/{stage}", f"{path}/{stage}-checkpoint")
        topics.append(streams.file_stream(spark, f"{path}/{stage}", "parquet", "key string, value string"))
    sent = run.batch_files(f"{path}/fusion")
    writer = city_streams.fusion_writer(
        points, topics, f"{path}/places", [lambda rows, batch_id: sent(city_streams.fusion_rows(rows), batch_id)]
    )
    run.complete(spark, writer, f"{path}/fusion-checkpoint")
    written = spark.read.schema("value string, batch_id long").parquet(f"{path}/fusion")

    value = "id bigint, name string, occupancy double"
    sent = written.select("batch_id", F.from_json("value", value).alias("m")).select("batch_id", "m.*")
    latest = latest_rows(sent, ["id"], ["batch_id"]).withColumn("value", F.col("occupancy") * 100)
    return city_rollup(latest).select(
        F.round("mean_value", 4).alias("mean_value"), F.round("max_value", 4).alias("max_value"), "max_name",
        F.round("min_value", 4).alias("min_value"),
    )


def _ingest_registries(spark: SparkSession, sf_dir: str, path: str) -> None:
    """PIP4 to PIP7 on replies and files laid out from the given tables; sensors stand where the parkings are."""
    sites = parking_sites(spark, sf_dir)
    place = F.array(F.col("longitude").cast("string"), F.col("latitude").cast("string"))
    site = F.struct(F.col("id").cast("int").alias("id"), "name", F.struct(place.alias("coordinates")).alias("geometry"))
    pair = F.struct(F.lit("Total").alias("name"), F.col("total_slots").cast("string").alias("content"))
    details = sites.select(F.col("id").cast("int").alias("id"), F.array(F.struct(F.array(pair).alias("features"))).alias("data"))
    city.register_parkings(city.parking_sites(sites.select(F.array(site).alias("data")), details), f"{path}/parkings")
    sites.select(
        "id", F.col("name").alias("nombre"), F.col("longitude").cast("string").alias("longitud"),
        F.col("latitude").cast("string").alias("latitud"),
    ).write.options(sep=";", header=True).csv(f"{path}/locations-1-csv")
    city.register_locations(spark, f"{path}/locations-*-csv", r"locations-(\d+)-csv", f"{path}/sensors")
    point = F.struct(
        F.lit("site").alias("category"), F.col("longitude").cast("string").alias("longitude"),
        F.col("latitude").cast("string").alias("latitude"), F.col("id").cast("string").alias("idPoi"), "name",
    )
    lists = F.array(F.struct(F.lit("sites").alias("sourceName"), F.array(point).alias("data")))
    replies = places(spark, sf_dir).select(lists.alias("data"))
    city.register_points(city.points_of_interest(replies, "sites"), f"{path}/points")
    raw = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("fecha"),
        F.col("value").cast("string").alias("intensidad"), F.lit("0").alias("ocupacion"), F.lit("0").alias("carga"),
        F.lit("N").alias("error"),
    )
    city.save_traffic_history(city.traffic_history(raw), f"{path}/history")
    city.save_hourly_maxima(spark.read.parquet(f"{path}/history"), f"{path}/maxima")


@query("AGG16 SNK1 SRC12 SQL4", r"""
    WITH w AS (SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM conversations)
    SELECT word, count(*) AS counter FROM w WHERE word <> '' GROUP BY 1
""")
def pip_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files to words, counted, stored as delimited text and read back."""
    lines, counted = fresh_path(spark, "lines"), fresh_path(spark, "counts")
    table(spark, sf_dir, "conversations").select("text").write.text(lines)
    word_count.save_counts(word_count.count_words(files.read_lines(spark, lines)), counted)
    return word_count.read_counts(spark, counted)
