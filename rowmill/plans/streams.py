"""Queries over streams (ST1-ST25, J12, J13): each runs to the end of what is there, then stops.

A given table is read as a file stream in one batch, so that results compare with plain SQL;
results are stored as files under the shared folder, never held by the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill import schemas
from rowmill.functions import json as json_columns
from rowmill.functions.numbers import exact_sum
from rowmill.operators.joins import join_small
from rowmill.plans.joins import NEAR_SQL, PLACES_SQL, places, strip_place, strip_sql
from rowmill.registry import query, table
from rowmill.session import fresh_path, session_settings
from rowmill.sinks.topics import topic_rows
from rowmill.sources import streams as sources
from rowmill.streaming import mobility, run
from rowmill.streaming.events import decode, windowed_counts, word_events
from rowmill.streaming.places import fuse_by_place, fuse_windows_by_place


def _stored(stream: DataFrame, label: str) -> DataFrame:
    """An append-mode stream as files, read back."""
    path = fresh_path(stream.sparkSession, label)
    run.to_files(stream, path, f"{path}-checkpoint")
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = sources.table_stream(spark, sf_dir, "events")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})


_WINDOWS_SQL = """
    s AS (SELECT ts, event_type, epoch_us(ts) // 300000000 * 300000000 AS slot FROM events),
    w AS (SELECT make_timestamp(slot - n * 300000000) AS start_time, make_timestamp(slot - n * 300000000 + 600000000) AS end_time, event_type
          FROM s, (VALUES (0), (1)) v(n)),
    c AS (SELECT start_time, end_time, event_type, count(*) AS count FROM w GROUP BY 1, 2, 3)
"""


@query("ST6 ST7 ST8 ST13", f"WITH {_WINDOWS_SQL} SELECT start_time, end_time, event_type, count FROM c")
def st_window_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding-window counts; each batch stores the whole result, the last one is read."""
    path = fresh_path(spark, "windows-complete")
    counts = windowed_counts(_event_stream(spark, sf_dir), "ts", "event_type")
    written = run.to_batch_dirs(counts, path, f"{path}-checkpoint", "complete")
    return _plain_times(run.newest_batch(written))


@query("ST6 ST7 ST9 ST13", f"WITH {_WINDOWS_SQL} SELECT start_time, end_time, event_type, count FROM c")
def st_window_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, storing only changed rows; the newest version of each is kept."""
    path = fresh_path(spark, "windows-update")
    counts = windowed_counts(_event_stream(spark, sf_dir), "ts", "event_type")
    written = run.to_batch_dirs(counts, path, f"{path}-checkpoint", "update")
    return _plain_times(run.newest_version(written, ["start_time", "end_time", "event_type"]))


@query("ST6 ST7 ST10 ST13 ST16", f"""
    WITH {_WINDOWS_SQL} SELECT start_time, end_time, event_type, count FROM c
    WHERE end_time <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
""")
def st_window_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, storing each window once the watermark has passed its end."""
    counts = windowed_counts(_event_stream(spark, sf_dir), "ts", "event_type")
    return _plain_times(_stored(counts, "windows-append"))


@query("ST11 ST6 ST9", f"""
    WITH {_WINDOWS_SQL}, m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events)
    SELECT start_time, end_time, event_type, count * CASE WHEN end_time > mark THEN 3 ELSE 2 END AS count FROM c, m
""")
def st_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events arrive three times, one batch each.

    The watermark the first batch sets closes windows at the end of the second and turns rows
    away from the third on, where only windows still open count.
    """
    path = fresh_path(spark, "late")
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    stream = sources.file_stream(spark, f"{path}/turn=*", "parquet", "ts timestamp_ntz, event_type string").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )
    counts = windowed_counts(stream, "ts", "event_type")
    # A turn is one batch however many files it has: the query is started again on its checkpoint for each.
    # Batches without rows, which would close windows between two turns, are left out.
    with session_settings(spark, spark__sql__streaming__noDataMicroBatches__enabled="false"):
        for turn in ("1st", "2nd", "3rd"):
            events.write.parquet(f"{path}/turn={turn}")
            written = run.to_batch_dirs(counts, f"{path}-out", f"{path}-checkpoint", "update")
    return _plain_times(run.newest_version(written, ["start_time", "end_time", "event_type"]))


@query("ST2 ST10 ST16 JSN3", """
    SELECT CAST(event_id AS VARCHAR) AS "eventId", event_type AS status, CAST(json_extract(props, '$.k') AS BIGINT) AS temperature
    FROM events
""")
def st_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of JSON lines, a few files per trigger, archived when done; devices as CSV rows."""
    path = fresh_path(spark, "device-files")
    k = json_columns.parse(F.col("props"), "k bigint")["k"]
    device = F.struct(F.lit("d").alias("deviceId"), F.lit("C").alias("measure"), F.col("event_type").alias("status"), k.alias("temperature"))
    body = F.struct(
        F.col("event_id").cast("string").alias("eventId"), F.struct(F.array(device).alias("devices")).alias("data")
    )
    table(spark, sf_dir, "events").select(body.alias("b")).select("b.*").repartition(6).write.json(f"{path}/in")
    stream = sources.file_stream(
        spark, f"{path}/in", "json", schemas.DEVICE_EVENT, files_per_trigger=2, archive_dir=f"{path}/archive"
    )
    rows = stream.select("eventId", F.explode("data.devices").alias("d")).select("eventId", "d.status", "d.temperature")
    run.to_files(rows, f"{path}/out", f"{path}/checkpoint", "csv", header=True)
    return spark.read.schema(rows.schema).option("header", True).csv(f"{path}/out")


@query("ST5 J12 ST10 ST13", """
    SELECT event_id, c_name AS name FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase'
""")
def st_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded messages beside a static table."""
    sent = sources.table_stream(spark, sf_dir, "events").select(
        F.to_json(F.struct("event_id", "user_id", "event_type")).cast("binary").alias("value")
    )
    decoded = decode(sent, "event_id bigint, user_id bigint, event_type string")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    bought = decoded.where(F.col("event_type") == "purchase")
    return _stored(join_small(bought, customers, "user_id").select("event_id", "name"), "stream-static")


@query("ST4 J12 ST13", "SELECT c_custkey AS value, c_name AS name FROM customer")
def st_rate_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated stream of as many numbers as there are customer keys, joined with them."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("value"), F.col("c_name").alias("name"))
    rows = customers.agg(F.max("value")).first()[0] + 1
    numbers = sources.rate_batch_stream(spark, rows, spark.sparkContext.defaultParallelism)
    return _stored(numbers.join(customers, "value").select("value", "name"), "rate-static")


@query("ST15 SQL5 ST8 ST13", "SELECT event_type, count(*) AS events FROM events GROUP BY 1")
def st_memory_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of running counts kept by the driver and asked for in SQL."""
    name = fresh_path(spark, "counts").rsplit("/", 1)[1].replace("-", "_")
    counts = sources.table_stream(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    run.to_memory(counts, name, fresh_path(spark, "memory-checkpoint"), "complete")
    return spark.sql(f"SELECT event_type, events FROM {name}")


@query("ST18 ST13 ST19", """
    SELECT event_type, count(*) AS parquet_rows, count(*) AS json_rows FROM events GROUP BY 1
""")
def st_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch into two sinks, computed once; a replayed batch overwrites its own files."""
    path = fresh_path(spark, "many-sinks")
    stream = sources.table_stream(spark, sf_dir, "events").select("event_id", "event_type")
    sinks = [run.batch_files(f"{path}/parquet"), run.batch_files(f"{path}/json", "json")]
    run.to_many(stream, sinks, f"{path}/checkpoint")
    first = spark.read.parquet(f"{path}/parquet").groupBy("event_type").agg(F.count(F.lit(1)).alias("parquet_rows"))
    second = spark.read.schema("event_id bigint, event_type string").json(f"{path}/json").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("json_rows")
    )
    return first.join(second, "event_type")


@query("ST25 ST19 ST13 ST16", "SELECT event_type, count(*) AS events FROM events GROUP BY 1")
def st_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query stopped and started again on its checkpoint repeats nothing and adds what is new."""
    path = fresh_path(spark, "restart")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    early = F.col("event_type").isin("click", "view")
    for part in (events.where(early), events.where(~early), None):
        if part is not None:
            part.write.mode("append").parquet(f"{path}/in")
        stream = sources.file_stream(spark, f"{path}/in", "parquet", "event_id bigint, event_type string")
        run.to_files(stream, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query("ST5 ST7 ST8 STR6", r"""
    WITH d AS (SELECT TIMESTAMP '2024-01-01 12:00:00' + to_seconds(conv_id * 60) AS ts, unnest(string_split(text, ' ')) AS word FROM conversations),
    s AS (SELECT word, epoch_us(ts) // 300000000 * 300000000 AS slot FROM d),
    w AS (SELECT make_timestamp(slot - n * 300000000) AS start_time, make_timestamp(slot - n * 300000000 + 600000000) AS end_time, word
          FROM s, (VALUES (0), (1)) v(n))
    SELECT start_time, end_time, word, count(*) AS count FROM w GROUP BY 1, 2, 3
""")
def st_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed messages split into words, counted per sliding window."""
    stream = sources.table_stream(spark, sf_dir, "conversations")
    at = F.timestamp_seconds(F.lit(1704110400) + F.col("conv_id") * 60)
    body = F.struct(F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("event_time"), F.col("text").alias("data"))
    words = word_events(stream.select(F.to_json(body).cast("binary").alias("value")), schemas.WORD_MESSAGE)
    path = fresh_path(spark, "word-windows")
    written = run.to_batch_dirs(windowed_counts(words, "event_time", "word"), path, f"{path}-checkpoint", "complete")
    return _plain_times(run.newest_batch(written))


def _bikes(events: DataFrame) -> DataFrame:
    """Bike station messages laid out from the events, as a topic would carry them."""
    k = json_columns.parse(F.col("props"), "k bigint")["k"]
    body = events.select(
        F.col("user_id").cast("int").alias("id"), F.concat(F.lit("station "), "user_id").alias("name"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("active"), F.col("ts").alias("datetime"),
        (F.lit(101) + F.col("user_id") % 7).alias("total_bases"), k.alias("free_bases"),
        (F.col("event_id") % 5).alias("reservations"), "user_id",
    ).withColumns(strip_place("user_id")).drop("user_id")
    return topic_rows(body, key=F.col("id"))


def _parkings(events: DataFrame) -> DataFrame:
    body = events.select(
        F.col("ts").alias("datetime"), F.col("user_id").cast("string").alias("id"),
        F.when(F.col("event_type") != "signup", F.floor("value")).alias("free_slots"),
    )
    return topic_rows(body, key=F.col("id"))


def _traffic(events: DataFrame) -> DataFrame:
    body = events.select(
        F.col("user_id").cast("string").alias("id"), F.col("value").cast("string").alias("intensity"),
        F.lit("0").alias("occupancy"), F.lit("0").alias("load"), F.col("ts").alias("at"),
    )
    return topic_rows(body, key=F.col("id"))


def parking_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parking sites laid out from the customers."""
    sites = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"),
        (F.lit(103) + F.col("c_nationkey")).alias("total_slots"),
    )
    return sites.withColumns(strip_place("id"))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.col("ts").alias("datetime"), F.month("ts").alias("month"),
        F.col("value").cast("string").alias("intensity"),
    )


NOW = "2024-01-15 23:30:00"

BIKES_SQL = f"""
    bikes AS (SELECT user_id AS id, ts, (CAST(json_extract(props, '$.k') AS BIGINT) + event_id % 5) / CAST(101 + user_id % 7 AS DOUBLE) AS occupancy,
                     {strip_sql('user_id')} FROM events WHERE event_type <> 'error')
"""
PARKINGS_SQL = f"""
    parkings AS (SELECT user_id AS id, ts, 1 - floor(value) / CAST(103 + c_nationkey AS DOUBLE) AS occupancy,
                        {strip_sql('c_custkey')} FROM events JOIN customer ON user_id = c_custkey WHERE event_type <> 'signup')
"""
TRAFFIC_SQL = f"""
    usual AS (SELECT user_id, max(value) AS top FROM events
              WHERE month(ts) = 1 AND least(abs(hour(ts) - 23), 24 - abs(hour(ts) - 23)) <= 1 GROUP BY 1),
    traffic AS (SELECT user_id AS id, ts, CASE WHEN value / top > 1 THEN 1e0 ELSE value / top END AS occupancy,
                       {strip_sql('c_custkey')} FROM events JOIN customer ON user_id = c_custkey JOIN usual USING (user_id))
"""


def _bike_rows(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    return mobility.bike_occupancy(decode(_bikes(events), schemas.BIKES_MESSAGE))


def _parking_rows(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    return mobility.parking_occupancy(decode(_parkings(events), schemas.PARKING_MESSAGE), parking_sites(spark, sf_dir))


def _traffic_rows(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    hourly = mobility.hourly_maxima(_history(spark, sf_dir))
    maxima = mobility.usual_maximum(hourly, F.lit(NOW).cast("timestamp_ntz"))
    decoded = decode(_traffic(events), f"{schemas.TRAFFIC_MESSAGE}, at timestamp")
    return mobility.traffic_occupancy(decoded, parking_sites(spark, sf_dir), maxima).withColumnRenamed("at", "datetime")


def _occupancies(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("id").cast("bigint").alias("id"), "occupancy", "longitude", "latitude")


@query("ST21 ST5 ST3 ST10", f"WITH {BIKES_SQL} SELECT id, occupancy, longitude, latitude FROM bikes")
def st_enrich_bikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(_occupancies(_bike_rows(spark, sf_dir, _event_stream(spark, sf_dir))), "bikes")


@query("ST22 ST5 J12 J14", f"WITH {PARKINGS_SQL} SELECT id, occupancy, longitude, latitude FROM parkings")
def st_enrich_parking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupancies are negative where more slots are free than the registry knows."""
    return _stored(_occupancies(_parking_rows(spark, sf_dir, _event_stream(spark, sf_dir))), "parkings")


@query("ST23 ST5 J12 DAT8 NUL5", f"WITH {TRAFFIC_SQL} SELECT id, occupancy, longitude, latitude FROM traffic")
def st_enrich_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(_occupancies(_traffic_rows(spark, sf_dir, _event_stream(spark, sf_dir))), "traffic")


@query("ST17 ST21", f"""
    WITH {BIKES_SQL}
    SELECT CAST(id AS VARCHAR) AS key, id, occupancy, longitude, latitude FROM bikes
""")
def st_topic_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key and JSON value an enrichment sends on, decoded as the next stream will."""
    rows = topic_rows(_bike_rows(spark, sf_dir, _event_stream(spark, sf_dir)), F.col("id"), mobility.OCCUPANCY)
    sent = _stored(rows, "bikes-topic")
    fields = json_columns.parse(F.col("value"), schemas.OCCUPANCY_MESSAGE)
    return sent.select("key", fields.alias("m")).select(
        "key", F.col("m.id").cast("bigint").alias("id"), "m.occupancy", "m.longitude", "m.latitude"
    )


_ALL_SQL = f"""
    {PLACES_SQL}, {BIKES_SQL}, {PARKINGS_SQL}, {TRAFFIC_SQL},
    r AS (SELECT * FROM bikes UNION ALL SELECT * FROM parkings UNION ALL SELECT * FROM traffic)
"""


def _three(spark: SparkSession, sf_dir: str, events: DataFrame) -> list[DataFrame]:
    return [make(spark, sf_dir, events) for make in (_bike_rows, _parking_rows, _traffic_rows)]


def message_streams(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three feeds' (key, value) messages, as topics would deliver them."""
    events = _event_stream(spark, sf_dir)
    return _bikes(events), _parkings(events), _traffic(events)


def three_feeds(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return _three(spark, sf_dir, _event_stream(spark, sf_dir))


@query("J13 J7 ST10", f"WITH {_ALL_SQL} SELECT p.id AS point_id, count(*) AS readings FROM p JOIN r ON {NEAR_SQL} GROUP BY 1")
def st_static_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream beside the static points near its rows, by grid cells."""
    near = mobility.nearby(places(spark, sf_dir), three_feeds(spark, sf_dir))
    counts = near.groupBy("point_id").agg(F.count(F.lit(1)).alias("readings"))
    path = fresh_path(spark, "radius")
    return run.newest_batch(run.to_batch_dirs(counts, path, f"{path}-checkpoint", "complete"))


_FUSED_SQL = f"""
    WITH {_ALL_SQL}
    SELECT p.id AS id, p.name AS name, p.longitude AS longitude, p.latitude AS latitude, round(avg(occupancy), 6) AS occupancy
    FROM p JOIN r ON {NEAR_SQL} GROUP BY 1, 2, 3, 4
"""


POINT_MEAN = "id long, name string, longitude double, latitude double, occupancy double"


def _rounded(fused: DataFrame) -> DataFrame:
    return fused.withColumn("occupancy", F.round("occupancy", 6))


@query("ST24 ST20 ST9 SET2 J13", _FUSED_SQL)
def st_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean occupancy near each point over three enriched streams, by running totals per place; each batch
    stores the points whose mean has changed, the newest version of each is kept."""
    path = fresh_path(spark, "fusion")
    points = places(spark, sf_dir)
    writer = fuse_by_place(points, three_feeds(spark, sf_dir), f"{path}-places", [run.batch_files(path)])
    run.complete(spark, writer, f"{path}-checkpoint")
    written = spark.read.schema(f"{POINT_MEAN}, batch_id long").parquet(path)
    return _rounded(run.newest_version(written, ["id", "name", "longitude", "latitude"]))


@query("ST24 J7", _FUSED_SQL)
def st_fusion_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mean from a finished table, summed per place before the points are met."""
    rows = [_occupancies(r) for r in _three(spark, sf_dir, table(spark, sf_dir, "events"))]
    readings = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return _rounded(mobility.fuse_table(places(spark, sf_dir), readings))


@query("ST24 ST6 ST10", f"""
    WITH {_ALL_SQL}
    SELECT date_trunc('day', ts) AS start_time, date_trunc('day', ts) + INTERVAL 1 DAY AS end_time,
           p.id AS id, p.name AS name, p.longitude AS longitude, p.latitude AS latitude, round(avg(occupancy), 6) AS occupancy
    FROM p JOIN r ON {NEAR_SQL}
    WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events WHERE event_type <> 'signup' AND event_type <> 'error') - INTERVAL 10 MINUTE
    GROUP BY ALL
""")
def st_fusion_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means whose state expires once the slowest stream's watermark has passed the day."""
    streams = [r.withColumn("datetime", F.col("datetime").cast("timestamp")) for r in three_feeds(spark, sf_dir)]
    path = fresh_path(spark, "fusion-windowed")
    writer = fuse_windows_by_place(
        places(spark, sf_dir), streams, "datetime", "1 day", "10 minutes", [run.batch_files(path)]
    )
    run.complete(spark, writer, f"{path}-checkpoint")
    written = spark.read.schema(f"start_time timestamp, end_time timestamp, {POINT_MEAN}").parquet(path)
    return _plain_times(_rounded(written.drop("batch_id")))


@query("ST20 ST9", """
    SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS events FROM events GROUP BY 1
""")
def st_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals since the start, without a watermark: one state row per user, for ever."""
    path = fresh_path(spark, "totals")
    totals = sources.table_stream(spark, sf_dir, "events").groupBy("user_id").agg(
        exact_sum(F.col("value")).alias("total"), F.count(F.lit(1)).alias("events")
    )
    return run.newest_version(run.to_batch_dirs(totals, path, f"{path}-checkpoint", "update"), ["user_id"])


@query("ST12 ST14 ST2", """
    SELECT event_type, count(*) AS events, (SELECT count(*) FROM events) AS console_rows, true AS several_batches FROM events GROUP BY 1
""")
def st_clocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries on their clocks over a folder of files, one file a batch: one stores its rows, the other shows
    its running counts on the console.  Both are stopped when their progress says that they have read all."""
    path = fresh_path(spark, "clocked")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    events.repartition(3).write.parquet(f"{path}/in")
    rows = spark.read.parquet(f"{path}/in").count()

    def arriving() -> DataFrame:
        return sources.file_stream(spark, f"{path}/in", "parquet", "event_id bigint, event_type string", files_per_trigger=1)

    stored = arriving().writeStream.foreachBatch(run.batch_files(f"{path}/out"))
    batches = run.on_clock(stored, f"{path}/checkpoint", "200 milliseconds", rows)
    counts = arriving().groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    with session_settings(spark, **run.stateful_settings(spark)):
        shown = run.on_clock(run.to_console(counts, "complete"), f"{path}/console", "200 milliseconds", rows)
    written = spark.read.schema("event_id bigint, event_type string, batch_id bigint").parquet(f"{path}/out")
    return written.groupBy("event_type").agg(F.count(F.lit(1)).alias("events")).select(
        "event_type", "events", F.lit(sum(batch["numInputRows"] for batch in shown)).alias("console_rows"),
        F.lit(len(batches) >= 2 and len(shown) >= 2).alias("several_batches"),
    )


_EARLY = ("click", "view")


@query("J12 ST22 ST18", f"""
    SELECT event_id, c_name AS name FROM events JOIN customer ON user_id = c_custkey WHERE event_type NOT IN {_EARLY} OR c_custkey % 2 = 0
""")
def st_registry_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running stream meets a registry that grows: its first batch finds half of the customers registered,
    the others are added before the second."""
    path = fresh_path(spark, "refresh")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    early, files = F.col("event_type").isin(*_EARLY), []
    for turn, part in enumerate((events.where(early), events.where(~early))):
        part.repartition(2).write.parquet(f"{path}/in/turn={turn}")
        files.append(spark.read.parquet(f"{path}/in/turn={turn}").select("_metadata.file_path").distinct().count())
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    run.publish_snapshot(customers.where(F.col("user_id") % 2 == 0), f"{path}/registry")

    def grow(rows: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            run.publish_snapshot(customers, f"{path}/registry")

    # One turn a batch.
    stream = sources.file_stream(
        spark, f"{path}/in/turn=*", "parquet", "event_id bigint, event_type string, user_id bigint", files_per_trigger=files[0]
    )
    writer = run.with_registry(
        stream, f"{path}/registry", "user_id bigint, name string", f"{path}/used",
        lambda batch, registry: join_small(batch, registry, "user_id").select("event_id", "name"),
        [run.batch_files(f"{path}/out"), grow],
    )
    run.complete(spark, writer, f"{path}/checkpoint")
    return spark.read.schema("event_id bigint, name string").parquet(f"{path}/out").select("event_id", "name")
