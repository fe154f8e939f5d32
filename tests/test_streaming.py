"""Streams on file and generated sources, one file per trigger where the order matters."""

import json
import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from rowmill import schemas
from rowmill.functions.json import device_rows
from rowmill.registry import all_queries
from rowmill.session import session_settings
from rowmill.sources import streams
from rowmill.streaming import mobility, run
from rowmill.streaming.events import decode, windowed_counts, word_events

# fixed values: six timed messages, one of them an hour late, in order of arrival
WORDS = [
    ("2024-04-09 12:00:00", "owl dog owl"), ("2024-04-09 12:03:00", "owl"), ("2024-04-09 12:05:00", "owl"),
    ("2024-04-09 12:17:00", "dog"), ("2024-04-09 11:04:00", "dog"), ("2024-04-09 12:08:00", "dog"),
]


def _drop(folder, payloads):
    """One file per payload, each newer than the one before."""
    os.makedirs(folder, exist_ok=True)
    start = time.time() - 1000
    for i, payload in enumerate(payloads):
        name = os.path.join(folder, f"m{i}.txt")
        with open(name, "w") as out:
            out.write(payload)
        os.utime(name, (start + i, start + i))


def _dropped(folder, n):
    _drop(str(folder), [f"line {i}" for i in range(n)])
    return str(folder)


def _word_stream(spark, folder):
    _drop(folder, [json.dumps({"event_time": t, "data": d}) for t, d in WORDS])
    messages = streams.file_stream(spark, folder, "text", "value string", files_per_trigger=1)
    return windowed_counts(word_events(messages, schemas.WORD_MESSAGE), "event_time", "word")


def _short(df):
    return sorted(
        (r["start_time"].strftime("%H:%M"), r["word"], r["count"]) for r in df.select("start_time", "word", "count").collect()
    )


# fixed values: the counts per window start and word over all six messages
COMPLETE = [
    ("10:55", "dog", 1), ("11:00", "dog", 1), ("11:55", "dog", 1), ("11:55", "owl", 3), ("12:00", "dog", 2),
    ("12:00", "owl", 4), ("12:05", "dog", 1), ("12:05", "owl", 1), ("12:10", "dog", 1), ("12:15", "dog", 1),
]


def test_complete_mode_keeps_late_rows(spark, tmp_path):
    written = run.to_batch_dirs(_word_stream(spark, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"), "complete")
    assert _short(run.newest_batch(written)) == COMPLETE


def test_update_mode_drops_late_rows(spark, tmp_path):
    written = run.to_batch_dirs(_word_stream(spark, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"), "update")
    found = run.newest_version(written, ["start_time", "end_time", "word"])
    assert _short(found) == [row for row in COMPLETE if row[0] >= "11:55"]


def test_late_rows_come_in_three_batches_whatever_their_files(spark):
    """Splits without rows: the first task of a write leaves a file without any, of which no row tells."""
    folder = "/root/testdata/sf0.001"
    with session_settings(spark, spark__sql__files__maxPartitionBytes="4000"):
        assert spark.read.parquet(f"{folder}/events.parquet").rdd.getNumPartitions() > 2
        found = all_queries()["st_late_rows"].run(spark, folder).collect()
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
        names = ["start_time", "end_time", "event_type", "count"]
        asked = con.execute(f"SELECT {', '.join(names)} FROM ({all_queries()['st_late_rows'].sql})").fetchall()
    assert sorted(tuple(row[name] for name in names) for row in found) == sorted(asked)


def test_append_mode_emits_closed_windows(spark, tmp_path):
    stream = _word_stream(spark, str(tmp_path / "in"))
    run.to_files(stream, str(tmp_path / "o"), str(tmp_path / "c"))
    found = spark.read.schema(stream.schema).parquet(str(tmp_path / "o"))
    assert _short(found) == [("11:55", "dog", 1), ("11:55", "owl", 3)]


def test_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    written = run.to_batch_dirs(_word_stream(spark, folder), str(tmp_path / "o"), str(tmp_path / "c"), "complete")
    batch = windowed_counts(word_events(spark.read.text(folder), schemas.WORD_MESSAGE), "event_time", "word")
    assert _short(run.newest_batch(written)) == _short(batch)


def test_restart_repeats_nothing(spark, tmp_path):
    folder, out, mark = str(tmp_path / "in"), str(tmp_path / "o"), str(tmp_path / "c")
    _drop(folder, ["a", "b"])

    def go():
        run.to_files(streams.file_stream(spark, folder, "text", "value string"), out, mark)
        return sorted(r["value"] for r in spark.read.parquet(out).collect())

    assert go() == ["a", "b"] and go() == ["a", "b"]
    with open(os.path.join(folder, "later.txt"), "w") as late:
        late.write("c")
    assert go() == ["a", "b", "c"]


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    sink = run.batch_files(str(tmp_path / "o"))
    for _ in range(2):
        sink(spark.range(3), 0)
    sink(spark.range(2), 1)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 5


def test_archive_of_read_files(spark, tmp_path):
    folder = str(tmp_path / "in")
    _drop(folder, [json.dumps({"a": i}) for i in range(4)])
    stream = streams.file_stream(spark, folder, "json", "a int", 1, str(tmp_path / "archive"))
    run.to_files(stream, str(tmp_path / "o"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 4
    moved = [f for _, _, names in os.walk(tmp_path / "archive") for f in names]
    assert moved and len(moved) + len(os.listdir(folder)) == 4


def test_inferred_stream_schema(spark, tmp_path):
    folder = str(tmp_path / "in")
    _drop(folder, [json.dumps({"a": 1, "b": "x"})])
    spark.conf.set("spark.sql.streaming.schemaInference", "true")
    try:
        stream = streams.file_stream(spark, folder, "json", None)
        assert dict(stream.dtypes) == {"a": "bigint", "b": "string"}
    finally:
        spark.conf.unset("spark.sql.streaming.schemaInference")


def test_rate_sources(spark, tmp_path):
    assert dict(streams.rate_stream(spark, 5).dtypes) == {"timestamp": "timestamp", "value": "bigint"}
    run.to_files(streams.rate_batch_stream(spark, 50, 2), str(tmp_path / "o"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "o")).agg(F.sum("value")).first()[0] == 1225


def test_processing_time_trigger(spark, tmp_path):
    """A query on a clock runs until it is stopped."""
    stream = streams.file_stream(spark, _dropped(tmp_path / "in", 3), "text", "value string", files_per_trigger=1)
    query = run.every(stream.writeStream.format("noop"), str(tmp_path / "c"), "1 second").start()
    try:
        deadline = time.time() + 60
        while sum(p["numInputRows"] for p in query.recentProgress) < 3 and time.time() < deadline:
            time.sleep(0.2)
        assert query.isActive and sum(p["numInputRows"] for p in query.recentProgress) == 3
    finally:
        run.stop(query)
    assert not query.isActive


def test_console_binding(spark, tmp_path):
    writer = run.available_now(run.to_console(streams.rate_batch_stream(spark, 3, 1)), str(tmp_path / "c"))
    query = writer.start()
    run.finish(query)
    assert "Console" in query.lastProgress["sink"]["description"]


def test_socket_binding():
    """No port is opened here: the options asked for are checked on a stand-in reader."""
    asked = {}

    class Reader:
        def format(self, name):
            asked["format"] = name
            return self

        def options(self, **options):
            asked.update(options)
            return self

        def load(self):
            return "stream"

    class Session:
        readStream = Reader()

    assert streams.socket_stream(Session(), "host", 9999) == "stream"
    assert asked == {"format": "socket", "host": "host", "port": 9999}


def test_failed_query_raises(spark, tmp_path):
    broken = streams.rate_batch_stream(spark, 3, 1).select(F.raise_error(F.lit("stop here")).cast("string").alias("x"))
    with pytest.raises(Exception, match="stop here"):
        run.to_files(broken, str(tmp_path / "o"), str(tmp_path / "c"))


def test_device_rows_and_decoding(spark):
    event = {"eventId": "e1", "eventOffset": 7, "eventPublisher": "p", "customerId": "c", "eventTime": "t",
             "data": {"devices": [{"deviceId": "D1", "temperature": 5, "measure": "C", "status": "OK"},
                                  {"deviceId": "D2", "temperature": 6, "measure": "C", "status": "BAD"}]}}
    silent = {**event, "eventId": "e2", "data": {"devices": []}}
    df = spark.createDataFrame([(json.dumps(e).encode(),) for e in (event, silent)], "value binary")
    found = device_rows(df)
    assert sorted((r["eventId"], r["deviceId"], r["temperature"]) for r in found.collect()) == [("e1", "D1", 5), ("e1", "D2", 6)]
    assert decode(spark.createDataFrame([(b"oops",)], "value binary"), "a int").collect()[0]["a"] is None


def test_enrichment_formulas(spark):
    bikes = spark.createDataFrame([(1, 1, 3, 1, 8), (2, 0, 3, 1, 8), (3, 1, 3, 1, 0)], "id int, active int, free_bases int, reservations int, total_bases int")
    assert [(r["id"], r["occupancy"]) for r in mobility.bike_occupancy(bikes).orderBy("id").collect()] == [(1, 0.5), (3, None)]
    sites = spark.createDataFrame([(1, 0.0, 0.0, 10)], "id int, longitude double, latitude double, total_slots int")
    free = spark.createDataFrame([("1", 4), ("1", 15), ("1", None), ("9", 1), ("x", 1)], "id string, free_slots int")
    assert sorted(r["occupancy"] for r in mobility.parking_occupancy(free, sites).collect()) == [-0.5, 0.6]
    maxima = spark.createDataFrame([("1", 100.0)], "id string, intensity_max double")
    flow = spark.createDataFrame([("1", "50"), ("1", "250"), ("1", "bad"), ("7", "5")], "id string, intensity string")
    found = mobility.traffic_occupancy(flow, sites, maxima).collect()
    assert sorted((r["occupancy"] for r in found), key=repr) == [0.5, 1.0, None]


def test_usual_maximum_compares_numbers(spark):
    data = [("1", "2024-05-01 10:00:00", 5, "99"), ("1", "2024-05-02 11:30:00", 5, "1000"), ("1", "2024-05-02 14:30:00", 5, "5000")]
    history = spark.createDataFrame(data, "id string, datetime string, month int, intensity string").withColumn(
        "datetime", F.col("datetime").cast("timestamp"))
    now = F.lit("2024-05-09 10:45:00").cast("timestamp")
    assert mobility.usual_maximum(mobility.hourly_maxima(history), now).first()["intensity_max"] == 1000.0


def test_city_rollup(spark):
    latest = spark.createDataFrame([("a", 10.0), ("b", 30.0), ("c", 20.0)], "name string, value double")
    assert tuple(mobility.city_rollup(latest).first()) == (20.0, 30.0, "b", 10.0)
    assert sorted(r["weight"] for r in mobility.heat_weights(latest).collect()) == [0.0, 10.0, 20.0]


def test_stream_without_input_gives_no_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for mode in ("complete", "update"):
        messages = streams.file_stream(spark, str(tmp_path / "in"), "text", "value string")
        counts = windowed_counts(word_events(messages, schemas.WORD_MESSAGE), "event_time", "word")
        written = run.to_batch_dirs(counts, str(tmp_path / mode), str(tmp_path / f"{mode}-c"), mode)
        assert written.isEmpty() and {"word", "batch_id"} <= set(written.columns)
        assert run.newest_version(written, ["word"]).isEmpty()


def test_state_partitions_are_the_session_s_choice(spark):
    with session_settings(spark, **{run.STATE_PARTITIONS: "3"}):
        assert run.stateful_settings(spark)["spark__sql__shuffle__partitions"] == "3"
    assert run.state_partitions(spark) == spark.sparkContext.defaultParallelism
