"""Fusion with state per place, registries that grow, and queries on a clock."""

import random

import pytest
from pyspark.sql import functions as F

from rowmill.apps import city_streams
from rowmill.apps.jobs import parser
from rowmill.operators import quality
from rowmill.session import fresh_path
from rowmill.sinks.files import write_single_file
from rowmill.sources import files, streams
from rowmill.streaming import mobility, places, run

READING = "id string, occupancy double, longitude double, latitude double"


def town(spark, batches=3, readings=300):
    """Points, and readings in batches of which a third come from one place."""
    draw = random.Random(21)
    points = spark.createDataFrame(
        [(i, f"point {i}", draw.uniform(0, 0.03), draw.uniform(0, 0.03)) for i in range(25)],
        "id long, name string, longitude double, latitude double",
    )
    spots = [(draw.uniform(0, 0.03), draw.uniform(0, 0.03)) for _ in range(40)]
    sent = []
    for batch in range(batches):
        # Every batch hears of fewer places than the one before.
        spoken = spots[: 40 - 12 * batch]
        sent.append([
            (str(i), draw.choice([None, draw.random(), draw.random()]), *(spots[0] if i % 3 == 0 else draw.choice(spoken)))
            for i in range(readings)
        ])
    return points, sent


def arriving(spark, sent, path):
    """Each batch a file, in the order of time."""
    for rows in sent:
        spark.createDataFrame(rows, READING).coalesce(1).write.mode("append").parquet(path)
    return streams.file_stream(spark, path, "parquet", READING, files_per_trigger=1)


def newest(spark, path):
    schema = "id long, name string, longitude double, latitude double, occupancy double, batch_id long"
    written = spark.read.schema(schema).parquet(path)
    return {r.id: r.occupancy for r in run.newest_version(written, ["id", "name", "longitude", "latitude"]).collect()}


def test_a_place_is_one_state_row_and_meets_points_once(spark, monkeypatch):
    monkeypatch.setattr(places, "SUMMARY_EVERY", 2)
    points, sent = town(spark, 5)
    path = fresh_path(spark, "places-test")
    stream = arriving(spark, sent, f"{path}/in")
    sink = run.batch_files(f"{path}/out")
    writer = places.fuse_by_place(points, [stream], f"{path}/state", [sink])
    with run.session_settings(spark, **run.stateful_settings(spark, 3)):
        query = run.available_now(writer, f"{path}/checkpoint").start()
        run.finish(query)
    known = [r for batch in sent for r in batch if r[1] is not None]
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == len({(r[2], r[3]) for r in known}) <= 40
    every = spark.createDataFrame([r for batch in sent for r in batch], READING)
    expected = {r.id: r.occupancy for r in mobility.fuse_table(points, every).collect()}
    assert newest(spark, f"{path}/out") == pytest.approx(expected)
    # What is stored are a batch's changed places and summaries, the older ones of which are gone.
    assert len(files.list_numbered(spark, f"{path}/state", "summary")) in (1, 2)
    assert files.list_numbered(spark, f"{path}/state", "changed")[0] > 0
    changed = spark.read.parquet(f"{path}/state/changed=4")
    assert changed.count() == changed.select("longitude", "latitude").distinct().count() < len({(r[2], r[3]) for r in known})


def test_a_replayed_batch_gives_the_same_places(spark, rows):
    path = fresh_path(spark, "replay-test")
    state = places.PlaceState(spark, path)
    first = spark.createDataFrame([(0.0, 0.0, 1.0, 2), (1.0, 1.0, 5.0, 5)], "longitude double, latitude double, total double, n long")
    second = spark.createDataFrame([(0.0, 0.0, 4.0, 5)], first.schema)
    state.add(first, 0)
    expected = [(0.0, 0.0, 4.0, 5, 1), (1.0, 1.0, 5.0, 5, 0)]
    for _ in range(2):
        changed, newest_places = state.add(second, 1)
        assert rows(newest_places) == expected and rows(changed) == expected[:1]
    # A batch that is replayed after later ones were stored does not read them.
    state.add(spark.createDataFrame([(1.0, 1.0, 9.0, 9)], first.schema), 2)
    assert rows(state.add(second, 1)[1]) == expected
    silent = places.PlaceState(spark, path, silent=2)
    assert [r[:2] for r in rows(silent.add(spark.createDataFrame([(2.0, 2.0, 1.0, 1)], first.schema), 3)[1])] == [(1.0, 1.0), (2.0, 2.0)]


def test_windows_close_once_no_stream_can_add(spark):
    points, sent = town(spark, 1, 90)
    path = fresh_path(spark, "window-test")
    timed = [(r[0], r[1], r[2], r[3], f"2024-03-01 0{i % 3}:30:00") for i, r in enumerate(sent[0])]
    rows = spark.createDataFrame(timed, f"{READING}, sent string").withColumn("sent", F.col("sent").cast("timestamp"))
    rows.write.parquet(f"{path}/in")
    stream = streams.file_stream(spark, f"{path}/in", "parquet", f"{READING}, sent timestamp")
    writer = places.fuse_windows_by_place(points, [stream], "sent", "1 hour", "10 minutes", [run.batch_files(f"{path}/out")])
    run.complete(spark, writer, f"{path}/checkpoint")
    schema = "start_time timestamp, end_time timestamp, id long, name string, longitude double, latitude double, occupancy double"
    found = {(str(r.start_time), r.id): r.occupancy for r in spark.read.schema(schema).parquet(f"{path}/out").collect()}
    expected = {}
    for hour in range(2):
        part = rows.where(F.hour("sent") == hour)
        expected |= {(f"2024-03-01 0{hour}:00:00", r.id): r.occupancy for r in mobility.fuse_table(points, part).collect()}
    assert found == pytest.approx(expected)


def test_fusion_takes_window_and_lateness_from_the_command_line(spark):
    args = parser().parse_args([
        "stream", "fusion", "--servers", "h:1", "--topics", "a", "b", "c", "--out-topic", "o", "--checkpoint", "c",
        "--state-partitions", "2", "--window", "1 hour", "--lateness", "5 minutes", "--silent-batches", "9",
    ])
    assert (args.window, args.lateness, args.silent_batches) == ("1 hour", "5 minutes", 9)
    messages = spark.createDataFrame(
        [(b'{"id": "1", "occupancy": 0.5, "longitude": 0.0, "latitude": 0.0}', "2024-03-01 10:00:00")], "value binary, timestamp string"
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert city_streams.readings_of(messages).columns == ["sent", "id", "occupancy", "longitude", "latitude"]
    assert city_streams.readings_of(messages.drop("timestamp")).first()["occupancy"] == 0.5
    fused = spark.createDataFrame([(1, "p", 0.0, 0.0, 0.5)], "id long, name string, longitude double, latitude double, occupancy double")
    assert city_streams.fusion_rows(fused).first()["value"] == '{"id":1,"name":"p","longitude":0.0,"latitude":0.0,"occupancy":0.5}'


def test_a_batch_meets_the_newest_registry_and_keeps_it_when_replayed(spark, rows):
    path = fresh_path(spark, "registry-test")
    ddl = "id int, name string"
    assert run.batch_snapshot(spark, f"{path}/r", f"{path}/used", 0, ddl).isEmpty()
    assert run.publish_snapshot(spark.createDataFrame([(1, "one")], ddl), f"{path}/r") == 0
    assert rows(run.batch_snapshot(spark, f"{path}/r", f"{path}/used", 1, ddl)) == [(1, "one")]
    assert run.publish_snapshot(spark.createDataFrame([(1, "one"), (2, "two")], ddl), f"{path}/r") == 1
    assert rows(run.batch_snapshot(spark, f"{path}/r", f"{path}/used", 2, ddl)) == [(1, "one"), (2, "two")]
    assert rows(run.batch_snapshot(spark, f"{path}/r", f"{path}/used", 1, ddl)) == [(1, "one")]
    assert run.batch_snapshot(spark, f"{path}/r", f"{path}/used", 0, ddl).isEmpty()


def test_the_second_batch_meets_a_sensor_registered_after_start(spark, rows):
    path = fresh_path(spark, "late-sensor")
    run.publish_snapshot(spark.createDataFrame([(1, "a")], "id int, name string"), f"{path}/r")

    def register(batch, batch_id):
        if batch_id == 0:
            run.publish_snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"), f"{path}/r")

    for _ in range(2):
        spark.createDataFrame([(1,), (2,)], "id int").coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = streams.file_stream(spark, f"{path}/in", "parquet", "id int", files_per_trigger=1)
    writer = run.with_registry(
        stream, f"{path}/r", "id int, name string", f"{path}/used", lambda batch, r: batch.join(r, "id"),
        [run.batch_files(f"{path}/out"), register],
    )
    run.complete(spark, writer, f"{path}/checkpoint")
    out = spark.read.schema("id int, name string, batch_id int").parquet(f"{path}/out")
    assert rows(out, "batch_id", "id", "name") == [(0, 1, "a"), (1, 1, "a"), (1, 2, "b")]


def test_a_clocked_query_is_stopped_by_its_progress(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([(i,)], "v int").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = streams.file_stream(spark, str(tmp_path / "in"), "json", "v int", files_per_trigger=1)
    events = run.on_clock(stream.writeStream.format("noop"), str(tmp_path / "c"), "100 milliseconds", 3)
    assert [e["numInputRows"] for e in events] == [1, 1, 1] and not any(q.id == events[0]["id"] for q in spark.streams.active)
    with pytest.raises(TimeoutError):
        run.on_clock(stream.writeStream.format("noop"), str(tmp_path / "d"), "100 milliseconds", 4, patience=3)
    broken = stream.select(F.raise_error(F.lit("stop here")).cast("string").alias("x"))
    with pytest.raises(Exception, match="stop here"):
        run.on_clock(broken.writeStream.format("noop"), str(tmp_path / "e"), "100 milliseconds", 3)


def test_one_failing_dataflow_does_not_keep_the_others_from_running(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").write.json(str(tmp_path / "in"))

    def flow(name, out, mode="OVERWRITE"):
        return {
            "name": name, "sources": [{"name": "s", "path": str(tmp_path / "in"), "format": "JSON"}],
            "transformations": [{"name": "t", "type": "validate_fields", "params": {
                "input": "s", "validations": [{"field": "b", "validations": ["notEmpty"]}]}}],
            "sinks": [{"input": "t_ok", "name": "k", "paths": [str(tmp_path / out)], "format": "JSON", "saveMode": mode}],
        }

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    flow_ok, flow_again = flow("good", "one"), flow("fails", "one", "ERRORIFEXISTS")
    failed = quality.run_dataflows(spark, [flow_ok, flow_again, flow("last", "two")])
    assert list(failed) == ["fails"] and spark.read.json(str(tmp_path / "two")).count() == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_single_files_keep_each_other_s_rows(spark, tmp_path):
    from rowmill.session import settle

    other = settle(spark.range(5), "staged")
    write_single_file(spark.range(9), str(tmp_path / "nine"))
    assert other.count() == 5 and spark.read.parquet(str(tmp_path / "nine")).count() == 9
