"""The applications end to end: files in, tables out; messages in, messages out."""

import json

import pytest
from pyspark.sql import functions as F

from rowmill import schemas
from rowmill.apps import city_streams, jobs
from rowmill.streaming import mobility, run


def test_bus_trips_job(spark, tmp_path):
    header = "trip_type,trip_code,company,line_number,origin,destination,year,day,trip_duration_hours,delay_start_minutes,delay_end_minutes,travelled_distance_km\n"
    (tmp_path / "trips.csv").write_text(
        header + "regular,1,c,7,b,a,2019,1,2,10,2,100\nregular,2,c,7,a,b,2019,2,4,,24,100\nspecial,3,c,7,a,b,2019,2,4,1,1,9\n")
    out = str(tmp_path / "out")
    jobs.main(["bus-trips", "--input", str(tmp_path / "trips.csv"), "--output", out, "--table", "bus_trips_job"], spark)
    ratios = {str(r["date"]): r for r in spark.read.parquet(f"{out}/stats").collect()}
    assert ratios["2024-07-01"]["avg_delay_ratio"] == 1.0
    assert ratios["2024-07-02"]["avg_trip_duration_hours"] == pytest.approx(4 / 3)
    assert [tuple(r) for r in spark.read.parquet(f"{out}/lines").collect()] == [("c", "7", "a-b")]
    spark.sql("DROP TABLE bus_trips_job")


def test_history_locations_and_points_jobs(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        "id;fecha;tipo_elem;intensidad;ocupacion;carga;vmed;error;periodo_integracion\n"
        "1;2024-05-01 10:00:00;M;99;1;2;0;N;5\n1;2024-05-01 11:00:00;M;1000;1;2;0;S;5\n1;bad;M;7;1;2;0;N;5\n")
    jobs.main(["traffic-history", "--input", str(tmp_path / "h.csv"), "--output", str(tmp_path / "hist")], spark)
    stored = spark.read.parquet(str(tmp_path / "hist"))
    assert sorted((r["intensity"], r["month"]) for r in stored.where("month is not null").collect()) == [(99.0, 5)]
    assert stored.count() == 2
    jobs.main(["traffic-maxima", "--input", str(tmp_path / "hist"), "--output", str(tmp_path / "max")], spark)
    maxima = spark.read.parquet(str(tmp_path / "max")).where("month is not null").select("id", "month", "hour", "intensity_max")
    assert [tuple(r) for r in maxima.collect()] == [("1", 5, 10, 99.0)]

    (tmp_path / "pm-1-x.csv").write_text("id;nombre;longitud;latitud\n1;a;-3.7.1;40.4\n2;b;x;40.4\n", encoding="utf-8")
    (tmp_path / "pm-2-x.csv").write_text("id;nombre;longitud;latitud\n1;a2;-3.7.2;40.5\n", encoding="utf-8")
    target = str(tmp_path / "loc")
    for _ in range(2):
        jobs.main(["locations", "--input", str(tmp_path / "pm-*-x.csv"), "--output", target, "--version-pattern", r"pm-(\d+)-"], spark)
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [(1, "a2", -3.72, 40.5, 2)]
    assert spark.read.parquet(f"{target}-rejected").count() == 0

    (tmp_path / "poi.json").write_text(json.dumps({"data": [
        {"sourceName": "A", "data": [{"category": "c", "longitude": "-3.7", "latitude": "40.4", "idPoi": "5", "name": "n"}]},
        {"sourceName": "B", "data": [{"category": "d", "longitude": "0", "latitude": "0", "idPoi": "6", "name": "m"}]}]}))
    jobs.main(["points", "--input", str(tmp_path / "poi.json"), "--output", str(tmp_path / "poi"), "--source", "A"], spark)
    assert [tuple(r) for r in spark.read.schema(schemas.POI_REGISTRY).parquet(str(tmp_path / "poi")).collect()] == [
        ("c", -3.7, 40.4, 5, "n")]


def test_siblings_and_word_count_jobs(spark, tmp_path):
    (tmp_path / "e.csv").write_text(
        "first_name,last_name,job_title,dob,email,phone,salary,department_id\n"
        "a,X,cook,1990-01-01,a@x,1,1,1\nb,X,nurse,1995-01-01,b@x,1,1,1\nc,X,nurse,1970-01-01,c@x,1,1,1\nd,X,cook,1990-01-01,d@x,1,1,2\n")
    jobs.main(["siblings", "--input", str(tmp_path / "e.csv"), "--output", str(tmp_path / "s"), "--department", "1"], spark)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "s")).collect()] == [("cook", "nurse", 2)]

    (tmp_path / "w.txt").write_text("one  two\tone\n\n three one ")
    jobs.main(["word-count", "--input", str(tmp_path / "w.txt"), "--output", str(tmp_path / "w")], spark)
    found = spark.read.option("sep", "\t").schema("w string, n int").csv(str(tmp_path / "w"))
    assert sorted(map(tuple, found.collect())) == [("one", 3), ("three", 1), ("two", 1)]


def test_dataflow_job(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps([{"parcel": "p1", "grams": 40, "lane": "L2"}, {"parcel": "p2", "lane": "L2"}]))
    (tmp_path / "meta.json").write_text(json.dumps({"dataflows": [{
        "name": "parcels", "sources": [{"name": "in", "path": str(tmp_path / "in.json"), "format": "JSON"}],
        "transformations": [
            {"name": "v", "type": "validate_fields", "params": {"input": "in", "validations": [{"field": "grams", "validations": ["notNull"]}]}},
            {"name": "stamped", "type": "add_fields", "params": {"input": "v_ok", "addFields": [{"name": "dt", "function": "current_timestamp"}]}}],
        "sinks": [{"input": "stamped", "format": "JSON", "saveMode": "OVERWRITE", "paths": [str(tmp_path / "ok")]},
                  {"input": "v_ko", "format": "JSON", "saveMode": "OVERWRITE", "paths": [str(tmp_path / "ko")]}]}]}))
    jobs.main(["dataflow", "--metadata", str(tmp_path / "meta.json")], spark)
    assert [(r["parcel"], r["dt"] is not None) for r in spark.read.json(str(tmp_path / "ok")).collect()] == [("p1", True)]
    assert [r["failed_validations"] for r in spark.read.json(str(tmp_path / "ko")).collect()] == ["notNull validation failed for grams"]


def test_stages_from_messages_to_fused_points(spark, tmp_path):
    """Three stages over message files, their output topics as files, and the fusion over those."""
    sent = {
        "bikes": [{"id": 1, "active": 1, "free_bases": 4, "reservations": 1, "total_bases": 10, "longitude": 0.001, "latitude": 0.0},
                  {"id": 2, "active": 0, "free_bases": 4, "reservations": 1, "total_bases": 10, "longitude": 0.0, "latitude": 0.0}],
        "parking": [{"id": "1", "free_slots": 3}, {"id": "1", "free_slots": None}],
        "traffic": [{"id": "1", "intensity": "500"}, {"id": "1", "intensity": "45"}],
    }
    registry = spark.createDataFrame([(1, 0.004, 0.0, 10)], "id int, longitude double, latitude double, total_slots int")
    history = spark.createDataFrame([("1", "100"), ("1", "99")], "id string, intensity string").select(
        "id", "intensity", F.current_timestamp().alias("datetime"), F.month(F.current_timestamp()).alias("month"))
    history = mobility.hourly_maxima(history)
    topics = []
    for stage, messages in sent.items():
        folder = tmp_path / stage
        folder.mkdir()
        (folder / "m.txt").write_text("\n".join(json.dumps(m) for m in messages))
        stream = spark.readStream.schema("value string").text(str(folder)).withColumn("value", F.col("value").cast("binary"))
        rows = {
            "bikes": lambda s: city_streams.bikes_stage(s),
            "parking": lambda s: city_streams.parking_stage(s, registry),
            "traffic": lambda s: city_streams.traffic_stage(s, registry, history),
        }[stage](stream)
        run.to_files(rows, str(tmp_path / f"{stage}-out"), str(tmp_path / f"{stage}-c"))
        topics.append(spark.readStream.schema("key string, value string").parquet(str(tmp_path / f"{stage}-out")))
    points = spark.createDataFrame([(1, "A", 0.0, 0.0)], "id int, name string, longitude double, latitude double")
    sink = run.batch_files(str(tmp_path / "f"))
    writer = city_streams.fusion_writer(
        points, topics, str(tmp_path / "places"), [lambda fused, batch_id: sink(city_streams.fusion_rows(fused), batch_id)]
    )
    run.complete(spark, writer, str(tmp_path / "fc"))
    last = spark.read.schema("value string, batch_id long").parquet(str(tmp_path / "f")).orderBy(F.desc("batch_id")).first()["value"]
    found = json.loads(last)
    assert (found["id"], found["name"]) == (1, "A")
    assert found["occupancy"] == pytest.approx((0.5 + 0.7 + 1.0 + 0.45) / 4)


def test_stream_command_asks_for_the_connector(spark, tmp_path):
    args = ["stream", "bikes", "--servers", "h:1", "--topics", "t", "--out-topic", "o", "--checkpoint", str(tmp_path), "--state-partitions", "4"]
    with pytest.raises(Exception, match="kafka"):
        jobs.main(args, spark)
