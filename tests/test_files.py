"""Sources and sinks on scratch folders."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from rowmill import schemas
from rowmill.apps import bus_trips, city
from rowmill.functions import udfs
from rowmill.operators import quality
from rowmill.session import build_session, fresh_path, shared_root
from rowmill.sinks import files as sinks
from rowmill.sinks import topics
from rowmill.sinks import unseen
from rowmill.sinks.unseen import append_unseen, without_key
from rowmill.sources import files, nested, streams


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_root(Session())


def test_named_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert fresh_path(spark, "x").startswith(named or "/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def _shifts(spark, rows):
    return spark.createDataFrame(rows, "worker string, hours int, ward string")


def test_partition_overwrite_golden(spark, tmp_path):
    """Static replaces the target; dynamic then replaces only the wards it has rows for."""
    path = str(tmp_path / "shifts")
    first = _shifts(spark, [("k", 8, "east"), ("l", 6, "east"), ("m", 7, "east"), ("n", 4, "attic")])
    second = _shifts(spark, [("o", 3, "west")])
    third = _shifts(spark, [("p", 12, "east"), ("q", 2, "west"), ("r", 5, "cellar")])

    def stored():
        return {r["ward"]: (r["n"], r["h"]) for r in spark.read.parquet(path).groupBy("ward").agg(
            F.count(F.lit(1)).alias("n"), F.sum("hours").alias("h")).collect()}

    sinks.write_partitioned(second, path, ["ward"])
    sinks.write_partitioned(first, path, ["ward"])
    assert stored() == {"east": (3, 21), "attic": (1, 4)}
    sinks.write_partitioned(third, path, ["ward"], dynamic=True)
    assert stored() == {"east": (1, 12), "attic": (1, 4), "west": (1, 2), "cellar": (1, 5)}


def test_hot_directory_is_split_by_size(spark, tmp_path):
    """Nine tenths of the rows in one directory: its rows are written by several tasks."""
    df = spark.range(400000).select((F.col("id") % 10 == 0).alias("cold"), F.sha2(F.col("id").cast("string"), 256).alias("h"))

    def files_of(value, size):
        path = str(tmp_path / f"t{size}")
        sinks.write_partitioned(df, path, ["cold"], task_bytes=size)
        assert spark.read.parquet(path).count() == 400000
        return len([f for f in os.listdir(f"{path}/cold={value}") if f.startswith("part-")])

    assert files_of("false", "1m") > 3
    assert files_of("true", "512m") == 1
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") not in ("1m", "512m")


def test_single_file_whatever_the_size(spark, tmp_path):
    sinks.write_single_file(spark.range(100_000, numPartitions=4), str(tmp_path / "one"))
    assert len([f for f in os.listdir(tmp_path / "one") if f.startswith("part-")]) == 1
    assert spark.read.parquet(str(tmp_path / "one")).count() == 100_000


def test_json_source_reads_every_line_of_a_glob(spark, tmp_path):
    for part in range(2):
        (tmp_path / f"part-{part}.json").write_text("".join(f'{{"id": {5 * part + i}}}\n' for i in range(5)))
    frames = quality.run_dataflow(spark, {
        "sources": [{"name": "in", "path": str(tmp_path / "part-*.json"), "format": "JSON", "schema": "id long"}],
        "transformations": [], "sinks": [],
    })
    assert sorted(r.id for r in frames["in"].collect()) == list(range(10))


def test_append_unseen_is_idempotent(spark, tmp_path):
    path, ddl = str(tmp_path / "r"), "id int, v int"
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, 5)], ddl)
    assert append_unseen(rows, path, ddl, ["id"], ["v"])
    assert not append_unseen(rows, path, ddl, ["id"], ["v"])
    assert append_unseen(spark.createDataFrame([(2, 9), (3, 9)], ddl), path, ddl, ["id"], ["v"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, 2), (2, 5), (3, 9)]


def test_two_interleaved_runs_store_a_key_once(spark, tmp_path):
    path, ddl = str(tmp_path / "r"), "id int, v int"
    assert append_unseen(spark.createDataFrame([(0, 0)], ddl), path, ddl, ["id"], ["v"])
    slow = unseen.stage_unseen(spark.createDataFrame([(1, 1), (2, 1), (3, 1)], ddl), path, ddl, ["id"], ["v"])
    late = unseen.stage_unseen(spark.createDataFrame([(2, 3)], ddl), path, ddl, ["id"], ["v"])
    assert append_unseen(spark.createDataFrame([(2, 2), (4, 2)], ddl), path, ddl, ["id"], ["v"])
    assert unseen.commit_unseen(slow) and not unseen.commit_unseen(late)
    expected = [(0, 0), (1, 1), (2, 2), (3, 1), (4, 2)]
    assert sorted(map(tuple, spark.read.schema(ddl).parquet(path).collect())) == expected
    # A writer that ended between its commit and its publication: the next run publishes.
    staged = unseen.stage_unseen(spark.createDataFrame([(5, 5)], ddl), path, ddl, ["id"], ["v"])
    publish, unseen.Commits.publish = unseen.Commits.publish, lambda self, record: None
    try:
        assert unseen.commit_unseen(staged)
    finally:
        unseen.Commits.publish = publish
    assert spark.read.schema(ddl).parquet(path).count() == 5
    assert not append_unseen(spark.createDataFrame([(5, 6)], ddl), path, ddl, ["id"], ["v"])
    assert sorted(map(tuple, spark.read.schema(ddl).parquet(path).collect())) == [*expected, (5, 5)]


def test_a_run_reads_only_buckets_of_candidates(spark, tmp_path, monkeypatch):
    path, ddl = str(tmp_path / "r"), "id int, v int"
    asked, real = [], unseen.Commits.index

    def noted(self, records, part, ddl):
        asked.append(part)
        return real(self, records, part, ddl)

    monkeypatch.setattr(unseen.Commits, "index", noted)
    monkeypatch.setattr(unseen, "MERGE_EVERY", 3)
    for start in range(0, 500, 100):
        rows = spark.range(start, start + 100).selectExpr("cast(id as int) as id", "1 as v")
        assert append_unseen(rows, path, ddl, ["id"], ["v"])
    records = unseen.Commits(spark, path).since_merge(4)
    assert [r["merged"] for r in records] == [False, False, True]
    # All keys are new to the filter, but for the few it mistakes: no more than their buckets are read.
    asked.clear()
    new = spark.range(10_000, 10_040).selectExpr("cast(id as int) as id", "1 as v")
    staged = unseen.stage_unseen(new, path, ddl, ["id"], ["v"])
    assert staged.rows.count() == 40 and asked in (["bits"], ["bits", "keys"])
    bits = real(staged.commits, records, "bits", "block int, w0 long, w1 long, w2 long, w3 long")
    old = spark.range(500).selectExpr("cast(id as int) as id")
    assert unseen.may_be_stored(old, bits, ["id"]).where("not __may").isEmpty()
    assert unseen.may_be_stored(spark.range(1000, 9000).selectExpr("cast(id as int) as id"), bits, ["id"]).where("__may").count() < 80
    plans, settled = [], unseen.settle
    monkeypatch.setattr(unseen, "settle", lambda df, *a: plans.append(df._jdf.queryExecution().toString()) or settled(df, *a))
    one = spark.createDataFrame([(7, 9)], ddl)
    assert unseen.stage_unseen(one, path, ddl, ["id"], ["v"]).rows.isEmpty()
    scans = [line for plan in plans for line in plan.split("\n") if "FileScan" in line and "bucket#" in line.partition("Batched")[0]]
    assert scans and all("bucket#" in line.partition("PartitionFilters: [")[2].partition("]")[0] for line in scans)


def test_a_target_without_commits_is_adopted(spark, tmp_path):
    path, ddl = str(tmp_path / "r"), "id int, v int"
    spark.createDataFrame([(1, 1), (2, 2)], ddl).write.parquet(path)
    assert append_unseen(spark.createDataFrame([(2, 5), (3, 3)], ddl), path, ddl, ["id"], ["v"])
    assert sorted(map(tuple, spark.read.schema(ddl).parquet(path).collect())) == [(1, 1), (2, 2), (3, 3)]


def test_rows_without_key_are_returned_not_appended(spark, tmp_path):
    path, ddl = str(tmp_path / "r"), "id int, v int"
    rows = spark.createDataFrame([(None, 1), (None, 2), (7, 3)], ddl)
    assert [append_unseen(rows, path, ddl, ["id"], ["v"]) for _ in range(3)] == [True, False, False]
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(7, 3)]
    assert sorted(r["v"] for r in without_key(rows, ["id"]).collect()) == [1, 2]


def test_unreadable_target_is_no_first_run(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        files.read_or_empty(spark, str(tmp_path / "bad"), "id int").count()
    assert files.read_or_empty(spark, str(tmp_path / "none"), "id int").count() == 0


def test_folded_files_keep_bad_lines(spark, tmp_path):
    (tmp_path / "f-1-a.csv").write_text("id;v\n1;10\nx;20\n")
    (tmp_path / "f-22-a.csv").write_text("id;v\n3;30\n")
    sound, rejected = files.fold_files(spark, str(tmp_path / "f-*.csv"), "id int, v int", ";", r"f-(\d+)-")
    assert sorted(map(tuple, sound.collect())) == [(1, 10, 1), (3, 30, 22)]
    assert [tuple(r) for r in rejected.collect()] == [(1, "x;20")]
    assert sound.count() == 2 and rejected.count() == 1


def test_html_links_in_any_attribute_order(spark):
    page = """<a class="big data" href='/one'>x</a><A HREF=/two class=data>y</A>
    <a
      href="/three" class="metadata">z</a><abbr class="data" href="/no">w</abbr><a class="data">none</a>"""
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    assert [r["href"] for r in nested.html_links(df, "page_id").collect()] == ["/one", "/two", "/three"]
    assert [r["href"] for r in nested.html_links(df, "page_id", css_class="data").collect()] == ["/one", "/two"]


def test_html_links_by_phrase_with_quotes_comments_and_references(spark):
    page = """<!-- <a class="go fast" href="/no">x</a>
    --><a title="a > b href=/title" class="big go
    fast" href="/q?a=1&amp;b=&#50;&#x41;&#xD800;&amp;lt;">x</a><a href='/other' class="go  slow fast">y</a><a href="">z</a>"""
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string")
    phrase = nested.html_links(df, "page_id", css_class="go fast").collect()
    assert [tuple(r) for r in phrase] == [(1, "/q?a=1&b=2A&#xD800;&lt;")]
    assert [r["href"] for r in nested.html_links(df, "page_id").collect()][1:] == ["/other", ""]


def test_xml_record_without_a_child(spark, tmp_path):
    (tmp_path / "t.xml").write_text(
        "<pms><pm><idelem>1</idelem><intensidad>10</intensidad></pm>"
        "<pm><idelem>2</idelem><intensidad>20</intensidad><carga>5</carga></pm></pms>")
    found = city.traffic_messages(nested.read_xml_records(spark, str(tmp_path / "t.xml"), "pm", schemas.TRAFFIC_XML))
    assert sorted(map(tuple, found.select("id", "intensity", "load").collect())) == [("1", "10", None), ("2", "20", "5")]


def test_replies_to_registry_and_messages(spark, tmp_path):
    (tmp_path / "parkings.json").write_text("""{"datetime": "2024-05-01T10:00:00", "data": [
        {"id": 1, "name": "P1", "freeParking": null, "geometry": {"type": "Point", "coordinates": ["-3.7", "40.4"]}},
        {"id": 2, "name": "P2", "freeParking": 7, "geometry": {"type": "Point", "coordinates": ["-3.6", "40.5"]}},
        {"id": 3, "name": "P3", "freeParking": 8, "geometry": {"type": "Point", "coordinates": ["bad", "40.5"]}}]}""")
    replies = files.read_json_documents(spark, str(tmp_path / "parkings.json"), schemas.PARKING_REPLY)
    details = spark.createDataFrame(
        [(1, [([("Total", "100")],)]), (2, [([("Free", "1"), ("Total", "x")],)]), (3, [([("Total", "50")],)])],
        schemas.PARKING_DETAIL_REPLY)
    sites = city.parking_sites(replies, details)
    assert sorted(map(tuple, sites.select("id", "longitude", "latitude", "total_slots").collect()), key=repr) == [
        (1, -3.7, 40.4, 100), (3, None, 40.5, 50)]
    messages = city.parking_messages(replies)
    assert [(r["id"], r["free_slots"]) for r in messages.orderBy("id").collect()] == [("1", None), ("2", 7), ("3", 8)]


def test_dataflow_reads_a_pretty_printed_array(spark, tmp_path):
    (tmp_path / "in.json").write_text(
        '[\n {"name": "Fran", "age": 30, "office": "A"},\n {"name": "Xabier", "age": 39, "office": ""}\n]')
    out = str(tmp_path / "ko")
    frames = quality.run_dataflow(spark, {
        "sources": [{"name": "people", "path": str(tmp_path / "in.json"), "format": "JSON", "options": {"multiLine": True}}],
        "transformations": [{"name": "v", "type": "validate_fields", "params": {
            "input": "people", "validations": [{"field": "office", "validations": ["notEmpty"]}]}}],
        "sinks": [{"input": "v_ko", "format": "JSON", "saveMode": "OVERWRITE", "paths": [out]}],
    })
    assert [r["name"] for r in frames["v_ok"].collect()] == ["Fran"]
    assert [r["name"] for r in spark.read.json(out).collect()] == ["Xabier"]


def test_jdbc_binding():
    """No database is started here: only what would be handed to one is checked."""
    options = topics.jdbc_options("jdbc:x:y", "device_data", "org.x.Driver", "u", "p")
    assert options == {"url": "jdbc:x:y", "dbtable": "device_data", "driver": "org.x.Driver", "user": "u", "password": "p"}


def test_kafka_binding(spark):
    """No broker jar here: the options are checked, and that Spark looks for the connector."""
    assert streams.kafka_options("h:1", "t", 5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5"}
    assert topics.kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    with pytest.raises(Exception, match="kafka"):
        topics.write_topic(topics.topic_rows(spark.range(1)), "t", {"kafka.bootstrap.servers": "h:1"})


def test_bus_trips_fill_and_flags(spark):
    raw = spark.createDataFrame([
        ("regular", "1", "c", "L", "b", "a", "2019", "31", "2", None, "6", "100"),
        ("regular", "2", "c", "L", "a", "b", "2020", "1", None, "3", "x", None),
        ("special", "3", "c", "L", "a", "c", "2020", "1", "50", "3", "3", "7"),
        ("regular", "4", "c", "M", "a", None, "2020", "99", None, None, None, None),
    ], schemas.BUS_TRIPS_RAW)
    trips = {r["trip_code"]: r for r in bus_trips.clean_trips(raw).collect()}
    assert set(trips) == {"1", "2", "4"}
    assert trips["2"]["trip_duration_hours"] == 2.0 and trips["2"]["travelled_distance_km"] == 100.0
    assert trips["1"]["delay_percentage"] == pytest.approx(5.0) and trips["1"]["speed_kmh"] == 50.0
    assert str(trips["1"]["date"]) == "2024-07-31" and trips["4"]["date"] is None
    assert trips["4"]["trip_duration_hours"] is None and trips["4"]["delay_percentage"] is None
    other = {r["trip_code"]: r for r in bus_trips.clean_trips(raw, "trip_duration_hours").collect()}
    assert other["2"]["travelled_distance_km"] == 2.0
    lines = sorted(map(tuple, bus_trips.two_way_lines(raw).collect()))
    assert lines == [("c", "L", "a-b"), ("c", "M", "a")]
    assert len(bus_trips.two_way_lines(raw, regular_only=False).collect()) == 3


def test_functions_run_without_the_package(tmp_path):
    """What is shipped to a Python worker unpickles where rowmill cannot be imported."""
    shipped = tmp_path / "functions.pkl"
    shipped.write_bytes(cloudpickle.dumps([udfs.root_step_python.func, udfs.root_step_pandas.func, udfs.upper_all_udf.func]))
    code = (
        "import pickle, sys; import pandas as pd; "
        f"a, b, c = pickle.load(open({str(shipped)!r}, 'rb')); "
        "print(a(9), b(pd.Series([16])).tolist(), c(['x']), 'rowmill' in sys.modules)"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "4 [5] ['X'] False", out.stderr


def test_session_defaults(spark):
    same = build_session("again")
    assert same.conf.get("spark.sql.ansi.enabled") == "true"
