"""Known answers on small known rows."""

import pytest
from pyspark.sql import functions as F

from rowmill.functions import json as json_columns
from rowmill.operators import groups, joins
from rowmill.operators.columns import flatten
from rowmill.sources.nested import envelope_rows

# Lamps by street: 31 of them, with a height and a power that no two lamps of a street share.
LAMPS = [(f"L{i:02}", f"S{i * i % 7}", 3 + i % 4, 40 + 11 * i % 97) for i in range(31)]


def by_street():
    streets = {}
    for lamp in LAMPS:
        streets.setdefault(lamp[1], []).append(lamp)
    return streets


@pytest.fixture(scope="module")
def lamps(spark):
    """All read as text."""
    rows = [tuple(map(str, lamp)) for lamp in LAMPS]
    return spark.createDataFrame(rows, "lamp string, street string, height string, watts string")


@pytest.fixture(scope="module")
def typed(lamps):
    return lamps.withColumns({c: F.col(c).try_cast("int") for c in ("height", "watts")})


def test_filters(typed):
    assert typed.where("watts > 80").count() == sum(lamp[3] > 80 for lamp in LAMPS)
    assert typed.where(F.col("height") > 4).count() == sum(lamp[2] > 4 for lamp in LAMPS)
    assert typed.withColumn("fee", F.col("watts") * 0.5).where("fee > 40").count() == sum(lamp[3] > 80 for lamp in LAMPS)


def test_streets(typed):
    per = typed.groupBy("street").agg(
        F.count(F.lit(1)).alias("n"), F.sum("watts").alias("s"), F.avg("watts").alias("m"), F.max("watts").alias("x"))
    second = groups.nth_rows(typed, ["street"], [F.desc("watts")], 2).select("street", "lamp")
    found = {r["street"]: (r["n"], r["s"], r["m"], r["x"], r["lamp"]) for r in per.join(second, "street").collect()}
    expected = {}
    for street, own in by_street().items():
        watts = sorted((lamp[3], lamp[0]) for lamp in own)
        total = sum(w for w, _ in watts)
        expected[street] = (len(own), total, total / len(own), watts[-1][0], watts[-2][1])
    assert len(expected) == 4 and found == expected
    assert {r[0] for r in per.where("m > 70").collect()} == {s for s, row in expected.items() if row[2] > 70}


def test_group_maximum_on_every_row(typed):
    tops = groups.with_group_values(typed, ["street"], top=F.max("watts")).collect()
    assert len(tops) == len(LAMPS)
    assert all(r["top"] == max(lamp[3] for lamp in by_street()[r["street"]]) for r in tops)


def test_joins_with_streets(spark, lamps):
    streets = spark.createDataFrame([(s, f"name {s}") for s in by_street()], "s string, street_name string")
    same = lamps.street == streets.s
    assert lamps.join(streets, same).count() == lamps.join(streets, same, "left").count() == len(LAMPS)
    strict = joins.all_of(same, F.col("street") != "S0", F.col("watts").isNull())
    left = lamps.join(streets, strict, "left")
    assert left.count() == len(LAMPS) and left.where(F.col("street_name").isNotNull()).isEmpty()


def test_sums_pivot(spark):
    sales = [("shop", "tea", 4), ("shop", "tea", 3), ("shop", "rice", 9), ("kiosk", "rice", 1), ("van", "salt", 2)]
    df = spark.createDataFrame(sales, "place string, article string, crates int")
    expected = [("kiosk", 1, None, None), ("shop", 9, None, 7), ("van", None, 2, None)]
    for pivot in (df.groupBy("place").pivot("article"), df.groupBy("place").pivot("article", ["rice", "salt", "tea"])):
        assert sorted(map(tuple, pivot.agg(F.sum("crates")).collect())) == expected


def test_optional_fields_are_discovered_and_flattened(spark):
    texts = [
        '{"kind": "tram", "line": "7", "stops": ["dock", "mill"]}',
        '{"kind": "ferry", "stops": ["pier"], "deck": {"upper": "open", "lower": "cars"}}',
        '{"kind": "bus", "line": "12", "stops": []}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    parsed = df.select(json_columns.parse(F.col("raw"), json_columns.discover_ddl(df, "raw")).alias("data"))
    flat = flatten(parsed)
    assert set(flat.columns) == {"data_kind", "data_line", "data_stops", "data_deck_upper", "data_deck_lower"}
    assert {(r["data_kind"], r["data_line"], r["data_deck_lower"]) for r in flat.collect()} == {
        ("tram", "7", None), ("ferry", None, "cars"), ("bus", "12", None)}
    assert flat.select(F.explode("data_stops")).count() == 3


def test_lookup_with_a_missing_key(spark):
    boats = spark.createDataFrame([("gull", "h1"), ("tern", "h2"), ("auk", "h1"), ("rail", None)], "boat string, harbour string")
    depths = spark.createDataFrame([("h1", 12), ("h3", 30)], "k string, depth int")
    found = joins.lookup(boats, "harbour", depths, "k", "depth", "metres").collect()
    assert {(r["boat"], r["metres"]) for r in found} == {("gull", 12), ("tern", None), ("auk", 12), ("rail", None)}


def test_union_fills_what_either_side_lacks(spark):
    a = spark.createDataFrame([("x1", 2.5)], "id string, tons double")
    b = spark.createDataFrame([("x2", ["red", "dry"])], "id string, marks array<string>")
    both = a.unionByName(b, allowMissingColumns=True)
    assert [tuple(r) for r in both.orderBy("id").collect()] == [("x1", 2.5, None), ("x2", None, ["red", "dry"])]
    assert dict(both.dtypes)["marks"] == "array<string>"


def test_envelope_time_on_every_row(spark):
    reply = spark.createDataFrame([("t", [(1,), (2,)]), ("u", [])], "datetime string, data array<struct<id: int>>")
    assert [tuple(r) for r in envelope_rows(reply, "datetime").collect()] == [("t", 1), ("t", 2)]
