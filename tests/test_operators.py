"""Operators on small rows: goldens, two formulations of the same thing, and plan shapes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from rowmill.functions import arrays, dates, numbers, text, udfs
from rowmill.functions import json as json_columns
from rowmill.operators import groups, joins, layout, numbering, quality, radius
from rowmill.operators.columns import flatten, suffixed
from rowmill.registry import all_queries
from rowmill.session import session_settings
from rowmill.streaming import mobility

SF = "/root/testdata/sf0.001"


# --- columns and functions ---------------------------------------------------------------------

def test_flatten_quotes_odd_names(spark):
    df = spark.createDataFrame([((1, (2,)), [3])], "`a.b` struct<`x y`: int, n: struct<z: int>>, l array<int>")
    flat = flatten(df)
    assert flat.columns == ["a.b_x y", "a.b_n_z", "l"]
    assert tuple(flat.first()) == (1, 2, [3])


def test_suffixed(spark):
    assert suffixed(spark.range(1), "_1").columns == ["id_1"]


def test_dirty_values_become_null(spark):
    df = spark.createDataFrame([("",), ("x",), ("1.5",)], "v string")
    assert [r[0] for r in df.select(F.col("v").try_cast("double")).collect()] == [None, None, 1.5]
    one = spark.range(1)
    assert one.select(numbers.ratio(F.lit(1), F.lit(0))).first()[0] is None
    assert one.select(dates.date_from_parts(F.lit(2023), F.lit(2), F.lit(30))).first()[0] is None
    assert one.select(dates.date_from_parts(F.lit(2024), F.lit(2), F.lit(29))).first()[0] == dt.date(2024, 2, 29)
    assert one.select(dates.parse_date(F.lit("31-31-2020"), "MM-dd-yyyy")).first()[0] is None


def test_coordinates(spark):
    df = spark.createDataFrame([("-3.712.345",), ("40.41",), ("x",), (None,), ("95.1",)], "v string")
    assert [r[0] for r in df.select(text.repair_coordinate(F.col("v"), limit=90)).collect()] == [-3.712345, 40.41, None, None, None]


def test_pair_key_with_null_end(spark):
    df = spark.createDataFrame([("b", "a"), ("a", "b"), (None, "a")], "x string, y string")
    assert [r[0] for r in df.select(text.pair_key(F.col("x"), F.col("y"))).collect()] == ["a-b", "a-b", "a"]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(2.0,), (0.5,), (None,)], "v double")
    assert [r[0] for r in df.select(numbers.clamp_upper(F.col("v"))).collect()] == [1.0, 0.5, None]


def test_hour_distance_wraps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 0))], "a timestamp, b timestamp")
    assert df.select(dates.hour_distance(F.col("a"), F.col("b"))).first()[0] == 1
    assert df.select(dates.hour_distance(F.col("a"), F.col("b"), wrap=False)).first()[0] == 23


def test_root_step_forms_agree_at_squares(spark):
    df = spark.createDataFrame([(i,) for i in (0, 3, 4, 9, 10)] + [(None,)], "x bigint")
    found = df.select(udfs.root_step_python("x"), udfs.root_step_pandas("x"), udfs.root_step(F.col("x"))).collect()
    assert [tuple(r) for r in found] == [(1,) * 3, (2,) * 3, (3,) * 3, (4,) * 3, (4,) * 3, (None,) * 3]


def test_array_functions_on_empty_arrays(spark):
    df = spark.createDataFrame([([],), (["Ávila", "Rome"],), (None,)], "c array<string>")
    c = F.col("c")
    found = df.select(arrays.total_length(c), arrays.containing(c, "Ro"), arrays.any_longer(c, 4)).collect()
    assert [tuple(r) for r in found] == [(0, [], False), (9, ["Rome"], True), (None, None, None)]
    both = df.select(
        arrays.total_length(c) == udfs.total_length_udf(c), arrays.upper_all(c) == udfs.upper_all_udf(c),
        arrays.containing(c, "Ro") == udfs.containing_udf("Ro")(c), arrays.any_longer(c, 4) == udfs.any_longer_udf(4)(c),
    ).collect()
    assert {v for row in both for v in row} == {True, None}


def test_schema_discovery_reads_every_row(spark):
    texts = ['{"a": 1}'] * 500 + ['{"a": 2.5, "late": {"b": ["x"]}, "none": null}', "broken"]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    ddl = json_columns.discover_ddl(df, "j")
    parsed = df.select(json_columns.parse(F.col("j"), ddl).alias("s")).select("s.*")
    assert dict(parsed.dtypes) == {"a": "double", "late": "struct<b:array<string>>", "none": "string"}
    assert parsed.agg(F.sum("a")).first()[0] == 502.5


def test_schema_discovery_keeps_field_names(spark):
    texts = ['{"VOID": 1, "OBJECT<": {"DECIMAL(1,2)": 2.5}, "a`b": null}', None]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    parsed = df.select(json_columns.parse(F.col("j"), json_columns.discover_ddl(df, "j")).alias("s"))
    assert parsed.first()["s"].asDict(recursive=True) == {"VOID": 1, "OBJECT<": {"DECIMAL(1,2)": 2.5}, "a`b": None}
    none = spark.createDataFrame([(None,), ("broken",)], "j string")
    ddl = json_columns.discover_ddl(none, "j")
    assert none.select(json_columns.parse(F.col("j"), ddl).alias("s")).select("s.*").columns == []


# --- groups and windows -------------------------------------------------------------------------

def skewed(spark, n=600):
    draw = random.Random(3)
    data = [("hot" if i % 3 == 0 else draw.choice(["a", "b", None]), i, draw.choice([None, 1.0, 2.0, 4.0])) for i in range(n)]
    return spark.createDataFrame(data, "k string, i int, v double")


def test_group_values_equal_window(spark, rows):
    df = skewed(spark)
    window = df.withColumn("m", F.avg("v").over(Window.partitionBy("k")))
    assert rows(groups.with_group_values(df, ["k"], m=F.avg("v"))) == rows(window)


def test_fill_with_group_mean(spark, rows):
    df = skewed(spark)
    window = df.withColumn("v", F.coalesce("v", F.avg("v").over(Window.partitionBy("k"))))
    assert rows(groups.fill_with_group_mean(df, ["k"], "v")) == rows(window)


def test_latest_rows_equal_row_number(spark, rows):
    df = skewed(spark)
    number = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("i")))
    assert rows(groups.latest_rows(df, ["k"], ["i"])) == rows(df.withColumn("n", number).where("n = 1").drop("n"))


def test_latest_rows_settle_ties_and_copies(spark, rows):
    data = [("a", 1, "x", 5.0), ("a", 3, "y", 1.0), ("a", 3, "z", 2.0), ("a", 3, "z", 2.0), (None, None, "n", None),
            ("b", None, "p", 1.0), ("b", -1, "q", 2.0), ("c", 7, "r", 3.0), ("c", 7, "s", 3.0), ("c", 7, "r", 4.0)]
    df = spark.createDataFrame(data, "k string, i int, s string, v double")
    found = rows(groups.latest_rows(df, ["k"], ["i"]))
    assert len(found) == 4 and {(r[0], r[1]) for r in found} == {("a", 3), (None, None), ("b", -1), ("c", 7)}
    assert set(found) <= set(data) and rows(groups.latest_rows(df.repartition(7), ["k"], ["i"])) == found
    assert rows(groups.latest_rows(df, ["k"], ["i", "v"])) == sorted(
        [("a", 3, "z", 2.0), (None, None, "n", None), ("b", -1, "q", 2.0), ("c", 7, "r", 4.0)], key=repr)
    # Text cannot be held by a hash aggregate.
    assert ("a", 3, "z", 2.0) in rows(groups.latest_rows(df, ["k"], ["s"]))
    assert rows(groups.latest_rows(df.where("false"), ["k"], ["i"])) == []


def test_latest_rows_sort_no_whole_rows(spark):
    """No plan of the queries over latest rows has a sort-based aggregate."""
    held, real = [], groups.settle

    def noted(df, *args):
        held.append(layout.plan_text(df, "simple"))
        return real(df, *args)

    groups.settle = noted
    try:
        for name in ("win_latest", "agg_last"):
            held.append(layout.plan_text(all_queries()[name].run(spark, SF), "simple"))
    finally:
        groups.settle = real
    assert len(held) >= 4 and not any("SortAggregate" in plan for plan in held)


def test_nth_rows_limit_before_the_shuffle(spark):
    df = all_queries()["win_nth"].run(spark, SF)
    plan = layout.plan_text(df, "simple")
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:exchange] and "Partial" in plan[exchange:]


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_global_numbers(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % 1009).alias("v"), "id")
    found = numbering.global_row_numbers(df, [F.col("v"), F.col("id")]).collect()
    order = sorted(found, key=lambda r: (r["v"], r["id"]))
    assert [r["row_number"] for r in order] == list(range(1, n + 1))


def test_global_numbers_keep_their_parallelism(spark):
    """Only the offsets meet in one task; the rows are neither shuffled again nor sorted there."""
    numbered = numbering.global_row_numbers(spark.range(1000), [F.col("id")])
    plan = layout.plan_text(numbered, "simple")
    rows_side = plan[:plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in rows_side and "Exchange" not in rows_side


def test_unique_ids(spark):
    ids = numbering.unique_ids(spark.range(0, 1000, 1, 7))
    assert ids.select("row_id").distinct().count() == 1000


def test_split_is_stable_and_whole(spark):
    df = spark.range(5000)
    one = numbering.split(df, {"a": 0.55, "b": 0.45}, ["id"])
    two = numbering.split(df.repartition(13), {"a": 0.55, "b": 0.45}, ["id"])
    assert one.exceptAll(two).isEmpty()
    share = one.where("split = 'a'").count() / 5000
    assert 0.52 < share < 0.58
    assert numbering.bernoulli(df, 0.2, ["id"], 1).count() / 5000 == pytest.approx(0.2, abs=0.03)


# --- joins --------------------------------------------------------------------------------------

@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, rows, how):
    big = skewed(spark).where("k is not null or i < 50")
    small = spark.createDataFrame([("hot", 1), ("a", 2), ("z", 3)], "k string, w int")
    assert rows(joins.salted_join(big, small, "k", 5, ["i"], how)) == rows(big.join(small, "k", how))


def test_salted_join_broadcasts_no_repeated_side(spark):
    """However small its planned size: Catalyst does not count the copies."""
    small = spark.range(20).selectExpr("id as k", "id as w")
    plan = layout.plan_text(joins.salted_join(spark.range(100).selectExpr("id % 20 as k", "id as i"), small, "k", 8, ["i"]), "simple")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_join(spark, rows, how):
    big = skewed(spark)
    small = spark.createDataFrame([("hot", 1), ("hot", 5), ("a", 2), ("z", 3), (None, 4)], "k string, w int")
    found = joins.skew_join(big, small, "k", ["i"], how, parts=5)
    assert rows(found) == rows(big.join(small, "k", how))
    assert "hot" in {r.k: r["__salts"] for r in joins.key_salts(big, "k", 5).collect() if r["__salts"] > 1}
    assert rows(joins.skew_join(big.where("false"), small, "k", ["i"], how)) == []


def test_skew_join_balances_a_left_join_of_mostly_null_keys(spark, rows):
    """90 % of the rows have no key and go around the shuffle; one key holds 30 % of the others."""
    n = 40_000
    share = F.pmod(F.xxhash64("i"), F.lit(1000))
    key = F.when(share < 900, None).when(share < 930, F.lit(-1)).otherwise(F.col("i"))
    big = spark.range(n).withColumnRenamed("id", "i").select(key.alias("k"), "i")
    small = spark.range(-1, n).selectExpr("id as k", "id * 2 as w")
    found = joins.skew_join(big, small, "k", ["i"], "left", parts=8)
    assert rows(found) == rows(big.join(small, "k", "left"))
    known = big.where("k is not null")
    salted = known.join(joins.key_salts(big, "k", 8), "k", "left").withColumn(
        "salt", F.pmod(F.xxhash64("i"), F.coalesce("__salts", F.lit(1)))
    )
    parts = salted.repartition(8, "k", "salt").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) <= 2 * known.count() / 8
    with session_settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        plan = layout.plan_text(joins.skew_join(big, small, "k", ["i"], "left", parts=8), "simple")
    # The branch of the rows without a key, the last one of the union, reads them and shuffles nothing.
    assert "Union" in plan and "Exchange" not in plan[plan.rindex("null AS w#"):]


def test_salts_spread_the_hot_key(spark):
    """The hot key's rows go to several tasks, in near equal parts."""
    big = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    salt = F.pmod(F.xxhash64("id"), F.lit(8))
    sizes = [r["count"] for r in big.where("k = 0").groupBy(salt).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_salt_refuses_other_joins(spark):
    with pytest.raises(ValueError):
        joins.skew_join(spark.range(1), spark.range(1), "id", ["id"], "full")
    with pytest.raises(ValueError):
        joins.salted_join(spark.range(1), spark.range(1), "id", 2, ["id"], "full")


def test_broadcast_only_within_the_bound(spark):
    left = spark.read.parquet(f"{SF}/lineitem.parquet")
    right = spark.read.parquet(f"{SF}/part.parquet").withColumnRenamed("p_partkey", "l_partkey")
    hinted = joins.join_small(left, right, "l_partkey")._jdf.queryExecution().analyzed().toString()
    plain = joins.join_small(left, right, "l_partkey", max_bytes=10)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in hinted and "strategy=broadcast" not in plain


def test_bucketed_join_has_no_exchange_below_it(spark):
    plan = layout.plan_text(all_queries()["join_bucketed"].run(spark, SF), "simple")
    assert "Exchange" not in plan[plan.index("SortMergeJoin"):]


def test_radius_join_equals_theta_join(spark, rows):
    draw = random.Random(9)
    points = [(i, draw.uniform(-3.72, -3.68), draw.uniform(40.38, 40.42)) for i in range(60)]
    readings = [(i, draw.uniform(-3.73, -3.67), draw.uniform(40.37, 40.43)) for i in range(400)]
    readings += [(1000 + i, points[0][1], points[0][2]) for i in range(200)]  # one crowded cell
    p = spark.createDataFrame(points, "id int, longitude double, latitude double")
    r = spark.createDataFrame(readings, "r int, longitude double, latitude double")
    near = radius.planar_distance(F.col("p.longitude") - F.col("r.longitude"), F.col("p.latitude") - F.col("r.latitude")) < 0.0045
    expected = rows(p.alias("p").join(r.alias("r"), near).select("p.id", "r.r"))
    assert len(expected) > 200
    for salts in (1, 3):
        assert rows(radius.radius_join(p, r, salts=salts), "point_id", "r") == expected
    for most in (1, 3, 1000):
        leaves = radius.crowded_cells(r, most)
        assert rows(radius.radius_join(p, r, crowded=leaves), "point_id", "r") == expected
    assert "Cartesian" not in layout.plan_text(radius.radius_join(p, r), "simple")
    assert "NestedLoop" not in layout.plan_text(radius.radius_join(p, r), "simple")


def test_crowded_cell_is_divided_without_salts(spark, rows):
    """One cell holds nearly all readings: both sides are keyed by leaves, and no leaf keeps more than asked for."""
    draw = random.Random(12)
    crowd = [(i, 0.001 + draw.random() * 0.004, 0.001 + draw.random() * 0.003) for i in range(3000)]
    far = [(10_000 + i, draw.uniform(1, 2), draw.uniform(1, 2)) for i in range(100)]
    r = spark.createDataFrame(crowd + far, "r int, longitude double, latitude double")
    p = spark.createDataFrame([(i, draw.uniform(-0.006, 0.012), draw.uniform(-0.006, 0.01)) for i in range(60)], "id int, longitude double, latitude double")
    leaves = radius.crowded_cells(r, 200)
    held = leaves.collect()
    assert len(held) == 1 and held[0]["__level"] >= 2 and held[0]["__salts"] == 1
    near = radius.planar_distance(F.col("p.longitude") - F.col("r.longitude"), F.col("p.latitude") - F.col("r.latitude")) < 0.0045
    expected = rows(p.alias("p").join(r.alias("r"), near).select("p.id", "r.r"))
    joined = radius.radius_join(p, r, crowded=leaves)
    assert rows(joined, "point_id", "r") == expected
    with session_settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = layout.plan_text(radius.radius_join(p, r, crowded=leaves), "simple")
    dealt = plan[plan.index("SortMergeJoin"):]
    assert "__i" in dealt.split("]")[0] and "__j" in dealt.split("]")[0] and "Cartesian" not in plan
    # One place that sends everything can't be divided: it is dealt among salts.
    same = spark.createDataFrame([(i, 0.5, 0.5) for i in range(900)], "r int, longitude double, latitude double")
    assert [(x["__level"], x["__salts"]) for x in radius.crowded_cells(same, 100).collect()] == [(radius.LEVELS, 9)]
    spot = spark.createDataFrame([(1, 0.5, 0.501)], "id int, longitude double, latitude double")
    assert radius.radius_join(spot, same, crowded=radius.crowded_cells(same, 100)).count() == 900
    assert radius.crowded_cells(r.where("false"), 5).count() == 0


def test_points_are_broadcast_by_their_size_after_the_copies(spark):
    """Points that Catalyst would broadcast are not, once they are nine times as many."""
    p = spark.range(3000).selectExpr("id", "id * 0.01 as longitude", "id * 0.01 as latitude")
    r = spark.range(10).selectExpr("id as r", "id * 0.01 as longitude", "id * 0.01 as latitude")
    size = layout.plan_bytes(p)
    with session_settings(spark, spark__sql__autoBroadcastJoinThreshold=size * 4):
        assert "SortMergeJoin" in layout.plan_text(radius.radius_join(p, r), "simple")
    with session_settings(spark, spark__sql__autoBroadcastJoinThreshold=size * 40):
        assert "BroadcastHashJoin" in layout.plan_text(radius.radius_join(p, r), "simple")


def test_measured_sizes(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").repartition(8)
    cached, sampled = layout.cached_bytes(lines), layout.sampled_bytes(lines, 0.3)
    assert cached > 0 and abs(sampled - cached) < 0.25 * cached
    assert lines.storageLevel.useMemory is False
    kept = lines.limit(50).persist()
    try:
        assert 0 < layout.cached_bytes(kept) < cached and kept.is_cached
    finally:
        kept.unpersist()
    assert layout.sampled_bytes(lines.where("false"), 0.5) == 0
    assert layout.sampled_bytes(spark.createDataFrame([(1,)], "a int"), 1e-6) > 0
    assert layout.advised_partitions(lines, 1000, size_bytes=4001) == 5
    with pytest.raises(ValueError):
        layout.sampled_bytes(lines, 0.0)
    small = spark.createDataFrame([(1,)], "l_orderkey bigint")
    with session_settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert "Broadcast" in layout.plan_text(joins.join_small(lines, small, "l_orderkey", size_bytes=10), "simple")
        assert "Broadcast" not in layout.plan_text(joins.join_small(lines, small, "l_orderkey", size_bytes=1 << 40), "simple")


def test_fusion_golden(spark, rows):
    points = spark.createDataFrame([(1, "A", 0.0, 0.0), (2, "B", 0.5, 0.001)], "id int, name string, longitude double, latitude double")
    data = [(0.5, 0.001, 0.0), (0.7, 0.004, 0.0), (None, 0.0, 0.0), (0.9, 0.5, 0.0)]
    readings = spark.createDataFrame(data, "occupancy double, longitude double, latitude double")
    for fused in (mobility.fuse(points, [readings]), mobility.fuse_table(points, readings)):
        found = {name: value for name, value in rows(fused, "name", "occupancy")}
        assert found == {"A": pytest.approx(0.6), "B": pytest.approx(0.9)}


def test_compound_on_keeps_every_left_row(spark):
    crates = spark.createDataFrame([(1, "north", 2.5), (2, "north", 9.0), (3, "south", 9.5), (4, None, 9.9)], "crate int, dock string, tons double")
    docks = spark.createDataFrame([("north", 8.0), ("south", 20.0)], "name string, crane double")
    on = joins.all_of(crates.dock == docks.name, crates.tons > docks.crane)
    assert [r["crane"] for r in crates.join(docks, on, "left").orderBy("crate").collect()] == [None, 8.0, None, None]


def test_range_join_golden(spark):
    """Multiples of 21 below 1,000, as the common ids of the multiples of 3 and of 7."""
    common = spark.range(0, 1000, 3).repartition(4).join(spark.range(0, 1000, 7).repartition(9), "id")
    assert tuple(common.agg(F.count(F.lit(1)), F.sum("id")).first()) == (48, 21 * 47 * 48 // 2)


# --- aggregation --------------------------------------------------------------------------------

def test_pivot_finds_the_listed_values(spark):
    """Litres of milk per stall and weekday, one stall closed on a day."""
    sold = [("hill", "mon", 40), ("hill", "mon", 2), ("hill", "sat", 75), ("mill", "sat", 9), ("mill", None, 1)]
    milk = spark.createDataFrame(sold, "stall string, day string, litres int").groupBy("stall")
    listed = milk.pivot("day", ["mon", "sat"]).agg(F.sum("litres"))
    assert sorted(map(tuple, listed.collect())) == [("hill", 42, 75), ("mill", None, 9)]
    found = milk.pivot("day").agg(F.sum("litres"))
    assert sorted(tuple(r[c] for c in ("stall", "mon", "sat")) for r in found.collect()) == [("hill", 42, 75), ("mill", None, 9)]


def test_group_total_reuses_the_group_sums(spark):
    plan = layout.plan_text(all_queries()["agg_sums"].run(spark, SF), "simple")
    assert "Expand" not in plan


# --- quality ------------------------------------------------------------------------------------

PARCELS = [("p1", 120, "fragile"), ("p2", 75, ""), ("p3", None, "heavy"), ("p4", None, None), ("p5", 0, " ")]
RULES = [{"field": "label", "validations": ["notEmpty"]}, {"field": "grams", "validations": ["notNull"]}]


def test_validation_names_every_broken_rule(spark):
    ok, ko = quality.validate_fields(spark.createDataFrame(PARCELS, "parcel string, grams int, label string"), RULES)
    assert sorted(r["parcel"] for r in ok.collect()) == ["p1", "p5"]
    assert {r["parcel"]: r["failed_validations"] for r in ko.collect()} == {
        "p2": "notEmpty validation failed for label",
        "p3": "notNull validation failed for grams",
        "p4": "notEmpty validation failed for label,notNull validation failed for grams",
    }


def test_unknown_step_raises(spark):
    with pytest.raises(ValueError):
        quality.transform_frames({"a": spark.range(1)}, [{"name": "x", "type": "guess", "params": {"input": "a"}}])


# --- layout -------------------------------------------------------------------------------------

def test_bytes_and_advice(spark):
    assert [layout.parse_bytes(t) for t in ("134217728b", "128m", "64KB", "2g", "7")] == [
        134217728, 128 << 20, 64 << 10, 2 << 30, 7]
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert layout.advised_partitions(df, layout.plan_bytes(df)) == 1
    assert layout.advised_partitions(df, layout.plan_bytes(df) // 4) in (4, 5)


def test_cached_rows_are_released(spark):
    kept = spark.range(10).cache()
    kept.count()
    assert "InMemoryTableScan" in layout.plan_text(kept.where("id > 3"))
    layout.release_all(spark)
    assert "InMemoryTableScan" not in layout.plan_text(spark.range(10).where("id > 3"))
    assert not kept.storageLevel.useMemory


def test_scan_is_pruned_and_pushed(spark):
    plan = layout.plan_text(all_queries()["src_parquet_pruned"].run(spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan


def test_same_plan_for_equal_forms(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    forms = [orders.filter("o_totalprice > 5"), orders.where(F.col("o_totalprice") > 5)]
    assert forms[0].sameSemantics(forms[1])
