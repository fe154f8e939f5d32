"""Pair counts against pairs made one by one, on keys of very uneven size."""

import datetime as dt
import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowmill.apps.siblings import sibling_title_pairs, title_summaries
from rowmill.operators import pairs
from rowmill.operators.pairs import banded_label_pair_counts, label_pair_counts, years_position


def ordered(a, b):
    known = [x for x in (a, b) if x is not None]
    return (min(known), max(known)) if known else (None, None)


def people(seed, n):
    """A third of the rows share one family; dates include leap days and month ends."""
    draw = random.Random(seed)
    special = [dt.date(2000, 2, 29), dt.date(1999, 2, 28), dt.date(2010, 2, 28), dt.date(1990, 1, 31), dt.date(2004, 2, 29)]
    rows = []
    for i in range(n):
        family = "hot" if draw.random() < 0.33 else draw.choice(["a", "b", "c", None])
        born = draw.choice(special) if draw.random() < 0.3 else dt.date(1950, 1, 1) + dt.timedelta(draw.randrange(22000))
        email = None if draw.random() < 0.05 else f"e{draw.randrange(n)}"
        rows.append((family, email, draw.choice(["cook", "pilot", "nurse"]), born))
    return rows


@pytest.mark.parametrize("seed,width", [(1, 1), (2, 7), (3, 64), (4, 1000)])
def test_banded_counts_equal_brute_force(spark, rows, seed, width):
    draw = random.Random(seed)
    data = [
        (draw.choice(["hot", "hot", "k1", "k2", None]), draw.choice("xyz"), draw.randrange(-3 * width, 5 * width))
        for _ in range(150)
    ]
    expected = Counter()
    for a, b in itertools.product(data, data):
        if a[0] is not None and a[0] == b[0] and abs(a[2] - b[2]) < width:
            expected[ordered(a[1], b[1])] += 1
    df = spark.createDataFrame(data, "k string, label string, pos int")
    found = banded_label_pair_counts(df, ["k"], "label", F.col("pos"), width)
    assert rows(found) == sorted(((*pair, n) for pair, n in expected.items()), key=repr)


@pytest.mark.parametrize("span,labels", [(300, "xy"), (40, "abcdefghijkl"), (5000, "x")])
def test_crowded_key_by_running_sums_equals_pairs(monkeypatch, spark, rows, span, labels):
    """A key with more merged rows than are paired one by one, and rows dealt out in small steps."""
    draw = random.Random(span)
    data = [("hot" if i % 3 else f"k{i % 7}", draw.choice([*labels, None]), draw.randrange(span)) for i in range(900)]
    expected = Counter()
    for a, b in itertools.product(data, data):
        if a[0] == b[0] and abs(a[2] - b[2]) < 17:
            expected[ordered(a[1], b[1])] += 1
    df = spark.createDataFrame(data, "k string, label string, pos int")
    ordinary = rows(banded_label_pair_counts(df, ["k"], "label", F.col("pos"), 17))
    assert ordinary == sorted(((*pair, n) for pair, n in expected.items()), key=repr)
    monkeypatch.setattr(pairs, "MANY_ROWS", 8)
    monkeypatch.setattr(pairs, "MOST_PAIRS", 50)
    merged = Counter((k, p, l) for k, l, p in data)
    order = sorted(merged, key=lambda m: (m[0], m[1], repr(m[2])))
    names = sorted({m[2] for m in order}, key=repr)
    codes = [np.array(list(c)) for c in zip(*[(["hot", *(f"k{i}" for i in range(7))].index(k), p, names.index(l), merged[k, p, l]) for k, p, l in order])]
    by_key = np.argsort(codes[0], kind="stable")
    one, other, counted = pairs.frame_products(*[c[by_key] for c in codes], 17, np.ones(len(order), np.int64))
    found = Counter()
    for i, j, n in zip(one, other, counted):
        found[ordered(names[i], names[j])] += int(n)
    assert found == expected


def test_positions_far_apart_do_not_overflow(spark, rows):
    data = [("k", "x", -(1 << 62)), ("k", "y", 1 << 61), ("k", "x", (1 << 61) + 3), ("l", "x", 5), ("l", "x", 5)]
    df = spark.createDataFrame(data, "k string, label string, pos bigint")
    assert rows(banded_label_pair_counts(df, ["k"], "label", F.col("pos"), 10)) == [("x", "x", 6), ("x", "y", 2), ("y", "y", 1)]
    assert rows(banded_label_pair_counts(df.where("false"), ["k"], "label", F.col("pos"), 10)) == []


def test_label_pairs_equal_brute_force(spark, rows):
    data = [("hot", None), ("hot", "x"), ("hot", "y"), ("hot", "y"), ("k", "x"), (None, "x")]
    expected = Counter()
    for a, b in itertools.product(data, data):
        if a[0] is not None and a[0] == b[0]:
            expected[ordered(a[1], b[1])] += 1
    df = spark.createDataFrame(data, "k string, label string")
    assert rows(label_pair_counts(df, ["k"], "label")) == sorted(((*p, n) for p, n in expected.items()), key=repr)


@pytest.mark.parametrize("years", [1, 4, 10])
def test_position_band_is_months_between(spark, years):
    """Every pair of a range of days around leap years, by both definitions."""
    days = [dt.date(y, m, d) for y in (1996, 1999, 2000, 2001, 2004, 2006, 2010) for m, d in
            ((1, 31), (2, 27), (2, 28), (3, 1), (3, 31), (12, 31))] + [dt.date(y, 2, 29) for y in (1996, 2000, 2004)]
    position, width = years_position(F.col("d"), years)
    df = spark.createDataFrame([(d,) for d in days], "d date").withColumn("p", position)
    both = df.alias("a").crossJoin(df.alias("b")).select(
        (F.abs(F.months_between("a.d", "b.d")) < years * 12).alias("months"),
        (F.abs(F.col("a.p") - F.col("b.p")) < width).alias("band"), "a.d", "b.d",
    )
    assert both.where("months <> band").collect() == []


@pytest.mark.parametrize("years", [4, 8, 100])
def test_position_band_across_centuries(spark, years):
    days = [dt.date(y, m, d) for y in (1796, 1800, 1804, 1892, 1896, 1900, 1904, 1908, 1996, 2000, 2004, 2096, 2100, 2104)
            for m, d in ((2, 27), (2, 28), (3, 1))]
    days += [dt.date(y, 2, 29) for y in (1796, 1804, 1892, 1896, 1904, 1908, 1996, 2000, 2004, 2096, 2104)]
    position, width = years_position(F.col("d"), years)
    df = spark.createDataFrame([(d,) for d in days], "d date").withColumn("p", position)
    both = df.alias("a").crossJoin(df.alias("b")).select(
        (F.abs(F.months_between("a.d", "b.d")) < years * 12).alias("months"),
        (F.abs(F.col("a.p") - F.col("b.p")) < width).alias("band"), "a.d", "b.d",
    )
    assert both.where("months <> band").collect() == []


def test_many_labels_of_one_key(spark):
    """Thousands of labels, one row each: each pair of labels once, counted both ways."""
    n = 1500
    counts = label_pair_counts(spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("label")), ["k"], "label")
    same = F.col("label_1") == F.col("label_2")
    found = counts.agg(F.count(F.lit(1)), F.sum("pairs"), F.sum(F.when(same, F.col("pairs")))).first()
    assert tuple(found) == (n * (n + 1) // 2, n * n, n)


def test_siblings_equal_self_join(spark, rows):
    data = people(5, 160)
    df = spark.createDataFrame(data, "last_name string, email string, job_title string, dob date")
    a, b = df.alias("a"), df.alias("b")
    joined = a.join(b, F.col("a.last_name") == F.col("b.last_name")).where(
        (F.col("a.email") != F.col("b.email")) & (F.abs(F.months_between("a.dob", "b.dob")) < 120)
    )
    expected = joined.groupBy(
        F.least("a.job_title", "b.job_title").alias("t1"), F.greatest("a.job_title", "b.job_title").alias("t2")
    ).count()
    found = sibling_title_pairs(df)
    assert rows(found, "pair_title_1", "pair_title_2", "count") == rows(expected)
    once = sibling_title_pairs(df, mirrored=False)
    assert rows(once, "pair_title_1", "pair_title_2", "count") == [(a, b, n // 2) for a, b, n in rows(expected)]
    summary = title_summaries(found, ["cook", "nurse"], "n").first()
    counts = {(t1, t2): n for t1, t2, n in rows(expected)}
    assert summary["title_pairs"] == len(counts)
    assert summary["same_title"] == sum(n for (x, y), n in counts.items() if x == y)
    assert summary["among_titles"] == sum(n for (x, y), n in counts.items() if {x, y} <= {"cook", "nurse"})
    assert summary["with_initial"] == sum(n for (x, _), n in counts.items() if x.startswith("n"))
