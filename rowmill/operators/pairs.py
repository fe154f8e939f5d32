"""Counting the pairs of a self-join without making them (J6, AGG13, PIP8).

A self-join on a shared key yields the square of every group.  What the analyses want from it is
how many pairs there are per pair of labels, and that follows from counts per (key, label).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.session import ship_package

# A group with more merged rows is counted by running sums per label where these are fewer than its pairs.
MANY_ROWS = 1 << 10
MOST_PAIRS = 1 << 20

# Above twice the number of century years without a leap day before the year 10,000, which is 75.
STEPS = 256


def _label_products(left: DataFrame, right: DataFrame, on: list[str], label: str) -> DataFrame:
    """Ordered label pairs and how many row pairs they stand for; rows are counts already."""
    return left.select(*on, F.col(label).alias("label_1"), F.col("n").alias("__n1")).join(
        right.select(*on, F.col(label).alias("label_2"), F.col("n").alias("__n2")), on
    ).select("label_1", "label_2", (F.col("__n1") * F.col("__n2")).alias("pairs"))


def _own_products(counts: DataFrame, on: list[str], label: str) -> DataFrame:
    """The label pairs of a table with itself, each made in one order and counted for both.

    NULL labels come before all others.
    """
    first, second = F.col("label_1"), F.col("label_2")
    products = _label_products(counts, counts, on, label).where(F.coalesce(first <= second, first.isNull()))
    return products.withColumn("pairs", F.col("pairs") * F.when(first.eqNullSafe(second), 1).otherwise(2))


def _unordered(ordered: DataFrame) -> DataFrame:
    return ordered.groupBy(
        F.least("label_1", "label_2").alias("label_1"),
        F.greatest("label_1", "label_2").alias("label_2"),
    ).agg(F.sum("pairs").alias("pairs"))


def label_pair_counts(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """J6 + AGG13: ordered row pairs sharing ``keys`` (a row with itself too), per label pair.

    No pair of rows is formed, only of a key's distinct labels, each in one order: as many as the key
    adds to, which is the result itself where there is one key.
    """
    counts = df.where(_known(keys)).groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    return _unordered(_own_products(counts, keys, label))


def banded_label_pair_counts(
    df: DataFrame, keys: list[str], label: str, position: Column, width: int, apart: str | None = None
) -> DataFrame:
    """The same for pairs whose integer positions lie less than ``width`` apart, and with ``apart`` only for
    pairs of rows that differ in that column.

    Rows are merged to (key, position, label) and their number first, in each task and after the shuffle, so a
    key of any size becomes as long as its positions and labels, however many rows it has.  A frame then
    moves over each key's positions: what a row pairs with are the rows of the frame before it.  Pairs that
    agree in ``apart`` are counted by the same pass over (key, apart) and taken off.
    """
    ship_package(df.sparkSession)
    own = F.lit(None).cast("boolean") if apart is None else F.col(apart)
    rows = df.where(_known(keys)).select(*keys, own.alias("__own"), F.col(label).alias("__label"), position.cast("bigint").alias("__pos"))
    rows = rows.where(F.col("__pos").isNotNull())
    if apart is not None:
        # Each row counts once for its key and once, with a sign, for what it shall not pair with.
        rows = rows.where(F.col("__own").isNotNull()).withColumn("__own", F.explode(F.array(F.lit(None), "__own")))
    counts = rows.groupBy(*keys, "__own", "__label", "__pos").agg(F.count(F.lit(1)).alias("n"))
    groups = [*keys, "__own"]
    dealt = counts.repartition(*groups).sortWithinPartitions(*groups, "__pos")
    kind = dealt.schema["__label"].dataType.simpleString()

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, len(groups)):
            labels = rows.column("__label").combine_chunks().dictionary_encode(null_encoding="encode")
            signs = np.where(rows.column("__own").is_null().to_numpy(), 1, -1)
            first, second, pairs = frame_products(
                group_numbers(rows, groups), rows.column("__pos").to_numpy(),
                labels.indices.to_numpy(zero_copy_only=False), rows.column("n").to_numpy(), width, signs,
            )
            yield pa.RecordBatch.from_arrays(
                [labels.dictionary.take(pa.array(first)), labels.dictionary.take(pa.array(second)), pa.array(pairs, pa.int64())],
                names=["label_1", "label_2", "pairs"],
            )

    products = dealt.mapInArrow(framed, f"label_1 {kind}, label_2 {kind}, pairs bigint")
    return _unordered(products).where(F.col("pairs") != 0)


def group_numbers(rows: pa.Table, groups: list[str]) -> np.ndarray:
    """A number for each run of rows that agree in ``groups``, NULL agreeing with NULL."""
    new = np.zeros(rows.num_rows, bool)
    for name in groups:
        codes = rows.column(name).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(new)


def whole_groups(batches: Iterator[pa.RecordBatch], width: int, least: int = 1 << 16) -> Iterator[pa.Table]:
    """Tables of about ``least`` rows of sorted batches that end where the first ``width`` columns change."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        if sum(table.num_rows for table in held) < least:
            continue
        rows = pa.concat_tables(held)
        numbers = group_numbers(rows, rows.column_names[:width])
        cut = int(np.searchsorted(numbers, numbers[-1]))
        if cut:
            yield rows.slice(0, cut)
        held = [rows.slice(cut)]
    if held:
        yield pa.concat_tables(held)


def frame_products(
    group: np.ndarray, position: np.ndarray, label: np.ndarray, n: np.ndarray, width: int, sign: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label pairs and how many ordered pairs of rows they stand for, from merged rows in the order of group
    and position; a group's pairs count with its sign."""
    labels = int(label.max(initial=-1)) + 1
    total: dict[int, int] = {}
    dense = np.zeros(labels * labels if labels <= MANY_ROWS else 0, np.int64)

    def add(one: np.ndarray, other: np.ndarray, pairs: np.ndarray) -> None:
        code = np.minimum(one, other).astype(np.int64) * labels + np.maximum(one, other)
        if len(dense):
            np.add.at(dense, code, pairs)
            return
        codes, place = np.unique(code, return_inverse=True)
        sums = np.zeros(len(codes), np.int64)
        np.add.at(sums, place, pairs)
        for code, pair in zip(codes.tolist(), sums.tolist(), strict=True):
            total[code] = total.get(code, 0) + pair

    add(label, label, sign * n * n)
    starts = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(group))
    # Where the frame of each row begins: the first row of its group less than ``width`` before it.
    since = np.empty(len(group), np.int64)
    for first, last in _frame_blocks(position, group, starts, ends, width):
        own = position[first:last] - position[first:last].min()
        lane = (group[first:last] - group[first]) * (own.max(initial=0) + width)
        since[first:last] = first + np.searchsorted(own + lane, own + lane - width, side="right")
    reach = np.arange(len(group)) - since
    crowded = np.zeros(len(group), bool)
    many = np.flatnonzero(ends - starts > MANY_ROWS)
    for first, last in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
        held = np.unique(label[first:last])
        if len(held) * (last - first) >= reach[first:last].sum():
            continue
        # Many rows of few labels: running sums for each label, at both ends of every frame.
        crowded[first:last] = True
        for other in held:
            before = np.concatenate([[0], np.cumsum(np.where(label[first:last] == other, n[first:last], 0))])
            inside = before[np.arange(last - first)] - before[since[first:last] - first]
            add(label[first:last], np.full(last - first, other), 2 * sign[first:last] * n[first:last] * inside)
    left = np.flatnonzero(~crowded & (reach > 0))
    upto = np.cumsum(reach[left])
    at = 0
    while at < len(left):
        # As many rows at a time as make MOST_PAIRS pairs of merged rows, one row at least.
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + MOST_PAIRS, side="right")))
        some = left[at:stop]
        one = np.repeat(some, reach[some])
        other = np.arange(len(one)) - np.repeat(np.cumsum(reach[some]) - reach[some], reach[some]) + np.repeat(since[some], reach[some])
        add(label[one], label[other], 2 * sign[one] * n[one] * n[other])
        at = stop
    if len(dense):
        codes = np.flatnonzero(dense)
        return codes // labels, codes % labels, dense[codes]
    codes = np.fromiter(total, np.int64, len(total))
    pairs = np.fromiter(total.values(), np.int64, len(total))
    return codes // max(labels, 1), codes % max(labels, 1), pairs


def _frame_blocks(
    position: np.ndarray, group: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int
) -> list[tuple[int, int]]:
    """Runs of whole groups whose positions, laid one group after the other, stay within 63 bits: all rows, or
    each group by itself where positions are too far apart for that."""
    if not len(group):
        return []
    span = int(position.max()) - int(position.min()) + width
    if span * len(starts) < 1 << 62:
        return [(0, len(group))]
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def years_position(date: Column, years: int) -> tuple[Column, int]:
    """Integer position of a date and the width for "fewer than ``years`` years apart".

    ``months_between`` calls 28 and 29 February whole years apart when both end their month, so
    unless the span is a multiple of four years the leap day counts as the 28th.  In a span of a
    multiple of four only a century year such as 1900 has no leap day: its 28th is a whole span after
    the 29th and a whole span before the 28th.  A day is then ``STEPS`` positions wide, and the
    28th and 29th of February move on by two of them with every such year a whole number of spans back.
    """
    day = F.dayofmonth(date)
    if years % 4:
        day = F.when((F.month(date) == 2) & (day == 29), F.lit(28)).otherwise(day)
        return (F.year(date) * 12 + F.month(date)) * 31 + day - 1, years * 12 * 31
    year = F.year(date)
    chain = F.sequence(F.pmod(year, F.lit(years)), year, F.lit(years))
    plain = F.size(F.filter(chain, lambda y: (y % 100 == 0) & (y % 400 != 0)))
    step = F.when(
        (F.month(date) == 2) & (day >= 28), (F.lit(28) - day) * STEPS + plain * 2 + F.when(day == 29, 1).otherwise(0)
    ).otherwise(0)
    return ((year * 12 + F.month(date)) * 31 + day - 1) * STEPS + step, years * 12 * 31 * STEPS


def _known(keys: list[str]) -> Column:
    """Join keys that can match at all."""
    known = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        known = known & F.col(key).isNotNull()
    return known
