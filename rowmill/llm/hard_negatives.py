"""Hard negatives by angular triangle filtering.

Every row stores its angles to a few reference directions.  The angle between two rows is at least
the difference of their angles to a direction and at most their sum, so each direction gives an
interval of cosines; multiplied by both norms and widened for rounding it bounds the integer score.
Rows lie in windows of similar angles, and only windows whose bounds reach what an anchor looks for
are scored, in whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.blocks import unload
from rowmill.session import settle, ship_package

DIRECTIONS = 16
# Rows among which the directions are picked; they decide what is skipped, never what is found.
SAMPLE = 1024
# Rows that a task holds at a time, rows in a window, anchors that meet them together.
HELD, WINDOW, BATCH = 65_536, 256, 1024
LEAST_HELD = 1024
# Summaries of groups are broadcast up to this size; beyond it every anchor meets every group.
SUMMARY_BYTES = 32 << 20
# Angles and cosines are stored as 32-bit numbers; bounds are widened by more than their rounding.
SLACK = 1e-5
NONE = -np.iinfo(np.int64).max


def mixed_label(key: Column, label: Column) -> Column:
    """The label, moved on by one modulo 10 where the key is divisible by 7."""
    number = label.cast("long")
    return F.when(key % 7 == 0, (number + 1) % 10).otherwise(number)


def whole_components(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component, NULL where one of them is NULL or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


def _directions(sample: np.ndarray) -> np.ndarray:
    """Unit vectors far from each other: each next row is the one least like those picked before."""
    norms = np.linalg.norm(sample, axis=1)
    unit = sample[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    picked, nearest = [0], unit @ unit[0]
    while len(picked) < min(DIRECTIONS, len(unit)):
        picked.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[picked[-1]])
    return unit[picked]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors end in zeros."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return values.reshape(len(column), dim)
    out = np.zeros((len(column), dim), np.int64)
    out[np.repeat(np.arange(len(column)), lengths), np.concatenate([np.arange(n) for n in lengths])] = values
    return out


def _packed(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


class Rows:
    """Rows of one group or a batch of anchors: keys, labels, components, norms and angles."""

    def __init__(self, batch: pa.RecordBatch, dim: int, directions: int, exact: str):
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        self.key = column("key").to_numpy(zero_copy_only=False)
        self.label = column("label").to_numpy(zero_copy_only=False)
        self.values = _packed(column("q"), "<i8", dim).astype(exact)
        self.norm = column("norm").to_numpy(zero_copy_only=False)
        self.angles = _packed(column("angles"), "<f4", directions).astype(np.float64)
        self.goals = column("goals").to_pylist()

    def scores(self, which: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Integer inner products; ``exact`` was chosen so that none of them is rounded."""
        found = self.values[which] @ values.T
        return found if found.dtype == np.int64 else np.rint(found).astype(np.int64)


def score_bounds(
    angles: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds on the scores of anchors (rows) with the rows of windows (columns) whose
    angles to each direction lie in [low, high] and norms in [least, most]."""
    apart = np.zeros((len(norm), len(least)))
    upto = np.full((len(norm), len(least)), np.pi)
    for i in range(angles.shape[1]):
        own = angles[:, i, None]
        apart = np.maximum(apart, np.maximum(low[None, :, i] - own, own - high[None, :, i]))
        together = own + high[None, :, i]
        # Past a half turn the sum bounds the angle from the other side.
        upto = np.minimum(upto, np.minimum(together, np.where(own + low[None, :, i] >= np.pi, 2 * np.pi - own - low[None, :, i], np.pi)))
    best = np.cos(np.clip(apart - SLACK, 0, np.pi)) + SLACK
    worst = np.cos(np.clip(upto + SLACK, 0, np.pi)) - SLACK
    upper = norm[:, None] * np.where(best > 0, most[None, :], least[None, :]) * best
    lower = norm[:, None] * np.where(worst > 0, least[None, :], most[None, :]) * worst
    return lower - 1, upper + 1


class Windows:
    """Runs of a group's rows, in the order of their angles, and the ranges of these."""

    def __init__(self, rows: Rows):
        self.rows = rows
        self.starts = np.arange(0, len(rows.key), WINDOW)
        reduced = lambda f, values: f.reduceat(values, self.starts, axis=0)
        self.low, self.high = reduced(np.minimum, rows.angles), reduced(np.maximum, rows.angles)
        self.least, self.most = reduced(np.minimum, rows.norm), reduced(np.maximum, rows.norm)

    def bounds(self, anchors: Rows) -> tuple[np.ndarray, np.ndarray]:
        return score_bounds(anchors.angles, anchors.norm, self.low, self.high, self.least, self.most)

    def __iter__(self) -> Iterator[tuple[int, slice]]:
        return ((i, slice(start, start + WINDOW)) for i, start in enumerate(self.starts))


def _first(place: np.ndarray, score: np.ndarray, key: np.ndarray, most: int) -> np.ndarray:
    """Indices of the ``most`` first of every place: highest score, then smallest key."""
    order = np.lexsort((key, -score, place))
    place = place[order]
    begins = np.searchsorted(place, place, side="left")
    return order[np.arange(len(order)) - begins < most]


class Best:
    """The ``most`` best (score, key) of each of ``n`` places so far; NONE where there are fewer."""

    def __init__(self, n: int, most: int):
        self.score = np.full((n, most), NONE, np.int64)
        self.key = np.full((n, most), np.iinfo(np.int64).max, np.int64)

    def add(self, place: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        most = self.score.shape[1]
        better = (score > self.score[place, -1]) | ((score == self.score[place, -1]) & (key < self.key[place, -1]))
        place, score, key = place[better], score[better], key[better]
        if not len(place):
            return
        touched = np.unique(place)
        place = np.concatenate([place, np.repeat(touched, most)])
        score = np.concatenate([score, self.score[touched].ravel()])
        key = np.concatenate([key, self.key[touched].ravel()])
        kept = _first(place, score, key, most)
        self.score[touched] = score[kept].reshape(-1, most)
        self.key[touched] = key[kept].reshape(-1, most)


def _find_positives(windows: Windows, anchors: Rows, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, score, key) of each anchor's best rows of its label in this group, its own key aside."""
    best = Best(len(anchors.key), most)
    _, upper = windows.bounds(anchors)
    spans = dict(windows)
    for w in np.argsort(-upper.max(axis=0), kind="stable"):
        live = np.flatnonzero(upper[:, w] >= best.score[:, -1])
        if not len(live):
            continue
        at = spans[w]
        scores = anchors.scores(live, windows.rows.values[at])
        keys, labels = windows.rows.key[at], windows.rows.label[at]
        fits = (keys[None, :] != anchors.key[live, None]) & (labels[None, :] == anchors.label[live, None])
        i, j = np.nonzero(fits & (scores >= best.score[live, -1][:, None]))
        best.add(live[i], scores[i, j], keys[j])
    i, j = np.nonzero(best.score != NONE)
    yield i, np.zeros(len(i), np.int64), best.score[i, j], best.key[i, j]


def _find_negatives(windows: Windows, anchors: Rows, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, goal, score, key) of the best rows of other labels whose scores lie in each goal."""
    goals = max((len(g) for g in anchors.goals), default=0)
    low, high = np.full((len(anchors.key), goals), 1, np.int64), np.full((len(anchors.key), goals), 0, np.int64)
    for i, own in enumerate(anchors.goals):
        for k, goal in enumerate(own):
            low[i, k], high[i, k] = goal["low"], goal["high"]
    open_ = low <= high
    wanted = open_.any(axis=1)
    least = np.where(open_, low, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
    top = np.where(open_, high, NONE).max(axis=1, initial=NONE)
    best = Best(len(anchors.key) * goals, most)
    lower, upper = windows.bounds(anchors)
    spans = dict(windows)
    for w in np.argsort(-upper.max(axis=0), kind="stable"):
        # Below the third best of every goal nothing counts any more.
        full = np.where(open_, best.score[:, -1].reshape(-1, goals), np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        floor = np.maximum(least, full)
        live = np.flatnonzero(wanted & (upper[:, w] >= floor) & (lower[:, w] <= top))
        if not len(live):
            continue
        at = spans[w]
        scores = anchors.scores(live, windows.rows.values[at])
        keys, labels = windows.rows.key[at], windows.rows.label[at]
        inside = (scores >= floor[live, None]) & (scores <= top[live, None]) & (labels[None, :] != anchors.label[live, None])
        i, j = np.nonzero(inside)
        found, key = scores[i, j], keys[j]
        for k in range(goals):
            fits = (found >= low[live[i], k]) & (found <= high[live[i], k])
            best.add(live[i][fits] * goals + k, found[fits], key[fits])
    i, j = np.nonzero(best.score != NONE)
    if goals:
        yield i // goals, i % goals, best.score[i, j], best.key[i, j]


def _meet(stored: DataFrame, anchors: DataFrame, find: Callable, most: int, shape: tuple[int, int, str]) -> DataFrame:
    """(anchor, goal, score, key): ``find`` over every anchor and the rows of the group it was sent to.

    A task holds the rows of one group and lets the group's anchors pass, BATCH at a time, so however
    many anchors there are it holds no more of them.
    """
    dim, directions, exact = shape
    parts = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = stored.withColumn("anchor", F.lit(False)).unionByName(anchors.withColumn("anchor", F.lit(True)))
    dealt = both.repartition(parts, "group").sortWithinPartitions("group", "anchor", "cell", "order", "key")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        held: list[pa.RecordBatch] = []
        group, windows = None, None
        for batch in batches:
            kinds = batch.column(batch.schema.get_field_index("anchor")).to_numpy(zero_copy_only=False)
            groups = batch.column(batch.schema.get_field_index("group")).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(groups) != 0) | (np.diff(kinds.astype(np.int8)) != 0)) + 1
            for first, last in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                part = batch.slice(first, last - first)
                if groups[first] != group:
                    group, held, windows = groups[first], [], None
                if not kinds[first]:
                    held.append(part)
                    continue
                if windows is None:
                    if not held:
                        continue
                    table = pa.Table.from_batches(held).combine_chunks().to_batches()
                    windows, held = Windows(Rows(table[0], dim, directions, exact)), []
                for at in range(0, part.num_rows, BATCH):
                    own = Rows(part.slice(at, BATCH), dim, directions, exact)
                    for place, goal, score, key in find(windows, own, most):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own.key[place]), pa.array(goal), pa.array(score), pa.array(key)],
                            names=["anchor", "goal", "score", "key"],
                        )

    return dealt.mapInArrow(met, "anchor long, goal long, score long, key long")


def _numbered(rows: DataFrame, by: str, held: int) -> DataFrame:
    """``rows`` with a ``group``: those of equal ``by``, dealt by key into parts of about ``held`` rows."""
    parts = settle(rows.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / held).alias("parts")), "parts")
    part = F.pmod(F.xxhash64("key"), F.col("parts"))
    return rows.join(parts, by).withColumn("group", F.xxhash64(by, part)).drop("parts")


def mine(
    vectors: DataFrame, key: str, label: str, vector: str, anchors: Column,
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vector`` holds whole numbers; the score of two rows is their inner product, higher first, ties by
    smaller key.  An anchor's positives are its first ``positives`` rows of the same label with another key;
    for each, the first ``negatives`` rows of other labels with ``low`` * positive <= 100 * negative <=
    ``high`` * positive are returned.  Rows with a NULL key, label or vector take no part.  Rows that repeat
    with key, label and vector count once; of a key with unlike rows each one counts, but only the first of
    them, by label and then by its bytes, is an anchor.  Shorter vectors count
    as ending in zeros.  An empty table gives no rows, other columns are not read.  Vectors whose scores could
    pass 2**56 raise an error, since a hundred times a score must fit in 63 bits.

    Rows are dealt twice into groups of at most about HELD: by label for positives, by nearest direction
    for negatives; an anchor is sent to the groups that its bounds reach.  So a hot label or a vector that
    owns a third of the table fills many groups, and no pair is written but those found.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    taken = vectors.select(
        F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.col(vector).alias("q"),
        anchors.alias("is_anchor"),
    ).where("key is not null and label is not null and q is not null").dropDuplicates()
    taken = settle(taken, "vectors")
    size = F.coalesce(F.array_max(F.transform("q", lambda x: F.abs(x))), F.lit(0))
    n, dim, largest = taken.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    dim = max(dim, 1)
    most = dim * largest**2
    if most >= 1 << 56:
        raise ValueError("scores of these vectors could pass 2**56")
    # The sums of products are whole numbers, exact in the type that holds the largest of them.
    exact = "float32" if most < 1 << 24 else "float64" if most < 1 << 53 else "int64"
    sample = taken.orderBy(F.xxhash64("key", "label"), "key").limit(SAMPLE).select("q").toArrow().column("q").combine_chunks()
    sample = sample if isinstance(sample, pa.Array) else sample.chunk(0)
    directions = _directions(_matrix(sample, dim).astype(float)) if n else np.zeros((0, dim))
    width = len(directions)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column(2), dim)
            norm = np.sqrt((q.astype(float) ** 2).sum(axis=1))
            cosine = np.clip(q @ directions.T / np.maximum(norm, 1e-300)[:, None], -1, 1)
            angles = np.arccos(cosine).astype("<f4")
            cell = angles.argmin(axis=1) if width else np.zeros(len(q), np.int64)
            order = angles[np.arange(len(q)), cell] if width else np.zeros(len(q), "f4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([row.tobytes() for row in q.astype("<i8")], pa.binary()),
                 batch.column(3), pa.array(norm), pa.array([row.tobytes() for row in angles], pa.binary()),
                 pa.array(cell.astype(np.int64)), pa.array(order.astype(float))],
                names=["key", "label", "q", "is_anchor", "norm", "angles", "cell", "order"],
            )

    kept = settle(taken.mapInArrow(
        measured, "key long, label long, q binary, is_anchor boolean, norm double, angles binary, cell long, order double"
    ), "angles")
    shape = (dim, width, exact)
    # Enough groups for every task, and never more rows in one than a task may hold.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = min(HELD, max(LEAST_HELD, -(-n // tasks)))
    no_goals = F.array().cast("array<struct<low:long,high:long>>").alias("goals")
    columns = ["key", "label", "q", "norm", "angles", "cell", "order"]
    own_row = F.min(F.struct("label", "q", "norm", "angles", "cell", "order")).alias("row")
    looking = settle(kept.where("is_anchor").groupBy("key").agg(own_row).select("key", "row.*"), "anchors")

    by_label = settle(_numbered(kept, "label", held).select(*columns, no_goals, "group"), "by-label")
    own_groups = settle(by_label.select("label", "group").distinct(), "label-groups")
    sent = looking.select(*columns, no_goals).join(own_groups, "label").select(*columns, "goals", "group")
    found = settle(_meet(by_label, sent, _find_positives, positives, shape), "positive-candidates")
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "key")))
    chosen = found.groupBy("anchor").agg(F.slice(best, 1, positives).alias("best"))
    hundredths = lambda x: F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100)).cast("long")
    goal = lambda p: F.struct(
        hundredths(99 - p["minus"] * low).alias("low"), hundredths(-p["minus"] * high).alias("high")
    )
    chosen = settle(chosen.withColumn("goals", F.transform("best", goal)), "positives")

    by_cell = settle(_numbered(kept, "cell", held).select(*columns, no_goals, "group"), "by-cell")
    searching = looking.select(*columns).join(chosen.withColumnRenamed("anchor", "key").select("key", "goals"), "key")
    sent = _reached(searching, by_cell, shape)
    found = settle(_meet(by_cell, sent.select(*columns, "goals", "group"), _find_negatives, negatives, shape), "negative-candidates")
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "key")))
    ranked = found.groupBy("anchor", "goal").agg(F.slice(best, 1, negatives).alias("found"))
    ranked = ranked.select("anchor", "goal", F.posexplode("found").alias("rank", "negative"))
    named = ranked.join(chosen.select("anchor", "best"), "anchor").withColumn("positive", F.col("best")[F.col("goal").cast("int")])
    return named.select(
        F.col("anchor").alias("anchor_id"), F.col("positive.key").alias("positive_id"), (F.col("rank") + 1).cast("int").alias("rank"),
        F.col("negative.key").alias("negative_id"), (-F.col("positive.minus")).alias("positive_score"),
        (-F.col("negative.minus")).alias("negative_score"),
    )


def _reached(anchors: DataFrame, rows: DataFrame, shape: tuple[int, int, str]) -> DataFrame:
    """``anchors`` once for every group of ``rows`` in which a score may lie in one of its goals.

    The groups' ranges of angles and norms, one row per some ten thousand rows, are broadcast where their
    size is below SUMMARY_BYTES; otherwise anchors go to all groups, whose windows are checked there.
    """
    dim, directions, _ = shape

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, place = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            angles, norm = _packed(batch.column(1), "<f4", directions), batch.column(2).to_numpy()
            low, high = np.full((len(groups), directions), 4, "f4"), np.zeros((len(groups), directions), "f4")
            least, most = np.full(len(groups), np.inf), np.zeros(len(groups))
            np.minimum.at(low, place, angles)
            np.maximum.at(high, place, angles)
            np.minimum.at(least, place, norm)
            np.maximum.at(most, place, norm)
            listed = lambda values: pa.array(values.astype(float).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups), listed(low), listed(high), pa.array(least), pa.array(most)],
                names=["group", "low", "high", "least", "most"],
            )

    ranges = rows.select("group", "angles", "norm").mapInArrow(
        ranged, "group long, low array<double>, high array<double>, least double, most double"
    )
    each = [f(F.get(name, F.lit(i))).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(directions)]
    ranges = settle(ranges.groupBy("group").agg(*each, F.min("least").alias("least"), F.max("most").alias("most")), "ranges")
    if ranges.count() * (2 * directions + 3) * 8 > SUMMARY_BYTES:
        return anchors.withColumn("one", F.lit(1)).join(ranges.select("group", F.lit(1).alias("one")), "one").drop("one")
    table = ranges.toPandas()
    groups = table["group"].to_numpy(np.int64)
    low, high = (table[[f"{name}{i}" for i in range(directions)]].to_numpy(float) for name in ("low", "high"))
    least, most = table["least"].to_numpy(float), table["most"].to_numpy(float)

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                column = lambda name: batch.column(batch.schema.get_field_index(name))
                angles = _packed(column("angles"), "<f4", directions).astype(float)
                lower, upper = score_bounds(angles, column("norm").to_numpy(), low, high, least, most)
                meets = np.zeros(lower.shape, bool)
                for i, goals in enumerate(column("goals").to_pylist()):
                    for goal in goals:
                        if goal["low"] <= goal["high"]:
                            meets[i] |= (upper[i] >= goal["low"]) & (lower[i] <= goal["high"])
                i, j = np.nonzero(meets)
                taken = batch.take(pa.array(i))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(groups[j])], names=[*taken.schema.names, "group"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return anchors.mapInArrow(reached, f"{kinds}, group long")
