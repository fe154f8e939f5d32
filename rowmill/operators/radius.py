"""Radius join of points with readings (J7, J13) as an equi-join on the leaves of an adaptive grid."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.operators.layout import broadcast_bytes, plan_bytes
from rowmill.session import settle

RADIUS_DEG = 0.0045  # fixed value: about 500 m in latitude degrees
LON_FACTOR = 0.58  # fixed value: squared cosine of latitude 40.4 degrees
# A cell is divided at most into 2**LEVELS by 2**LEVELS leaves, a leaf at most among SALTS.
LEVELS, SALTS = 8, 64
_SLACK = 1 + 1e-9  # a cell slightly wider than the radius absorbs rounding in the division
_EDGE = 1e-6  # in cells: how far beyond the radius leaves are still met


def planar_distance(dlon: Column, dlat: Column, lon_factor: float = LON_FACTOR) -> Column:
    return F.sqrt(F.lit(lon_factor) * dlon * dlon + dlat * dlat)


def _scale(radius: float, lon_factor: float) -> tuple[Column, Column]:
    """Longitude and latitude in cells, which are one radius wide and high."""
    return (
        F.col("longitude") / (radius / math.sqrt(lon_factor) * _SLACK), F.col("latitude") / (radius * _SLACK)
    )


def _inside(at: Column, cell: Column, level: Column) -> Column:
    """Which of the 2**level parts of its cell a place lies in, on one axis."""
    parts = F.pow(F.lit(2.0), level)
    return F.greatest(F.lit(0), F.least(F.floor((at - cell) * parts), parts - 1)).cast("int")


def crowded_cells(
    readings: DataFrame, most: int, radius: float = RADIUS_DEG, lon_factor: float = LON_FACTOR
) -> DataFrame:
    """Cells with more than ``most`` of the readings, and how each is divided: (__x, __y, __level, __salts).

    A cell's readings are counted on a grid of the finest leaves.  Its level is the first one at which no
    leaf holds more than ``most``; where even the finest leaves do, as when one place sends them all, they
    are dealt among salts.  Fewer than rows / ``most`` cells are crowded, whatever the table.
    """
    x, y = _scale(radius, lon_factor)
    finest = readings.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull()).select(
        F.floor(x).alias("__x"), F.floor(y).alias("__y"),
        _inside(x, F.floor(x), F.lit(LEVELS)).alias("__i"), _inside(y, F.floor(y), F.lit(LEVELS)).alias("__j"),
    )
    counts = settle(finest.groupBy("__x", "__y", "__i", "__j").agg(F.count(F.lit(1)).alias("n")), "cells")
    cells = counts.groupBy("__x", "__y").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    crowded = counts.join(cells.select("__x", "__y"), ["__x", "__y"], "left_semi")
    # The leaf of a coarser level is named by the leading bits of the finest one's numbers.
    each = crowded.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    leaf = [F.expr(f"shiftright({name}, {LEVELS} - __level)").alias(name) for name in ("__i", "__j")]
    largest = each.groupBy("__x", "__y", "__level", *leaf).agg(F.sum("n").alias("n")).groupBy("__x", "__y", "__level").agg(
        F.max("n").alias("n")
    )
    enough = F.min(F.when(F.col("n") <= most, F.col("__level")))
    salts = F.least(F.lit(SALTS), F.ceil(F.min("n") / most)).cast("int")
    return largest.groupBy("__x", "__y").agg(F.coalesce(enough, F.lit(LEVELS)).alias("__level"), salts.alias("__salts"))


def radius_join(
    points: DataFrame,
    readings: DataFrame,
    radius: float = RADIUS_DEG,
    lon_factor: float = LON_FACTOR,
    salts: int = 1,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """Every (point, reading) closer than ``radius``; both sides have ``longitude``, ``latitude``.

    A cell is one radius wide, so a reading can only match points of the 3 x 3 cells around it.
    The points, the static side, are repeated into those nine cells; readings keep one row and
    may come from a stream.  Cell numbers are join keys and the exact predicate follows, so the
    rows equal those of the all-pairs join.

    ``crowded``, from ``crowded_cells`` over these readings or earlier ones, divides crowded cells into
    leaves: a reading goes to one leaf, a point to those within its reach, and both sides are keyed by the
    leaf, so a crowded cell is many tasks and a reading meets fewer points in vain.  ``salts`` spreads every
    cell's readings instead.  Points are broadcast only if they are small after being repeated.
    """
    x, y = _scale(radius, lon_factor)
    around = F.sequence(F.lit(-1), F.lit(1))
    left = points.select(*[F.col(c).alias(f"point_{c}") for c in points.columns], x.alias("__px"), y.alias("__py"))
    left = left.withColumn("__dx", F.explode(around)).withColumn("__dy", F.explode(around))
    left = left.withColumn("__x", F.floor("__px") + F.col("__dx")).withColumn("__y", F.floor("__py") + F.col("__dy"))
    right = readings.withColumns({"__x": F.floor(x), "__y": F.floor(y)})
    on, copies = ["__x", "__y"], 9
    if crowded is not None:
        levels = settle(crowded, "crowded")
        left, right = (side.join(levels, ["__x", "__y"], "left") for side in (left, right))
        level, parts = F.coalesce("__level", F.lit(0)), F.coalesce("__salts", F.lit(1))
        spread = F.pmod(F.xxhash64(*readings.columns), parts).cast("int")
        right = right.withColumns({
            "__i": _inside(x, F.col("__x"), level), "__j": _inside(y, F.col("__y"), level), "__salt": spread,
        }).drop("__level", "__salts")
        reach = 1 + _EDGE
        for name, at, cell in (("__i", "__px", "__x"), ("__j", "__py", "__y")):
            ends = [_inside(F.col(at) + side * reach, F.col(cell), level) for side in (-1, 1)]
            left = left.withColumn(name, F.explode(F.sequence(*ends)))
        left = left.withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__level", "__salts")
        on = [*on, "__i", "__j", "__salt"]
    elif salts > 1:
        left = left.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        right = right.withColumn("__salt", F.pmod(F.xxhash64(*readings.columns), F.lit(salts)).cast("int"))
        on, copies = [*on, "__salt"], copies * salts
    left = left.drop("__px", "__py", "__dx", "__dy")
    if plan_bytes(points) * copies > broadcast_bytes(points.sparkSession):
        # Catalyst's estimate knows nothing of the copies; the hint keeps it from sending them to all tasks.
        left = left.hint("merge")
    near = planar_distance(
        F.col("point_longitude") - F.col("longitude"),
        F.col("point_latitude") - F.col("latitude"),
        lon_factor,
    ) < radius
    return right.join(left, on).where(near).select(*readings.columns, *[f"point_{c}" for c in points.columns])
