"""Sharding by weighted rendezvous hashing of record keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.session import settle


def rendezvous_scores(key: Column, weights: list[float]) -> Column:
    """(score, order) of every shard for a key: ``-weight / ln(u)`` with ``u`` in (0, 1) taken from a hash of key
    and shard.  Of two shards that tie the lower number comes first.  NULL keys count as empty."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights are not negative and at least one is positive")
    name = F.coalesce(key.cast("string"), F.lit(""))
    shards = F.array(*[F.lit(s) for s in range(len(weights))])
    weight = F.array(*[F.lit(float(w)) for w in weights])

    def score(shard: Column) -> Column:
        digest = F.md5(F.concat_ws(":", name, shard.cast("string")))
        draw = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
        return F.struct((-weight[shard] / F.ln(draw)).alias("score"), (-shard).alias("order"))

    return F.transform(shards, score)


def rendezvous_shard(key: Column, weights: list[float]) -> Column:
    """The shard whose score is highest for this key.

    Shards win keys in proportion to their weights, and a shard that is added or grows only takes keys
    while one that goes only gives its own away.  NULL keys share one shard.
    """
    return -F.array_max(rendezvous_scores(key, weights))["order"]


def place(rows: DataFrame, key: str, shard: str, slot: str) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, by key (NULL first).

    The rows are range-partitioned by shard, key and the input's partition, which splits a key that
    owns much of the table, and stored; what is numbered in one task is one stored partition, and
    the counts of (shard, partition) give each its offset.
    """
    ranged = rows.withColumn("__from", F.spark_partition_id())
    ranged = ranged.repartitionByRange(F.col(shard), F.col(key).asc_nulls_first(), F.col("__from"))
    stored = settle(ranged.withColumn("__part", F.spark_partition_id()), "placed")
    sizes = settle(stored.groupBy(shard, "__part").agg(F.count(F.lit(1)).alias("__n")), "sizes")
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(sizes.select(shard, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")), "offsets")
    order = Window.partitionBy(shard, "__part").orderBy(F.col(key).asc_nulls_first(), "__from")
    numbered = stored.withColumn("__row", F.row_number().over(order))
    return numbered.join(offsets, [shard, "__part"]).withColumn(slot, F.col("__before") + F.col("__row") - 1).drop(
        "__from", "__part", "__row", "__before"
    )


def shard_records(
    docs: DataFrame, weights: list[float], grown_by: float, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, shard, slot, grown_shard.

    ``grown_shard`` is the shard with one more of weight ``grown_by``.  A NULL text has size 16 and
    checksum 0.  NULL keys go to one shard, repeated rows keep a slot each, an empty table gives no
    rows, other columns are not read.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # One score per shard serves both choices; stored, since finding the ranges reads the rows once more.
    scored = docs.select(
        F.col(key).alias("__key"),
        (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(content.cast("binary")).cast("long").alias("text_crc32"),
        rendezvous_scores(F.col(key), [*weights, grown_by]).alias("__scores"),
    )
    chosen = lambda scores: -F.array_max(scores)["order"]
    rows = settle(scored.select(
        "__key", "size", "text_crc32", chosen(F.slice("__scores", 1, len(weights))).alias("shard"),
        chosen(F.col("__scores")).alias("grown_shard"),
    ), "shards")
    placed = place(rows, "__key", "shard", "slot")
    return placed.select(F.col("__key").alias(key), "size", "text_crc32", "shard", F.col("slot").cast("long"), "grown_shard")
