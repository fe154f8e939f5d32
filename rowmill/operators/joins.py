"""Join operators (J3-J5, J10, J11, J14) that hold when one key owns much of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.operators.layout import plan_bytes
from rowmill.session import settle


def join_small(
    left: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int = 32 << 20, size_bytes: int | None = None
) -> DataFrame:
    """J4: broadcast ``small`` only when its size is within ``max_bytes``: the planned size, which errs on the
    large side, or ``size_bytes`` where the caller has measured it (``cached_bytes``, ``sampled_bytes``).

    Beyond the bound there is no hint: Catalyst shuffles both sides and AQE splits skewed ones.
    """
    size = plan_bytes(small) if size_bytes is None else size_bytes
    side = F.broadcast(small) if size <= max_bytes else small
    return left.join(side, on, how)


def lookup(df: DataFrame, key: str, dimension: DataFrame, dim_key: str, value: str, name: str) -> DataFrame:
    """J11: the dimension's value beside each row, NULL where the key is missing there."""
    pairs = dimension.select(F.col(dim_key).alias("__key"), F.col(value).alias(name))
    return join_small(df, pairs, F.col(key) == F.col("__key"), "left").drop("__key")


def join_as(left: DataFrame, right: DataFrame, key: str, common_type: str, how: str = "inner") -> DataFrame:
    """J14: join on keys of different types through one declared type; bad text matches nothing."""
    return (
        left.withColumn(key, F.col(key).try_cast(common_type))
        .join(right.withColumn(key, F.col(key).try_cast(common_type)), key, how)
    )


def unseen(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """J5: rows of ``new`` whose keys are not in ``old``; only the keys of ``old`` are read."""
    return new.join(old.select(*keys), keys, "left_anti")


def salted_join(
    big: DataFrame, small: DataFrame, key: str, salts: int, salt_from: list[str], how: str = "inner"
) -> DataFrame:
    """J10: spread each key of ``big`` over ``salts`` tasks; ``small`` is repeated once per salt.

    The salt is a hash of ``salt_from``, not a random draw: a task that runs twice sends its rows
    to the same places, so no match is lost or doubled when an executor goes away.  For ``inner``
    and ``left`` joins with ``big`` on the left the result equals the plain join.

    The repeated side is always shuffled: Catalyst's estimate knows nothing of the copies and would send them
    all to the driver and every task.  A side that is small enough for that needs no salts (``join_small``).
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join is inner or left")
    salted = big.withColumn("__salt", F.pmod(F.xxhash64(*salt_from), F.lit(salts)).cast("int"))
    repeated = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated.hint("merge"), [key, "__salt"], how).drop("__salt")


def key_salts(df: DataFrame, key: str, parts: int) -> DataFrame:
    """(key, __salts) of the keys that hold more than a quarter of an even share of the rows, one ``parts``-th:
    into how many pieces of about such a quarter each is dealt.  Pieces are placed by hash, and a task that
    gets two small ones is not as full as one that gets two large ones.

    Counted exactly, with map-side partials; fewer than 4 * ``parts`` keys are that frequent, always.
    """
    counts = settle(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n")), "key-counts")
    total = counts.agg(F.sum("__n")).first()[0] or 0
    share = max(1, -(-total // (4 * parts)))
    hot = counts.where(F.col("__n") > share)
    return settle(hot.select(key, F.ceil(F.col("__n") / share).cast("int").alias("__salts")), "key-salts")


def skew_join(
    big: DataFrame, small: DataFrame, key: str, salt_from: list[str], how: str = "inner", parts: int | None = None
) -> DataFrame:
    """J10 with each key's own number of salts: rows of ``small`` are repeated in proportion to how many rows of
    ``big`` they meet, keys that would not fill a quarter of a task join as they are.

    ``parts`` is the number of tasks to fill, by default the session's shuffle partitions.  The list of hot
    keys is shorter than four times that, so it is broadcast; ``small`` may be large.  Rows of ``big`` without a key match
    nothing: a left join leads them around the shuffle, an inner join drops them.  ``salt_from`` should tell
    rows apart; copies go together, and AQE's split covers them.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join is inner or left")
    parts = parts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(key_salts(big, key, parts))
    salts = F.coalesce("__salts", F.lit(1))
    keyed, known = big.where(F.col(key).isNotNull()), small.where(F.col(key).isNotNull())
    spread = F.pmod(F.xxhash64(*salt_from), salts).cast("int")
    salted = keyed.join(hot, key, "left").withColumn("__salt", spread).drop("__salts")
    repeated = known.join(hot, key, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
    joined = salted.join(repeated, [key, "__salt"], how).drop("__salt")
    if how == "inner":
        return joined
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema.fields if f.name != key]
    return joined.unionByName(big.where(F.col(key).isNull()).select(*joined.columns[: len(big.columns)], *added))


def all_of(*conditions: Column) -> Column:
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined & condition
    return combined
