"""Temporal URL lists: every capture is judged by the list entries active when it was fetched.

Only DataFrame functions.  Dated entries of a list become validity intervals; intervals and captures
meet by entry and month, and the interval that holds the time of fetching decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.session import settle

# The end of an interval that no later entry closes.
OPEN_END = "9999-12-31"


def host_of(url: Column) -> Column:
    """Host in lower case without port, user or a leading ``www.``; empty where there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def path_head(url: Column) -> Column:
    """First segment of the path, empty where there is none."""
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)


def entry_keys(url: Column) -> Column:
    """What an entry may name to match a URL: the host, each parent domain of two labels or more,
    and the host with the first path segment.  Longest first; empty without a host."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    head = path_head(url)
    full = F.when(head != "", F.array(F.concat_ws("/", host, head))).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.array_distinct(F.concat(full, parents))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame, entry: str = "entry", day: str = "day", listed: str = "listed") -> DataFrame:
    """(entry, valid_from, valid_to) of the days on which an entry is listed, the last one excluded.

    A dated entry says that from that day on it is listed, or no longer is.  Of several on a day
    listing wins.  Entries are reduced to one per day first, so what is ordered in one group is at
    most as long as the calendar, however often an entry is repeated.  Rows without entry or day are
    no entries; a NULL ``listed`` takes off the list.
    """
    days = entries.where(F.col(entry).isNotNull() & F.col(day).isNotNull()).groupBy(
        F.col(entry).alias("entry"), F.col(day).alias("day")
    ).agg(F.max(F.coalesce(F.col(listed), F.lit(False)).cast("int")).alias("on"))
    order = Window.partitionBy("entry").orderBy("day")
    until = F.coalesce(F.lead("day").over(order), F.to_date(F.lit(OPEN_END)))
    return days.withColumn("valid_to", until).where("on = 1").select("entry", F.col("day").alias("valid_from"), "valid_to")


def judge(
    captures: DataFrame, entries: DataFrame, key: str, url: str, fetched: str, first_month: str, last_month: str
) -> DataFrame:
    """One row per capture: (key, fetched, host, blocked, entry, listed_since).

    ``entry`` is the longest active entry that matches, the first in order among equally long ones,
    ``listed_since`` the day its interval began; both NULL where nothing matches, as for a NULL or
    hostless URL or a NULL time.  Captures whose key repeats are judged row by row.

    ``first_month`` and ``last_month`` (first days) bound the months that intervals are repeated
    for; a capture outside them meets the nearest one, so the bounds change the work and not the
    result.  An entry that owns much of the captures is one plain join key per month, which AQE
    splits; nothing is ordered or collected per entry but its days.

    Without entries every capture is allowed, without captures there are no rows.  Other columns of both
    tables are not read, whatever their names.  URLs of any length are read whole.
    """
    low, high = F.to_date(F.lit(first_month)), F.to_date(F.lit(last_month))
    clamp = lambda day: F.least(F.greatest(F.trunc(day, "month"), low), high)
    active = intervals(entries)
    months = F.sequence(clamp(F.col("valid_from")), clamp(F.date_sub("valid_to", 1)), F.expr("interval 1 month"))
    active = settle(active.withColumn("month", F.explode(months)), "intervals")
    rows = settle(
        captures.select(
            F.col(key).alias("__key"), F.col(fetched).cast("timestamp_ntz").alias("fetched"), F.col(url).alias("__url"),
            F.monotonically_increasing_id().alias("__row"),
        ), "captures",
    )
    day = F.to_date("fetched")
    asked = rows.where("fetched is not null").select("__row", day.alias("__day"), F.explode(entry_keys(F.col("__url"))).alias("entry"))
    asked = asked.withColumn("month", clamp(F.col("__day")))
    hit = asked.join(active, ["entry", "month"]).where("valid_from <= __day and __day < valid_to")
    # Longest first, then in order: the negated length makes the smallest the best.
    best = hit.groupBy("__row").agg(F.min(F.struct((-F.length("entry")).alias("n"), "entry", "valid_from")).alias("hit"))
    return rows.join(best, "__row", "left").select(
        F.col("__key").alias(key), "fetched", host_of(F.col("__url")).alias("host"),
        F.col("hit").isNotNull().alias("blocked"), F.col("hit.entry").alias("entry"),
        F.col("hit.valid_from").alias("listed_since"),
    )
