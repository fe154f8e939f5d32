"""Registered queries: a Spark callable, the operators it covers, and its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from rowmill.session import session_settings

QueryFn = Callable[[SparkSession, str], DataFrame]

PLAN_MODULES = (
    "scans", "writes", "columns", "joins", "aggregates", "windows", "scalars", "udfs", "layout",
    "streams", "models", "applications",

)


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    covers: tuple[str, ...]
    sql: str | None


_QUERIES: dict[str, Query] = {}


def in_utc(fn: QueryFn) -> QueryFn:
    """The same query planned in UTC whatever the session's zone, since its SQL knows no zones."""

    @wraps(fn)
    def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
        with session_settings(spark, spark__sql__session__timeZone="UTC"):
            return fn(spark, sf_dir)

    return planned


def query(covers: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register the decorated function under its own name."""

    def add(fn: QueryFn) -> QueryFn:
        if fn.__name__ in _QUERIES:
            raise ValueError(f"query {fn.__name__} is registered twice")
        run = in_utc(fn)
        _QUERIES[fn.__name__] = Query(fn.__name__, run, tuple(covers.split()), sql)
        return run

    return add


def all_queries() -> dict[str, Query]:
    for module in PLAN_MODULES:
        import_module(f"rowmill.plans.{module}")
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
