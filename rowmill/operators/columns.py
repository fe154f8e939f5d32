"""Projection helpers (PRJ9, PRJ12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def suffixed(df: DataFrame, suffix: str) -> DataFrame:
    """PRJ9: every column renamed with a suffix, so that a frame can meet itself in a join."""
    return df.select(*[F.col(f"`{name}`").alias(name + suffix) for name in df.columns])


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """PRJ12: every leaf of nested structs as its own ``a_b_c`` column; arrays stay whole."""

    def leaves(schema: StructType, path: tuple[str, ...]) -> list[Column]:
        found: list[Column] = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                found += leaves(field.dataType, here)
            else:
                found.append(F.col(".".join(f"`{part}`" for part in here)).alias(sep.join(here)))
        return found

    return df.select(*leaves(df.schema, ()))
